"""Hashed word n-grams of many texts at once, as flat arrays of text numbers and bucket numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from chatloom.llm import textbytes
from chatloom.llm.textbytes import Words, mix, seeded, words

_U = np.uint64
_SALT = seeded(32, 3)
#: Bytes that belong to words in plain(): ASCII letters and digits, and all beyond ASCII.
_OUTSIDE = np.ones(256, bool)
_OUTSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
#: Shapes: small letters and bytes beyond ASCII as a, capitals as A, digits as 0, other bytes as they are.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x61:0x7B] = _SHAPE[0x80:] = ord("a")
_SHAPE[0x41:0x5B] = ord("A")
_SHAPE[0x30:0x3A] = ord("0")
_RUNS = np.zeros(256, bool)
_RUNS[[ord("a"), ord("A"), ord("0")]] = True


def _pairs(first: np.ndarray, owner: np.ndarray, gap: int, salt: int, second: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of tokens so far apart in one text, and their texts."""
    second = first if second is None else second
    same = owner[:-gap] == owner[gap:] if gap < len(owner) else np.zeros(0, bool)
    n = max(0, len(owner) - gap)
    return mix(first[:n] * _SALT[salt] + second[gap:] * _SALT[salt + 1])[same], owner[:n][same]


def plain(texts: list[bytes], bits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Word uni-, bi- and skip-grams (one word between); words are lower-case runs of letters and digits.

    Yields, block by block: first text, end, text of each feature (from 0 in the block), bucket.
    """
    for w in words(texts, lower=True, outside=_OUTSIDE):
        owner = w.text_of_word()
        found = [(w.hash, owner), _pairs(w.hash, owner, 1, 4), _pairs(w.hash, owner, 2, 6)]
        yield w.first, w.last, np.concatenate([o for _, o in found]), np.concatenate([h >> _U(64 - bits) for h, _ in found]).astype(np.int64)


def shape_hashes(w: Words) -> np.ndarray:
    """A hash of each word's shape, in which runs of letters or digits are one, and a word like the one before is marked."""
    shape = _SHAPE[w.data]
    kept = np.ones(len(shape), bool)
    kept[1:] = (shape[1:] != shape[:-1]) | ~_RUNS[shape[1:]]
    short = shape[kept]
    place = np.cumsum(kept)
    start, end = place[w.start] - 1, place[w.end] - 1
    up, down = textbytes._power_tables(len(short))
    running = np.cumsum(textbytes.BYTE_VALUES[short] * up[: len(short)], dtype=np.uint64)
    before = np.where(start > 0, running[np.maximum(start - 1, 0)], _U(0))
    value = mix((running[end - 1] - before) * down[start])
    again = np.zeros(len(value), bool)
    again[1:] = w.hash[1:] == w.hash[:-1]
    value[again] ^= _SALT[20]
    return value


def shaped(texts: list[bytes], bits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Uni-, bi- and trigrams of word shapes, and word uni- and bigrams; as plain() yields them."""
    for w in words(texts, lower=False):
        if not len(w.start):
            yield w.first, w.last, np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        owner, shape = w.text_of_word(), shape_hashes(w)
        two, two_of = _pairs(shape, owner, 1, 8)
        three, three_of = textbytes.windows(shape, w.word_at, 3)
        found = [(shape, owner), (two, two_of), (three ^ _SALT[21], owner[three_of]), (mix(w.hash ^ _SALT[22]), owner), _pairs(w.hash, owner, 1, 10)]
        yield w.first, w.last, np.concatenate([o for _, o in found]), np.concatenate([h >> _U(64 - bits) for h, _ in found]).astype(np.int64)
