"""Words of many texts at once, as byte positions and 64-bit hashes in numpy arrays.

A word is a run of bytes outside ``\\x20`` and ``\\x09-\\x0D``. Texts are joined into one
buffer per block of about half a megabyte, so each step is one numpy pass over the block. The hash of a word
is a polynomial over a fixed table of byte values, modulo 2**64, then mixed; it is the same in
every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 5
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def seeded(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed * 0x1000003 + 77))


BYTE_VALUES = seeded(256, 1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r**i and r**-i modulo 2**64 for i < n; grown when a longer block comes."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, BLOCK_BYTES + (BLOCK_BYTES >> 2))
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def forget_tables() -> None:
    """Gives the memory of the power tables back; they are made again when they are needed."""
    _powers.clear()


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of each span of bytes, which isn't empty."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(data))
    running = np.cumsum(BYTE_VALUES[data] * up[: len(data)], dtype=np.uint64)
    before = np.where(start > 0, running[np.maximum(start - 1, 0)], _U(0))
    return mix((running[end - 1] - before) * down[start])


@dataclass
class Words:
    """Words of texts [first, last) of a batch."""

    first: int
    last: int
    data: np.ndarray  #: the bytes, each text followed by one newline
    text_at: np.ndarray  #: where each text begins in data, and the end
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    word_at: np.ndarray  #: the number of each text's first word, and the end

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.last - self.first), np.diff(self.word_at))

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value of each byte, by text."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[self.text_at[1:]] - total[self.text_at[:-1]]


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def blocks(texts: list[bytes], most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many bytes together; a longer text is a block of its own."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) >= most:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def words(texts: list[bytes], lower: bool = True, hashes: bool = True, outside: np.ndarray = SPACE, most: int = BLOCK_BYTES) -> Iterator[Words]:
    """The words of all texts, block by block. lower: A-Z become a-z first. outside: the bytes between words."""
    for first, last in blocks(texts, most):
        buffer = b"\n".join(texts[first:last]) + b"\n"
        data = np.frombuffer(buffer.lower() if lower else buffer, np.uint8)
        lengths = np.fromiter(map(len, texts[first:last]), np.int64, last - first) + 1
        text_at = np.concatenate([[0], np.cumsum(lengths)])
        space = outside[data]
        flips = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            flips = np.concatenate([[0], flips])
        start, end = flips[0::2], flips[1::2]
        value = span_hashes(data, start, end) if hashes else np.zeros(0, np.uint64)
        yield Words(first, last, data, text_at, start, end, value, np.searchsorted(start, text_at))


_WINDOW = seeded(64, 2) | _U(1)


def windows(hashes: np.ndarray, word_at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of so many words inside a text, and the first word of each."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += hashes[k : k + n] * _WINDOW[k]
    inside = np.ones(len(hashes), bool)
    for k in range(1, width):
        tail = word_at[1:] - k
        inside[tail[tail >= word_at[:-1]]] = False
    at = np.flatnonzero(inside[:n])
    return mix(total[at] + _U(width)), at
