"""Token counts of byte-level BPE by rank-synchronous merging of ragged arrays.

Texts are cut as the tokenizer's pre-tokenizer cuts them. A batch's new pre-tokens lie one
after another in one symbol array; each round looks up the rank of every adjacent pair, takes
each sequence's lowest, and merges all places of that pair in all sequences at once. Sequences with nothing
left to merge leave with their number of symbols.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.tables import bounded, slices
from chatloom.llm.textbytes import texts_of

NO_RANK = np.iinfo(np.int32).max
#: White space of Unicode, as a character class. Fixed values.
WHITE = r"\t-\r \x85\xa0  -     　"
#: Runs without white space (with the one space before), and white space as the pre-tokenizer cuts it.
CHUNK = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: The pre-tokenizer's pattern, fixed by the published vocabulary.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Bytes of texts' chunks, and of pre-tokens, with which a worker forgets them; until then it keeps them, between tasks too. An entry takes some besides its text.
KEPT_BYTES, ENTRY_BYTES = 1 << 26, 120
#: Bytes of pre-tokens that are merged together.
MERGED_BYTES = 1 << 19
#: Characters of texts that are cut together.
BATCH_CHARS = 1 << 21


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeTable:
    """Ranks and results of a vocabulary's merges, in an open-addressed table that numpy probes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        model = described["model"]
        vocab = model["vocab"]
        self.special = [t["content"] for t in described["added_tokens"]]
        self.symbols = max(vocab.values()) + 1
        ending = model["end_of_word_suffix"] or ""
        self.of_byte, self.of_last = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for letter, byte in byte_letters().items():
            self.of_byte[byte], self.of_last[byte] = vocab[letter], vocab[letter + ending]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * self.symbols + vocab[b] for a, b in pairs], np.int64)
        self.bits = int(len(pairs) * 5).bit_length()
        slots = 1 << self.bits
        self.keys = np.full(slots, -1, np.int64)
        self.rank = np.full(slots, NO_RANK, np.int32)
        self.result = np.zeros(slots, np.int64)
        for rank, (key, slot, (a, b)) in enumerate(zip(keys.tolist(), self._slot(keys).tolist(), pairs, strict=True)):
            while self.keys[slot] >= 0:
                slot = (slot + 1) % slots
            self.keys[slot], self.rank[slot], self.result[slot] = key, rank, vocab[a + b]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each pair, or of an empty slot, whose rank is NO_RANK."""
        slot = self._slot(keys)
        seen = self.keys[slot]
        wrong = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) % len(self.keys)
            seen = self.keys[slot[wrong]]
            wrong = wrong[(seen != keys[wrong]) & (seen >= 0)]
        return slot

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all pieces after all merges, piece after piece, and the number of each piece's."""
        return self.merge_bytes(np.frombuffer(b"".join(pieces), np.uint8), np.fromiter(map(len, pieces), np.int64, len(pieces)))

    def merge_bytes(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """merge() of pieces that lie one after another in data."""
        symbol = self.of_byte[data]
        last = np.cumsum(lengths)[lengths > 0] - 1
        symbol[last] = self.of_last[data[last]]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            slot = self.find(symbol[:-1] * self.symbols + symbol[1:])
            rank = np.where(owner[:-1] == owner[1:], self.rank[slot], NO_RANK)
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            low = np.minimum.reduceat(np.append(rank, NO_RANK), first)
            size = np.diff(np.append(first, len(owner)))
            chosen = (rank == np.repeat(low, size)[:-1]) & (rank < NO_RANK)
            # In a run such as "aaa" the places overlap: every second one merges, from the left.
            place = np.arange(len(chosen))
            since = place - np.maximum.accumulate(np.where(chosen, -1, place)) if len(place) else place
            chosen &= since % 2 == 1
            at = np.flatnonzero(chosen)
            symbol[at] = self.result[slot[at]]
            ended = np.repeat(low == NO_RANK, size)
            done.append((symbol[ended], owner[ended]))
            keep = ~ended
            keep[at + 1] = False
            symbol, owner = symbol[keep], owner[keep]
        if not done:
            return symbol, lengths
        symbol, owner = (np.concatenate(x) for x in zip(*done, strict=True))
        return symbol[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(lengths))


class TokenCounter:
    """Counts the tokens of texts; keeps what it has counted, up to KEPT_BYTES."""

    def __init__(self, path: str):
        self.table = MergeTable(path)
        self.special = re.compile("|".join(map(re.escape, self.table.special))) if self.table.special else None
        self.of_chunk: dict[str, int] = {}
        self.of_piece: dict[str, int] = {}
        self.held = 0

    def _learn(self, chunks: set[str]) -> None:
        cut = {c: PRE_TOKEN.findall(c) for c in chunks}
        new = list({p for pieces in cut.values() for p in pieces if p not in self.of_piece})
        self.held += sum(map(len, chunks)) + sum(map(len, new)) + ENTRY_BYTES * (len(chunks) + len(new))
        begin, size = 0, 0
        for i, piece in enumerate([*new, None]):
            if piece is None or size > MERGED_BYTES:
                part = new[begin:i]
                self.of_piece.update(zip(part, self.table.merge([p.encode() for p in part])[1].tolist(), strict=True))
                begin, size = i, 0
            size += len(piece or "")
        piece_count = self.of_piece
        self.of_chunk.update((c, sum(piece_count[p] for p in pieces)) for c, pieces in cut.items())

    def count(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text; special strings count as one token each."""
        out: list[int] = []
        begin, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size > BATCH_CHARS or i + 1 == len(texts):
                out += self._count(texts[begin : i + 1])
                begin, size = i + 1, 0
        return out

    def _count(self, texts: list[str]) -> list[int]:
        counts, cut = [], []
        for text in texts:
            n, parts = 0, [text]
            if self.special and self.special.search(text):
                n, parts = len(self.special.findall(text)), self.special.split(text)
            counts.append(n)
            cut.append([c for part in parts for c in CHUNK.findall(part)] if len(parts) > 1 else CHUNK.findall(text))
        if self.held > KEPT_BYTES:
            self.of_chunk.clear()
            self.of_piece.clear()
            self.held = 0
        known = self.of_chunk
        if new := {c for c in set().union(*cut) if c not in known}:
            self._learn(new)
        return [n + sum(map(known.__getitem__, chunks)) for n, chunks in zip(counts, cut, strict=True)]


@lru_cache(maxsize=2)
def _counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_tokens, over_limit (more than limit tokens).

    tokenizer: path of a byte-level BPE in the ``tokenizers`` JSON format, the same on all machines.
    Null and empty texts have no bytes and no tokens; a null id stays null; repeated rows each give
    a row; other columns of docs are not read. No truncation, padding, begin or end tokens.
    """
    schema = f"`{key}` {dict(docs.dtypes)[key]}, n_bytes long, n_tokens long, over_limit boolean"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in slices(batches):
            texts = texts_of(batch)
            tokens = np.array(counter.count([t.decode("utf-8", "replace") for t in texts]), np.int64)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)], [key, "n_bytes", "n_tokens", "over_limit"])

    return bounded(docs).select(key, F.col(text).alias("text")).mapInArrow(count, schema)
