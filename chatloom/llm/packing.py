"""Best-fit packing of documents into sequences of bounded length, by hierarchical residual packing.

Each partition packs its pieces best-fit decreasing, in blocks of bounded size. Bins that are nearly full, or too full for the smallest other,
stay as they are; the others go up a tree as single items, a few partitions into one, and are packed
best-fit with their like in each round. A bin's place in its parent is one small row per round, so
the pieces themselves never move: at the end they look up where their bin went.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.bpe_counts import MergeTable
from chatloom.llm.tables import bounded, slices, written
from chatloom.llm.textbytes import SPACE, blocks, span_hashes, texts_of

#: Bytes of known units and their ids with which a worker forgets them; until then it keeps them, between tasks too.
KEPT_BYTES = 1 << 25
#: Items that are packed together at most: in a partition's blocks, and in a task of the tree.
BLOCK_ITEMS = 1 << 16
#: A bin with at most so much free space, as a share of its capacity, is nearly full.
NEARLY_FULL = 1 / 256
#: Rounds of the tree at most; each has a range of bin numbers.
MOST_ROUNDS = 30
#: The tree ends with a round that lowers the number of bins by less than this share.
WORTH = 1 / 100
#: Kinds of bytes: letters (ASCII, and both bytes of Latin-1 letters), digits, other printable ASCII.
LETTER, DIGIT, OTHER = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = OTHER
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
_KIND[0x30:0x3A] = DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: What may follow an apostrophe that begins a unit: one letter, or two. Fixed values.
_ONE = np.zeros(256, bool)
_ONE[[ord(c) for c in "stmd"]] = True
_TWO = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
_LIBRARY = np.uint64(0xA24BAED4963EE407)


@dataclass
class Units:
    """Units of a buffer: parts of plain words, and other words whole, in their order."""

    data: np.ndarray  #: the bytes; those of plain words in lower case
    start: np.ndarray
    end: np.ndarray
    plain: np.ndarray
    hash: np.ndarray


def units(data: np.ndarray) -> Units:
    """Cuts bytes at white space, and words of ASCII and Latin-1 letters further, as the pre-tokenizer does: runs of letters, digits each alone, runs of others, endings after an apostrophe.

    Words with other characters, or with "<" of special strings, are one unit. data ends in white space.
    """
    space = SPACE[data]
    kind = _KIND[data]
    lead = data == 0xC3
    second = np.zeros(len(data), bool)
    second[1:] = lead[:-1] & (data[1:] >= 0x80) & (data[1:] <= 0xBF) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    first = np.zeros(len(data), bool)
    first[:-1] = second[1:]
    kind[first | second] = LETTER
    odd = ((kind == 0) & ~space) | (data == 0x3C)
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    begin, end = edge[0::2], edge[1::2]
    if not len(begin):
        none = np.zeros(0, np.int64)
        return Units(data, none, none, none.astype(bool), none.astype(np.uint64))
    strange = np.add.reduceat(odd, begin, dtype=np.int64) > 0
    lower = _LOWER[data]
    capital = second & (data >= 0x80) & (data <= 0x9E)
    lower[capital] += 0x20
    cut = np.ones(len(data), bool)
    cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    # An ending after an apostrophe that begins a unit belongs to it, and the next unit begins behind it.
    at = np.flatnonzero((data == 0x27) & cut)
    at = at[at + 3 < len(data)]
    one = at[_ONE[lower[at + 1]]]
    two = at[np.any([(lower[at + 1] == a) & (lower[at + 2] == b) for a, b in _TWO], axis=0)]
    cut[np.concatenate([one, two]) + 1] = False
    cut[np.concatenate([one + 2, two + 3])] = True
    inside = np.zeros(len(data) + 1, np.int8)
    inside[begin[strange]] += 1
    inside[end[strange]] -= 1
    in_strange = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    cut &= ~in_strange & ~space
    cut[begin[strange]] = True
    start = np.flatnonzero(cut)
    stop = np.append(start[1:], len(data))
    word_end = end[np.searchsorted(begin, start, side="right") - 1]
    stop = np.minimum(stop, word_end)
    data = np.where(in_strange, data, lower)
    plain = ~in_strange[start]
    value = span_hashes(data, start, stop)
    value[~plain] ^= _LIBRARY
    return Units(data, start, stop, plain, value)


class WordIds:
    """Token ids of texts for a tokenizer that lowers case, drops white space and cuts words as units() does: a text's ids are its units' ids in turn.

    Parts of plain words are merged in batches as ragged arrays; other words go to the library itself. Known units lie
    in arrays, sorted by hash.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.table = MergeTable(path)
        self._forget()

    def _forget(self) -> None:
        self.known, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, u: Units, new: np.ndarray) -> None:
        """Adds the units at places new, which are distinct."""
        plain, other = new[u.plain[new]], new[~u.plain[new]]
        length = u.end[plain] - u.start[plain]
        at = np.repeat(u.start[plain] - np.cumsum(length) + length, length) + np.arange(length.sum())
        symbols, counts = self.table.merge_bytes(u.data[at], length)
        words = [u.data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(u.start[other].tolist(), u.end[other].tolist(), strict=True)]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        ids = np.concatenate([symbols.astype(np.uint32), *(np.array(x, np.uint32) for x in found)])
        counts = np.concatenate([counts, np.fromiter(map(len, found), np.int64, len(found))])
        hashes = np.concatenate([self.known, u.hash[plain], u.hash[other]])
        first = np.concatenate([self.first, len(self.ids) + np.cumsum(counts) - counts])
        order = np.argsort(hashes, kind="stable")
        self.known, self.first, self.count = hashes[order], first[order], np.concatenate([self.count, counts])[order]
        self.ids = np.concatenate([self.ids, ids])

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        return np.where(self.known[at] == hashes, at, -1) if len(self.known) else np.full(len(hashes), -1)

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for first, last in blocks(texts):
            buffer = b"\n".join(texts[first:last]) + b"\n"
            u = units(np.frombuffer(buffer, np.uint8))
            distinct, one, which = np.unique(u.hash, return_index=True, return_inverse=True)
            at = self._find(distinct)
            new = at < 0
            if new.any():
                if 24 * len(self.known) + self.ids.nbytes > KEPT_BYTES:
                    self._forget()
                    new[:] = True
                self._learn(u, one[new])
                at = self._find(distinct)
            count = self.count[at][which]
            end = np.cumsum(count)
            ids = self.ids[np.repeat(self.first[at][which] - end + count, count) + np.arange(end[-1] if len(end) else 0)]
            text_end = np.cumsum(np.fromiter(map(len, texts[first:last]), np.int64, last - first) + 1)
            edges = np.concatenate([[0], end])[np.searchsorted(u.start, np.concatenate([[0], text_end]))]
            yield from (ids[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of each document: key, piece, start, length, ids_crc32.

    A document is its ids and then end_id; one longer than capacity is cut into pieces of capacity, of which
    the last may be shorter. Null and empty texts are the end id alone. tokenizer: path of a
    ``tokenizers`` file that drops white space and doesn't look across it.
    """
    schema = f"`{key}` {dict(docs.dtypes)[key]}, piece int, start long, length long, ids_crc32 long"
    end = np.array([end_id], "<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _word_ids(tokenizer)
        for batch in slices(batches):
            row, piece, start, length, crc = [], [], [], [], []
            for r, found in enumerate(ids.encode(texts_of(batch))):
                whole = np.append(found, end).astype("<u4", copy=False)
                for p, at in enumerate(range(0, len(whole), capacity)):
                    part = whole[at : at + capacity]
                    row.append(r)
                    piece.append(p)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(v, pa.int64()) for v in (start, length, crc))], [key, "piece", "start", "length", "ids_crc32"])

    return bounded(docs).select(key, F.col(text).alias("text")).mapInArrow(cut, schema)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: each item's bin and offset, and the fill of each bin.

    Bins are listed by their free space; a number with one bit per free space finds the fullest
    bin that still takes an item. Ties go to the item that stands first.
    """
    bin_of, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    some, fill = 0, []
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fits = some >> size
        if fits:
            free = (fits & -fits).bit_length() - 1 + size
            b = by_free[free].pop()
            if not by_free[free]:
                some &= ~(1 << free)
        else:
            free, b = capacity, len(fill)
            fill.append(0)
        bin_of[item], offset[item] = b, fill[b]
        fill[b] += size
        by_free[free - size].append(b)
        some |= 1 << (free - size)
    return bin_of, offset, np.array(fill, np.int64)


def _packed(batches: Iterator[pa.RecordBatch], level: int, capacity: int, size: str) -> Iterator[pa.RecordBatch]:
    """Adds to each item its bin, its offset there and the bin's fill. Bin numbers are unique over rounds and partitions."""
    base, made = (level << 58) | (TaskContext.get().partitionId() << 34), 0
    held: list[pa.RecordBatch] = []

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal made
        table = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        bins, offset, fill = best_fit(table.column(size).to_numpy(), capacity)
        numbers = base + made + bins
        made += len(fill)
        table = table.append_column("bin", pa.array(numbers)).append_column("bin_offset", pa.array(offset)).append_column("bin_fill", pa.array(fill[bins]))
        yield from table.to_batches()

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK_ITEMS:
            yield from flush()
    if held:
        yield from flush()


def pack(items: DataFrame, capacity: int, size: str = "length") -> DataFrame:
    """Adds sequence_id and offset to items that each have a size of 1 to capacity.

    Sequences hold at most capacity; offsets in each run from 0 without gaps. Sequence numbers are
    unique, not consecutive. Bins are few above the lower bound. A round of the tree packs the bins that are underfull and can still take the
    smallest of them, in tasks of BLOCK_ITEMS at most; rounds end when one task has seen all, or when a round isn't worth its cost. Each round's rows are written to
    the shared folder, so lost executors don't change which item is in which bin.
    """
    added = ", bin long, bin_offset long, bin_fill long"
    plain = ", ".join(f"`{n}` {t}" for n, t in items.dtypes)
    first = written(items.mapInArrow(lambda b: _packed(b, 0, capacity, size), plain + added))
    limit = int(capacity * (1 - NEARLY_FULL))
    last, moves = first, []
    while len(moves) < MOST_ROUNDS:
        bins = written(last.where(F.col("bin_fill") < limit).select(F.col("bin").alias("was"), F.col("bin_fill").alias("size")).distinct())
        least = bins.agg(F.min("size")).first()[0]
        if least is None:
            break
        open_ = bins.where(F.col("size") <= capacity - least)
        n = open_.count()
        if n < 2:
            break
        tasks, level = -(-n // BLOCK_ITEMS), len(moves) + 1
        # Other bins meet in each round.
        dealt = open_.repartition(tasks, F.xxhash64(F.lit(level), "was"))
        moves.append(last := written(dealt.mapInArrow(lambda b, level=level: _packed(b, level, capacity, "size"), "was long, size long" + added)))
        if tasks == 1 or last.select("bin").distinct().count() > n * (1 - WORTH):
            break
    if not moves:
        return first.select(*items.columns, F.col("bin").alias("sequence_id"), F.col("bin_offset").alias("offset"))
    place = None
    for moved in reversed(moves):
        here = moved.select("was", "bin", F.col("bin_offset").alias("at"))
        if place is not None:
            up = place.select(F.col("was").alias("bin"), F.col("bin").alias("up_bin"), F.col("at").alias("up_at"))
            here = here.join(up, "bin", "left").select("was", F.coalesce("up_bin", "bin").alias("bin"), (F.col("at") + F.coalesce("up_at", F.lit(0))).alias("at"))
        place = here
    final = place.select(F.col("was").alias("bin"), F.col("bin").alias("moved_to"), F.col("at").alias("moved_by"))
    return first.join(final, "bin", "left").select(
        *items.columns,
        F.coalesce("moved_to", "bin").alias("sequence_id"),
        (F.col("bin_offset") + F.coalesce("moved_by", F.lit(0))).alias("offset"),
    )


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """All documents in sequences of at most capacity tokens: one row per piece.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null and empty texts are one token (the
    end id); repeated rows and null ids are packed like any other; an empty table gives none. Other columns are not read.
    """
    return pack(pieces(docs, tokenizer, end_id, capacity), capacity)
