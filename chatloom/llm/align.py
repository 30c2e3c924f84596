"""Alignment of two tokenizers' tokens over the same bytes, by galloping intersection of their token ends.

Texts are cut into runs at places where both tokenizers always begin a token: before a space that follows a
character other than white space. A run is encoded and aligned once for as long as a worker
knows it. In each run the shorter list of token ends drives an exponential and then a binary search into the longer one; ends found in both cut
groups, and differences of the ranks found give the range of tokens of the other side that a token overlaps.

Counts of linked ids are taken over all documents: documents lie in blocks of bounded bytes, a block gives each of its distinct
id pairs once with its number, and gets the corpus-wide counts of these pairs back. Single links never leave the block.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.bpe_counts import byte_letters
from chatloom.llm.tables import bounded, slices, written
from chatloom.llm.textbytes import blocks, span_hashes, texts_of

#: Bytes of texts whose runs are looked up together; a longer text is cut at a run's begin after so many.
WINDOW_BYTES = 1 << 20
#: Bytes of texts of a block about; a longer text is a block of its own.
BLOCK_BYTES = 1 << 23
#: Bytes of known runs with which a worker forgets them, at a block's end; and what a run takes besides its links.
KEPT_BYTES, ENTRY_BYTES = 1 << 26, 160
#: Runs whose groups are hashed at once.
HASHED_RUNS = 1 << 16
#: The character that the piece vocabulary has for a space.
PIECE_SPACE = "▁"


def run_starts(data: np.ndarray) -> np.ndarray:
    """Where a space follows a byte that doesn't end white space. Characters E2 80 .. and E2 81 .. count as white space whole: cuts may be left out."""
    before = np.zeros(len(data), np.uint8)
    before[1:] = data[:-1]
    fine = (data == 0x20) & (before > 0x1F) & (before != 0x20)
    at = np.flatnonzero(fine & (before >= 0x80))
    if len(at):
        last, second, third = before[at], data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
        white = (second == 0xC2) & ((last == 0x85) | (last == 0xA0))
        white |= (third == 0xE1) & (second == 0x9A) | (third == 0xE2) & ((second == 0x80) | (second == 0x81)) | (third == 0xE3) & (second == 0x80)
        fine[at[white]] = False
    fine[:1] = False
    return np.flatnonzero(fine)


def gallop(short: np.ndarray, long: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each value the number of smaller ones in long, which is sorted: exponential search from place low, then binary search in the range found.

    low is at most the answer, and long has a value that isn't smaller. All values go in step; those that are done leave.
    """
    low, step = low.astype(np.int64, copy=True), np.ones(len(short), np.int64)
    high = low.copy()
    last = len(long) - 1
    going = np.flatnonzero(long[low] < short) if len(short) else np.zeros(0, np.int64)
    while len(going):
        low[going] = high[going] + 1
        high[going] = np.minimum(high[going] + step[going], last)
        step[going] *= 2
        going = going[long[high[going]] < short[going]]
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) >> 1
        less = long[middle] < short[going]
        low[going] = np.where(less, middle + 1, low[going])
        high[going] = np.where(less, high[going], middle)
        going = going[low[going] < high[going]]
    return low


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All places first, first + 1, ... of each range, one range after another."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())


@dataclass
class Alignment:
    """Aligned runs: for each its groups, and the links of all runs in turn."""

    groups: np.ndarray  #: number of each run's groups
    in_groups_a: np.ndarray  #: tokens of either side in each group
    in_groups_b: np.ndarray
    links: np.ndarray  #: number of each run's links
    link_a: np.ndarray  #: places of tokens, over all runs
    link_b: np.ndarray


def align(ends_a: np.ndarray, count_a: np.ndarray, ends_b: np.ndarray, count_b: np.ndarray) -> Alignment:
    """Aligns runs of tokens. Ends rise over all runs; a run's last ends are equal, and each run has tokens."""
    swap = count_a > count_b
    both = np.concatenate([ends_a, ends_b])
    first_a, first_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b + len(ends_a)
    n_short, n_long = np.where(swap, count_b, count_a), np.where(swap, count_a, count_b)
    at_short, at_long = _spread(np.where(swap, first_b, first_a), n_short), _spread(np.where(swap, first_a, first_b), n_long)
    short, long = both[at_short], both[at_long]
    run = np.repeat(np.arange(len(swap)), n_short)
    rank = gallop(short, long, (np.cumsum(n_long) - n_long)[run])
    common = long[rank] == short
    # A token overlaps from the first end above its begin to the first that isn't below its end.
    begin = np.zeros(len(short), np.int64)
    begin[1:] = rank[:-1] + common[:-1]
    width = rank - begin + 1
    link_short, link_long = at_short[np.repeat(np.arange(len(short)), width)], at_long[_spread(begin, width)]
    turned = np.repeat(swap[run], width)
    at = np.flatnonzero(common)
    in_short, in_long = np.diff(at, prepend=-1), np.diff(rank[at], prepend=-1)
    turned_group = swap[run[at]]
    return Alignment(
        groups=np.bincount(run[at], minlength=len(swap)),
        in_groups_a=np.where(turned_group, in_long, in_short),
        in_groups_b=np.where(turned_group, in_short, in_long),
        links=np.bincount(run, weights=width, minlength=len(swap)).astype(np.int64),
        link_a=np.where(turned, link_long, link_short),
        link_b=np.where(turned, link_short, link_long) - len(ends_a),
    )


class Digits:
    """Decimal digits of ids, as bytes."""

    def __init__(self, most: int):
        self.width = len(str(most))
        ids = np.arange(most + 1)
        self.size = np.maximum(1, np.floor(np.log10(np.maximum(ids, 1))).astype(np.int64) + 1)
        self.table = np.zeros((most + 1, self.width + 1), np.uint8)
        for place in range(self.width):
            digit = ids // 10 ** np.maximum(self.size - 1 - place, 0) % 10 + ord("0")
            self.table[:, place] = np.where(place < self.size, digit, 0)

    def joined(self, ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each id and the mark behind it, all in turn, and where each ends."""
        size, rows = self.size[ids], self.table[ids]
        rows[np.arange(len(ids)), size] = marks
        return rows[np.arange(self.width + 1) <= size[:, None]], np.cumsum(size + 1)


def group_texts(a: np.ndarray, b: np.ndarray, found: Alignment, digits: Digits) -> list[bytes]:
    """Each run's groups as text, with a semicolon behind each: a1,a2|b1;a3|b2,b3;"""
    in_a, in_b = found.in_groups_a, found.in_groups_b
    upto_a, upto_b = np.cumsum(in_a), np.cumsum(in_b)
    ids, marks = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[np.arange(len(a)) + np.repeat(upto_b - in_b, in_a)] = a
    ids[np.arange(len(b)) + np.repeat(upto_a, in_b)] = b
    marks[upto_a + upto_b - in_b - 1] = ord("|")
    marks[upto_a + upto_b - 1] = ord(";")
    text, end = digits.joined(ids, marks)
    tokens = (upto_a + upto_b)[np.cumsum(found.groups) - 1]
    stop = end[tokens - 1].tolist()
    whole = text.tobytes()
    return [whole[x:y] for x, y in zip([0, *stop[:-1]], stop, strict=True)]


class Runs:
    """Aligned runs that a worker knows: arrays with an entry per run, in the order in which they came, found by hash."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        with open(path_a, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        letters = byte_letters()
        self.bytes_a = [b""] * (max([*vocab.values(), self.a.get_vocab_size() - 1]) + 1)
        for piece, i in vocab.items():
            self.bytes_a[i] = bytes(letters[c] for c in piece)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any(PIECE_SPACE in p.lstrip(PIECE_SPACE) for p in pieces):
            raise ValueError("pieces that hold a space behind other characters go across runs")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(PIECE_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.length_a, self.length_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        self.space_b = [self.b.piece_to_id(PIECE_SPACE)]
        self.digits = Digits(max(len(self.bytes_a), len(self.bytes_b)))
        self.forget()

    def forget(self) -> None:
        self.hash, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.fine = np.zeros(0, bool)
        self.n_a, self.n_b, self.n_groups, self.n_links, self.first_link = (np.zeros(0, np.int64) for _ in range(5))
        self.link = np.zeros(0, np.uint64)
        self.text: list[bytes] = []
        self.held = 0

    def _learn(self, hashes: np.ndarray, runs: list[bytes]) -> None:
        words = [r.decode("utf-8", "replace") for r in runs]
        ids_a = [e.ids for e in self.a.encode_batch_fast(words, add_special_tokens=False)]
        ids_b = self.b.encode([w[1:] for w in words], num_threads=1)
        ids_b = [ids if len(r) > 1 else self.space_b for ids, r in zip(ids_b, runs, strict=True)]
        of_a, of_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        fine = np.array([b"".join(map(of_a, x)) == r == b"".join(map(of_b, y)) for x, y, r in zip(ids_a, ids_b, runs, strict=True)], bool)
        at = np.flatnonzero(fine).tolist()
        count_a, count_b = (np.fromiter((len(ids[i]) for i in at), np.int64, len(at)) for ids in (ids_a, ids_b))
        a, b = (np.fromiter(chain.from_iterable(ids[i] for i in at), np.int64) for ids in (ids_a, ids_b))
        found = align(np.cumsum(self.length_a[a]), count_a, np.cumsum(self.length_b[b]), count_b)
        n = np.zeros((4, len(runs)), np.int64)
        n[:, at] = np.stack([count_a, count_b, found.groups, found.links])
        texts = [b""] * len(runs)
        for i, text in zip(at, group_texts(a, b, found, self.digits) if at else (), strict=True):
            texts[i] = text
        links = (a[found.link_a].astype(np.uint64) << np.uint64(32)) | b[found.link_b].astype(np.uint64)
        before, behind = len(self.fine), len(self.link)
        order = np.argsort(all_hashes := np.concatenate([self.hash, hashes]), kind="stable")
        self.hash, self.entry = all_hashes[order], np.concatenate([self.entry, before + np.arange(len(runs))])[order]
        self.fine = np.concatenate([self.fine, fine])
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.concatenate([x, y]) for x, y in zip((self.n_a, self.n_b, self.n_groups, self.n_links), n, strict=True))
        self.first_link = np.concatenate([self.first_link, behind + np.cumsum(n[3]) - n[3]])
        self.link = np.concatenate([self.link, links])
        self.text += texts
        self.held += ENTRY_BYTES * len(runs) + sum(map(len, texts)) + links.nbytes

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hash):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        return np.where(self.hash[at] == hashes, self.entry[at], -1)

    def entries(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The entry of each run of each text, with a space before the text, and the number of each text's runs."""
        parts, owner = [], []
        for i, text in enumerate(texts):
            for part in windows(b" " + text) if text else ():
                parts.append(part)
                owner.append(i)
        entries, counts = [], []
        for first, last in blocks(parts, WINDOW_BYTES):
            data = np.frombuffer(b"".join(parts[first:last]), np.uint8)
            size = np.fromiter(map(len, parts[first:last]), np.int64, last - first)
            begin = np.cumsum(size) - size
            start = np.union1d(run_starts(data), begin)
            end = np.append(start[1:], len(data))
            distinct, one, which = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
            entry = self._find(distinct)
            if len(new := np.flatnonzero(entry < 0)):
                self._learn(distinct[new], [data[x:y].tobytes() for x, y in zip(start[one[new]].tolist(), end[one[new]].tolist(), strict=True)])
                entry = self._find(distinct)
            entries.append(entry[which])
            counts.append(np.diff(np.searchsorted(start, np.append(begin, len(data)))))
        if not parts:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        return np.concatenate(entries), np.bincount(owner, weights=np.concatenate(counts), minlength=len(texts)).astype(np.int64)


def windows(text: bytes) -> Iterator[bytes]:
    """The text in parts of about WINDOW_BYTES at most that begin where a run does, as far as it has runs so short."""
    begin, at = 0, WINDOW_BYTES
    while 0 <= (cut := text.find(b" ", at)):
        at = cut + 1
        if text[cut - 1] > 0x20 and 3 in run_starts(np.frombuffer(text[cut - 3 : cut + 1], np.uint8)):
            yield text[begin:cut]
            begin, at = cut, cut + WINDOW_BYTES
    yield text[begin:]


@lru_cache(maxsize=1)
def _runs(path_a: str, path_b: str) -> Runs:
    return Runs(path_a, path_b)


COUNTED = ("n_a", "n_b", "n_groups", "n_links")


class _Block:
    """Documents of a block as rows, and one more row with the block's distinct id pairs and which links its runs have."""

    def __init__(self, number: int, runs: Runs, schema: pa.Schema):
        self.number, self.runs, self.schema = number, runs, schema
        self.keys, self.counts, self.digests, self.entries, self.sizes = [], [], [], [], []

    def add(self, keys: pa.Array, texts: list[bytes]) -> None:
        r = self.runs
        entry, size = r.entries(texts)
        edges = np.concatenate([[0], np.cumsum(size)])

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(values)])[edges])

        bad = per_text(~r.fine[entry]) > 0
        if bad.any():
            entry, size = entry[np.repeat(~bad, size)], np.where(bad, 0, size)
            edges = np.concatenate([[0], np.cumsum(size)])
        self.counts.append(np.stack([per_text(x[entry]) for x in (r.n_a, r.n_b, r.n_groups, r.n_links)]))
        listed, text_of = entry.tolist(), r.text.__getitem__
        for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            digest = hashlib.sha256()
            for at in range(x, y, HASHED_RUNS):
                part = b"".join(map(text_of, listed[at : min(at + HASHED_RUNS, y)]))
                digest.update(part if at + HASHED_RUNS < y else part[:-1])
            self.digests.append(digest.hexdigest() if y > x else "")
        self.keys.append(keys)
        self.entries.append(entry.astype(np.int32))
        self.sizes.append(size)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.keys:
            return
        r, number = self.runs, self.number
        distinct, local = np.unique(np.concatenate(self.entries), return_inverse=True)
        times = np.bincount(local, minlength=len(distinct))
        n_links = r.n_links[distinct]
        links = r.link[_spread(r.first_link[distinct], n_links)]
        pairs, pair = np.unique(links, return_inverse=True)
        n = np.bincount(pair, weights=np.repeat(times, n_links), minlength=len(pairs)).astype(np.int64)
        edges = np.cumsum(np.concatenate(self.sizes)).tolist()
        local = local.astype("<i4")
        lists = [local[x:y].tobytes() for x, y in zip([0, *edges[:-1]], edges, strict=True)]
        count = np.concatenate(self.counts, axis=1)
        keys = pa.concat_arrays(self.keys)
        table = pa.table([pa.array(np.full(len(keys), number)), keys, *map(pa.array, count), pa.array(self.digests), pa.array(lists, pa.binary()), *(pa.nulls(len(keys), f.type) for f in list(self.schema)[8:])], schema=self.schema)
        yield from table.to_batches(max_chunksize=4096)
        one = {"block": number, "run_links": n_links.astype("<i4").tobytes(), "link_pairs": pair.astype("<i4").tobytes()}
        as_list = {"id_a": pairs >> np.uint64(32), "id_b": pairs & np.uint64(0xFFFFFFFF), "times": n}
        arrays = [pa.array(as_list[f.name].astype(np.int64)) if f.name in as_list else None for f in self.schema]
        yield pa.record_batch([pa.array([one.get(f.name)], f.type) if x is None else pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x.cast(f.type.value_type)) for f, x in zip(self.schema, arrays, strict=True)], schema=self.schema)


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents and their blocks, in one table: rows with groups_sha256 are documents, the others blocks."""
    spec = f"block long, doc {dict(docs.dtypes)[key]}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, runs binary, run_links binary, link_pairs binary, id_a array<int>, id_b array<int>, times array<long>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, task = _runs(path_a, path_b), TaskContext.get().partitionId() << 32
        block, held, made = None, 0, 0
        for batch in slices(batches):
            texts = texts_of(batch)
            if block is None:
                number = pa.int64()
                names = ["block", "doc", *COUNTED, "groups_sha256", "runs", "run_links", "link_pairs", "id_a", "id_b", "times"]
                types = [number, batch.schema.field(0).type, *[number] * 4, pa.string(), *[pa.binary()] * 3, pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(number)]
                block = _Block(task + made, runs, pa.schema(list(zip(names, types, strict=True))))
                made += 1
            block.add(batch.column(0), texts)
            held += sum(map(len, texts))
            if held >= BLOCK_BYTES:
                yield from block.rows()
                block, held = None, 0
                if runs.held > KEPT_BYTES:
                    runs.forget()
        if block is not None:
            yield from block.rows()
        if runs.held > KEPT_BYTES:
            runs.forget()

    return bounded(docs).select(F.col(key).alias("doc"), F.col(text).alias("text")).mapInArrow(encode, spec)


def pair_counts(blocks_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The number of links of each id pair over all documents (id_a, id_b, count), and each pair of each block (block, place, id_a, id_b)."""
    each = blocks_.where(F.col("times").isNotNull()).select("block", F.posexplode(F.arrays_zip("id_a", "id_b", "times")).alias("place", "pair")).select("block", "place", "pair.*")
    return each.groupBy("id_a", "id_b").agg(F.sum("times").alias("count")), each.select("block", "place", "id_a", "id_b")


def aligned_tokens(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's tokens of two tokenizers, aligned: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    path_a: a byte-level BPE of ``tokenizers``, which reads the text with a space before it; path_b: a ``sentencepiece`` model that puts the space there itself.
    A link is a pair of tokens that share bytes; a pair of ids counts as many links as all documents
    have of it. n_best: links whose count is their B id's highest; count_sum: the counts of all links. Texts that are null or empty,
    or that either side doesn't give back byte for byte, have no tokens: zeros and an empty digest. Repeated rows count
    each; null ids stay; an empty table gives none; other columns aren't read.
    """
    table = written(aligned_blocks(docs, path_a, path_b, key, text))
    counts, places = pair_counts(table)
    counts = written(counts)
    best = counts.groupBy("id_b").agg(F.max("count").alias("most"))  # a row per id of B's vocabulary
    judged = counts.join(F.broadcast(best), "id_b").select("id_a", "id_b", "count", (F.col("count") == F.col("most")).alias("best"))
    known = places.join(judged, ["id_a", "id_b"]).select(F.col("block").alias("in_block"), "place", "count", "best")
    schema = f"`{key}` {dict(docs.dtypes)[key]}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    digests = table.select("block", "doc", *COUNTED, "groups_sha256", "runs", "run_links", "link_pairs")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        is_doc = np.array(left.column("groups_sha256").is_valid())
        block = left.filter(pa.array(~is_doc))
        docs_ = left.filter(pa.array(is_doc))
        links, pairs = (np.frombuffer(block.column(c)[0].as_py(), "<i4") for c in ("run_links", "link_pairs"))
        place = right.column("place").to_numpy()
        count, best_ = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place], best_[place] = right.column("count").to_numpy(), np.array(right.column("best"))
        edge = np.concatenate([[0], np.cumsum(links)])
        of_run = [np.diff(np.concatenate([[0], np.cumsum(v[pairs])])[edge]) for v in (best_, count)]
        lists = [np.frombuffer(x, "<i4") for x in docs_.column("runs").to_pylist()]
        runs, ends = np.concatenate([np.zeros(0, np.int32), *lists]), np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        sums = [np.diff(np.concatenate([[0], np.cumsum(v[runs])])[ends]) for v in of_run]
        return pa.table([docs_.column("doc"), *(docs_.column(c) for c in COUNTED), *map(pa.array, sums), docs_.column("groups_sha256")], names=[key, *COUNTED, "n_best", "count_sum", "groups_sha256"])

    return digests.groupBy("block").cogroup(known.groupBy("in_block")).applyInArrow(finish, schema)
