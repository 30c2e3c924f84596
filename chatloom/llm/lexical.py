"""Ranked lexical search, term at a time with limited accumulators.

Documents are indexed in shards of bounded bytes: a row of the index holds a shard's sorted terms with their
postings. A search takes the items in blocks of bounded size and walks the shards where they lie. For each item
a shard's terms come rarest first. A term makes accumulators for its documents until the bounds of the remaining terms together
are below the k-th best partial score; from then on only documents that have one are updated, exactly, and those that
can't reach the k-th score any more are given up. A task carries each item's k best on
from shard to shard, so later shards begin with a high bar; only these lists leave the task.
Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from chatloom.llm.tables import bounded, slices, written
from chatloom.llm.textbytes import texts_of, words

#: Bytes of texts of a shard, about; a longer text is a shard of its own.
SHARD_BYTES = 1 << 24
#: Bytes of a text whose terms are found together; a longer text is cut between terms.
WINDOW_BYTES = 1 << 20
#: Distinct terms of the items of a block, summed over items, about.
BLOCK_TERMS = 1 << 20
#: So many tasks' lists meet in the first merge.
MERGED_TASKS = 64
#: Bytes that are in no term: ASCII without letters and digits.
OUTSIDE = np.zeros(256, bool)
OUTSIDE[[b for b in range(128) if not chr(b).isalnum()]] = True


def windows(text: bytes) -> Iterator[bytes]:
    """The text in parts of about WINDOW_BYTES that end between terms; a longer term stays whole."""
    begin = 0
    while len(text) - begin > WINDOW_BYTES:
        end = begin + WINDOW_BYTES
        while end < len(text):
            gaps = np.flatnonzero(OUTSIDE[np.frombuffer(text, np.uint8, min(WINDOW_BYTES, len(text) - end), end)])
            if len(gaps):
                end += int(gaps[0])
                break
            end += WINDOW_BYTES
        yield text[begin:end]
        begin = min(end, len(text))
    yield text[begin:]


def terms_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of all terms, and which text each is of, block by block."""
    parts, owner = [], []
    for i, text in enumerate(texts):
        for part in windows(text):
            parts.append(part)
            owner.append(i)
    of_part = np.array(owner, np.int64)
    for block in words(parts, outside=OUTSIDE):
        yield block.hash, of_part[block.first : block.last][block.text_of_word()]


@dataclass
class Shard:
    """Documents of a shard: term i has postings [first[i], first[i + 1]): documents by their place, and how often."""

    n: np.ndarray  #: terms of each document, with repeats
    term: np.ndarray
    first: np.ndarray
    doc: np.ndarray
    tf: np.ndarray


def shard_of(hashes: np.ndarray, docs: np.ndarray, n_docs: int) -> Shard:
    """The shard of all terms; docs rises."""
    order = np.argsort(hashes, kind="stable")
    hashes, docs = hashes[order], docs[order]
    new_term = np.ones(len(hashes), bool)
    new_term[1:] = hashes[1:] != hashes[:-1]
    new = new_term.copy()
    new[1:] |= docs[1:] != docs[:-1]
    at = np.flatnonzero(new)
    return Shard(
        n=np.bincount(docs, minlength=n_docs),
        term=hashes[new_term],
        first=np.append(np.flatnonzero(new_term[at]), len(at)),
        doc=docs[at],
        tf=np.diff(np.append(at, len(hashes))),
    )


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index: a row per shard with docs (the documents' ids), counts of documents that have terms and of terms, and the arrays of Shard as bytes.

    Null and empty texts have no terms; each row of docs is a document of its own.
    """
    spec = f"docs array<{dict(docs.dtypes)[key]}>, n_docs long, n_terms long, n binary, term binary, first binary, doc binary, tf binary"

    def row(keys: list[pa.Array], hashes: list[np.ndarray], owner: list[np.ndarray]) -> pa.RecordBatch:
        all_keys = pa.concat_arrays(keys)
        s = shard_of(np.concatenate(hashes), np.concatenate(owner), len(all_keys))
        arrays = [a.astype(t).tobytes() for a, t in ((s.n, "<i8"), (s.term, "<u8"), (s.first, "<i8"), (s.doc, "<i4"), (s.tf, "<i4"))]
        listed = pa.ListArray.from_arrays(pa.array([0, len(all_keys)], pa.int32()), all_keys)
        return pa.RecordBatch.from_arrays([listed, pa.array([int((s.n > 0).sum())]), pa.array([int(s.n.sum())]), *(pa.array([a], pa.binary()) for a in arrays)], ["docs", "n_docs", "n_terms", "n", "term", "first", "doc", "tf"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, hashes, owner, size, n_docs = [], [], [], 0, 0
        for batch in slices(batches):
            texts = texts_of(batch)
            for hash_, text_ in terms_of(texts):
                hashes.append(hash_)
                owner.append((text_ + n_docs).astype(np.int32))
            keys.append(batch.column(0))
            n_docs += len(texts)
            size += sum(map(len, texts))
            if size >= SHARD_BYTES:
                yield row(keys, hashes, owner)
                keys, hashes, owner, size, n_docs = [], [], [], 0, 0
        if n_docs:
            yield row(keys, [np.zeros(0, np.uint64), *hashes], [np.zeros(0, np.int32), *owner])

    return bounded(docs).select(F.col(key).alias("doc"), F.col(text).alias("text")).mapInArrow(index, spec)


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """Each row's distinct terms and their repeats: item, terms, repeats (long arrays). Rows without terms are left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = list(terms_of(texts_of(batch)))
            hashes, owner = (np.concatenate(x) for x in zip(*found, strict=True))
            s = shard_of(hashes, owner, batch.num_rows)
            term = np.repeat(s.term, np.diff(s.first))
            order = np.argsort(s.doc, kind="stable")
            row, size = np.unique(s.doc, return_counts=True)
            offsets = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x[order].astype(np.int64))) for x in (term.view(np.int64), s.tf)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *lists], ["item", "terms", "repeats"])

    spec = f"item {dict(items.dtypes)[key]}, terms array<long>, repeats array<long>"
    return bounded(items).select(F.col(key).alias("item"), F.col(text).alias("text")).mapInArrow(count, spec)


class Best:
    """The k best of an item so far: scores falling, equal ones by ascending id with null last."""

    def __init__(self, k: int):
        self.k, self.score, self.ids = k, np.zeros(0, np.int64), []

    def bar(self) -> int:
        """A score below this can't be among them."""
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, ids: list) -> None:
        ranked = sorted(zip((-np.concatenate([self.score, score])).tolist(), [*self.ids, *ids], strict=True), key=lambda x: (x[0], x[1] is None, x[1] if x[1] is not None else 0))[: self.k]
        self.score, self.ids = np.array([-s for s, _ in ranked], np.int64), [i for _, i in ranked]


def kth(scores: np.ndarray, k: int) -> int:
    """The k-th highest; 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def ranked_terms(postings: list[tuple[np.ndarray, np.ndarray]], bounds: list[int], n_docs: int, k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that can be among the k best, and their whole scores. postings: documents (rising) and what the term adds to each, rarest term first.

    bounds: at least what each term adds to any document. bar: lower scores aren't asked for; equal ones are.
    """
    rest = np.concatenate([np.cumsum(np.array(bounds, np.int64)[::-1])[::-1], [0]]).tolist()
    total, high, alive = np.zeros(n_docs, np.int64), 0, None
    for i, (docs, adds) in enumerate(postings):
        if alive is None:
            if rest[i] < max(bar, high):  # high bounds the k-th partial score from above: worth a look
                touched = np.flatnonzero(total)
                if rest[i] < (reached := max(bar, kth(total[touched], k))):
                    alive = touched[total[touched] + rest[i] >= reached]
        if alive is None:
            total[docs] += adds
            high = max(high, int(total[docs].max()))
            continue
        if not len(alive):
            break
        if len(docs) < len(alive):
            place = np.minimum(np.searchsorted(alive, docs), len(alive) - 1)
            hit = alive[place] == docs
            total[docs[hit]] += adds[hit]
        else:
            place = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
            hit = docs[place] == alive
            total[alive[hit]] += adds[place[hit]]
        alive = alive[total[alive] + rest[i + 1] >= max(bar, kth(total[alive], k))]
    found = np.flatnonzero(total) if alive is None else alive
    found = found[total[found] >= max(1, bar, kth(total[found], k))]
    return found, total[found]


def search_block(index: DataFrame, block: pa.Table, k: int, n_docs: int, n_terms: int) -> DataFrame:
    """The k best of each item of a block: item, rank, doc, score. The block is bounded; the index stays where it lies."""
    item_type = block.schema.field("item").type
    sizes = np.fromiter(map(len, block.column("terms").to_pylist()), np.int64, block.num_rows)
    terms, repeats = (np.concatenate([np.zeros(0, np.int64), *(np.asarray(x) for x in block.column(c).to_pylist())]).astype(np.int64) for c in ("terms", "repeats"))
    vocabulary, term = np.unique(terms.view(np.uint64), return_inverse=True)
    number = np.arange(len(vocabulary))

    def present(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(vocabulary), np.int64)
        for batch in rows:
            for t, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                has, first = np.frombuffer(t, "<u8"), np.frombuffer(f, "<i8")
                if len(has):
                    at = np.minimum(np.searchsorted(has, vocabulary), len(has) - 1)
                    df += np.where(has[at] == vocabulary, first[at + 1] - first[at], 0)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(number[held]), pa.array(df[held])], ["term", "df"])

    df = np.zeros(len(vocabulary), np.int64)
    counted = index.select("term", "first").mapInArrow(present, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df[counted.column("term").to_numpy()] = counted.column("df").to_numpy()
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    rarest_first = np.lexsort((term, df[term], np.repeat(np.arange(len(sizes)), sizes)))
    term, repeats = term[rarest_first], repeats[rarest_first]
    keys = block.column("item").to_pylist()

    def walk(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, id_type = [Best(k) for _ in keys], pa.int64()
        for batch in rows:
            id_type = batch.schema.field("docs").type.value_type
            for r in range(batch.num_rows):
                ids = batch.column(0)[r].values
                n, has, first, doc, tf = (np.frombuffer(batch.column(c)[r].as_py(), t) for c, t in enumerate(("<i8", "<u8", "<i8", "<i4", "<i4"), 1))
                if not len(has):
                    continue
                at = np.minimum(np.searchsorted(has, vocabulary), len(has) - 1)
                held = np.flatnonzero(has[at] == vocabulary)
                begin, size = first[at[held]], first[at[held] + 1] - first[at[held]]
                place = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
                m = 25 + 75 * n * n_docs // n_terms
                some_docs, some_tf = doc[place], tf[place].astype(np.int64)
                adds = np.repeat(weight[held], size) * (1000000000 * some_tf // (1000 * some_tf + 8 * m[some_docs]))
                first_of = np.full(len(vocabulary), -1)
                first_of[held] = np.cumsum(size) - size
                last_of = np.zeros(len(vocabulary), np.int64)
                last_of[held] = np.cumsum(size)
                most = np.zeros(len(vocabulary), np.int64)
                most[held] = np.maximum.reduceat(adds, first_of[held]) if len(held) else 0
                for i in range(len(keys)):
                    mine, times = term[edges[i] : edges[i + 1]], repeats[edges[i] : edges[i + 1]]
                    here = first_of[mine] >= 0
                    mine, times = mine[here], times[here]
                    bounds = most[mine] * times
                    if not len(mine) or bounds.sum() < best[i].bar():
                        continue
                    postings = [(some_docs[a:b], adds[a:b] if t == 1 else adds[a:b] * t) for a, b, t in zip(first_of[mine].tolist(), last_of[mine].tolist(), times.tolist(), strict=True)]
                    found, score = ranked_terms(postings, bounds.tolist(), len(n), k, best[i].bar())
                    if len(found):
                        best[i].add(score, ids.take(pa.array(found)).to_pylist())
        task = TaskContext.get().partitionId()
        which = [i for i, b in enumerate(best) for _ in b.ids]
        columns = [pa.array(which, pa.int64()), pa.array([keys[i] for i in which], item_type), pa.array([x for b in best for x in b.ids], id_type), pa.array([s for b in best for s in b.score.tolist()], pa.int64()), pa.array([task] * len(which), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["number", "item", "doc", "score", "task"])

    doc_type = index.schema["docs"].dataType.elementType.simpleString()
    lists = index.select("docs", "n", "term", "first", "doc", "tf").mapInArrow(walk, f"number long, item {from_arrow_type(item_type).simpleString()}, doc {doc_type}, score long, task long")
    first = Window.partitionBy("number", F.floor(F.col("task") / MERGED_TASKS)).orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    lists = lists.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    last = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
    return lists.select("item", last.alias("rank"), "doc", "score").where(F.col("rank") <= k)


def search(index: DataFrame, items: DataFrame, k: int = 10, key: str = "item_id", text: str = "text") -> DataFrame:
    """The k best documents of a written index for each row of items: item, rank (from 1), doc, score above 0.

    Equal scores go by ascending id, null last. Items come in blocks of about BLOCK_TERMS terms; each block walks the index once for its terms' document
    counts and once for scores. Rows without terms give nothing; repeated rows give a list each.
    """
    totals = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    asked = written(item_terms(items, key, text))
    size = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = max(1, -(-size // BLOCK_TERMS))
    asked = written(asked.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(n_blocks)))) if n_blocks > 1 else asked.withColumn("block", F.lit(0))
    found = None
    for b in range(n_blocks):
        block = asked.where(F.col("block") == b).select("item", "terms", "repeats").toArrow()
        part = search_block(index, block, k, totals.docs or 0, max(totals.terms or 0, 1))
        found = part if found is None else found.unionByName(part)
    return found


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best of all documents for each item: item_id, rank, doc_id, score.

    Null, empty or termless texts are never found, and count in no total; repeated rows are documents of their own; null ids stay. Empty tables give no rows;
    other columns aren't read.
    """
    found = search(written(build_index(docs)), items, k)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
