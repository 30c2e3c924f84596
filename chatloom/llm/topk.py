"""Exact top-k by inner product: tiled matrix products of query blocks and shards.

Queries come in blocks of bounded size; a task walks the vectors where they lie, a shard at a time. Each tile multiplies
some queries by a shard and selects what can still be among their k best; these join the queries' lists, which the task carries on
from shard to shard. Only the lists leave a task, and are merged in a tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.tables import bounded, written

#: Vectors of a shard, at most, and queries that are multiplied at once.
SHARD_ROWS = 4096
PRODUCT_ROWS = 512
#: Components of a block's queries, about.
BLOCK_COMPONENTS = 1 << 21
#: So many tasks' lists meet in the first merge.
MERGED_TASKS = 64
#: Above this a float64 sum of products may round.
EXACT = 2.0**53
LOWEST = np.iinfo(np.int64).min


def _product(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer products; by float64 while every partial sum is exact, else in 64-bit integers."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    if queries.shape[1] * np.abs(queries).max() * np.abs(vectors).max() < EXACT:
        return (queries @ vectors.T).astype(np.int64)
    return queries.astype(np.int64) @ vectors.astype(np.int64).T


class Lists:
    """The k best of some queries of one length so far: entries by query, then score down, then id up."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.rows, self.ids, self.vectors, self.k = rows, ids, vectors, k
        self.query, self.vec_id, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.bar = np.full(len(rows), LOWEST)  #: scores below a query's bar can't be among its best

    def add(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Takes a shard, tile by tile."""
        found = [self._tile(at, rows, ids, vectors) for at in range(0, len(self.rows), PRODUCT_ROWS)]
        query, vec_id, score = (np.concatenate([old, *(f[i] for f in found)]) for i, old in enumerate((self.query, self.vec_id, self.score)))
        order = np.lexsort((vec_id, -score, query))
        query = query[order]
        first = np.searchsorted(query, query)
        kept = order[np.arange(len(order)) - first < self.k]
        full = np.flatnonzero(np.arange(len(order)) - first == self.k - 1)
        self.bar[query[full]] = score[order[full]]
        self.query, self.vec_id, self.score = query[np.arange(len(order)) - first < self.k], vec_id[kept], score[kept]

    def _tile(self, at: int, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What of a tile can be among its queries' best. A query's own row is no candidate."""
        score, bar = _product(self.vectors[at : at + PRODUCT_ROWS], vectors), self.bar[at : at + PRODUCT_ROWS]
        _, own, self_ = np.intersect1d(self.rows[at : at + PRODUCT_ROWS], rows, assume_unique=True, return_indices=True)
        score[own, self_] = LOWEST
        able = score >= bar[:, None]
        if len(ids) > self.k and np.count_nonzero(able) > 4 * self.k * len(bar):
            low = np.partition(score, len(ids) - self.k, axis=1)[:, len(ids) - self.k]
            able = score >= np.maximum(bar, low)[:, None]
        able[own, self_] = False
        query, vector = np.nonzero(able)
        return query + at, ids[vector], score[query, vector]


def by_length(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, ids and vectors of each length of row, vec_id and v."""
    row, vec_id = (batch.column(c).to_numpy() for c in ("row", "vec_id"))
    lists = batch.column("v")
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    size, values = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy()
    begin = np.cumsum(size) - size
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        yield row[at], vec_id[at].astype(np.int64), values[begin[at][:, None] + np.arange(n)]


def integers(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """vec_id and floor(scale * x) of each component; without rows that are null or hold a null or non-finite component."""
    d = F.transform(vector, lambda x: x.cast("double"))
    fine = F.col(key).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return vectors.where(fine).select(F.col(key).alias("vec_id"), F.transform(d, lambda x: F.floor(F.lit(scale) * x).cast("double")).alias("v"))


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k best of all rows for each row whose id is divisible by every: query_id, rank, vec_id, score.

    Score: integer product of floor(scale * x); ties go to the smaller vec_id. Rows with a null id or vector,
    or a null or non-finite component, take no part. Each row asks for itself and is a candidate of all others, also of those
    with its id; so repeated ids give a list each. Only vectors of the query's length are candidates. With fewer than k candidates all
    are given; an empty table gives none. Other columns aren't read.
    """
    table = written(integers(vectors, key, vector, scale).withColumn("row", F.monotonically_increasing_id()))
    asked = table.where(F.pmod("vec_id", F.lit(every)) == 0)
    size = asked.agg(F.sum(F.size("v") + 1)).first()[0] or 0
    n_blocks = max(1, -(-size // BLOCK_COMPONENTS))
    found = None
    for b in range(n_blocks):
        block = asked.where(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == b).select("row", "vec_id", "v").toArrow()
        part = _block(table, block, k)
        found = part if found is None else found.unionByName(part)
    return found


def _block(table: DataFrame, block: pa.Table, k: int) -> DataFrame:
    """The k best of a block's queries."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = {v.shape[1]: Lists(rows, ids, v, k) for rows, ids, v in by_length(block)}
        for batch in batches:
            for at in range(0, batch.num_rows, SHARD_ROWS):
                for rows, ids, v in by_length(batch.slice(at, SHARD_ROWS)):
                    if v.shape[1] in lists:
                        lists[v.shape[1]].add(rows, ids, v)
        task = TaskContext.get().partitionId()
        for one in lists.values():
            columns = (one.rows[one.query], one.ids[one.query], one.vec_id, one.score, np.full(len(one.query), task))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query", "query_id", "vec_id", "score", "task"])

    lists = bounded(table).select("row", "vec_id", "v").mapInArrow(walk, "query long, query_id long, vec_id long, score long, task long")
    first = Window.partitionBy("query", F.floor(F.col("task") / MERGED_TASKS)).orderBy(F.desc("score"), "vec_id")
    lists = lists.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    last = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return lists.select("query_id", last.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
