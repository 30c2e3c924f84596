"""Logistic regression over hashed n-grams, trained by follow-the-regularised-leader.

A bounded, seeded sample of labelled rows becomes hashed features where it lies; only bucket numbers are dealt to a fixed number of
shards. Each shard makes FTRL-proximal updates over its rows for some epochs (a rate of its own for each coordinate, L1 and L2),
and a bucket's weight is the mean over the shards by the squared gradients that they saw there. Scoring is a sum of
looked-up weights in numpy batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm import features
from chatloom.llm.tables import bounded, crc32_mod, give_back, slices, steady
from chatloom.llm.textbytes import texts_of


@dataclass(frozen=True)
class Settings:
    """Parameters of a model; max_rows bounds the labelled sample, which shards learn from in equal parts."""

    kind: str  #: "shaped" or "plain", functions of features
    bits: int
    binary: bool  #: a feature counts once a text, else by its share of the text's features
    scale: float = 1.0
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    epochs: int = 3
    max_rows: int = 16_000
    shards: int = 4
    seed: int = 7

    def rows(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Distinct buckets and values of each text, in turn."""
        for first, last, owner, bucket in getattr(features, self.kind)(texts, self.bits):
            both, count = np.unique((owner << self.bits) | bucket, return_counts=True)
            text, bucket = both >> self.bits, (both & ((1 << self.bits) - 1)).astype(np.int32)
            at = np.searchsorted(text, np.arange(last - first + 1))
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                c = count[a:b].astype(np.float32)
                yield bucket[a:b], np.ones(b - a, np.float32) if self.binary else np.float32(self.scale) * c / max(c.sum(), np.float32(1))


def learned(bucket: np.ndarray, value: np.ndarray | None, begin: np.ndarray, labels: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets that rows have, their weights and squared gradients; the bucket after the last is the bias, which has no L1.

    bucket and value (None: all 1) hold all rows' features, row i from begin[i] to begin[i + 1]. Rows without features teach nothing.
    """
    size = 1 << s.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    rows = np.flatnonzero(np.diff(begin))
    order = np.random.default_rng(s.seed)

    def weights(z, n, l1):
        big = np.abs(z) - l1
        return np.where(big > 0, -np.sign(z) * big / ((s.beta + np.sqrt(n)) / s.alpha + s.l2), 0.0)

    def update(at, w, g):
        now = n[at] + g * g
        z[at] += g - (np.sqrt(now) - np.sqrt(n[at])) / s.alpha * w
        n[at] = now

    for _ in range(s.epochs):
        for i in order.permutation(rows).tolist():
            at = bucket[begin[i] : begin[i + 1]]
            x = 1.0 if value is None else value[begin[i] : begin[i + 1]]
            w, bias = weights(z[at], n[at], s.l1), weights(z[size], n[size], 0.0)
            p = 1 / (1 + np.exp(-np.clip((w * x).sum() + bias, -30, 30)))
            update(at, w, (p - labels[i]) * x)
            update(size, bias, p - labels[i])
    at = np.flatnonzero(n)
    return at, weights(z[at], n[at], np.where(at == size, 0.0, s.l1)), n[at]


def sample(labels: DataFrame, label: str, s: Settings, key: str = "doc_id") -> DataFrame:
    """At most about max_rows labelled ids, with one label each, outside the held-out fold; chosen by a seeded hash."""
    usable = labels.where((crc32_mod(key, 4) != 2) & F.col(key).isNotNull() & F.col(label).isin(0, 1))
    n = usable.count()
    kept = usable.where(F.pmod(F.xxhash64(F.lit(s.seed), F.col(key)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, s.max_rows / max(n, 1))))
    return kept.groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label"))


def hashed(docs: DataFrame, labels: DataFrame, label: str, s: Settings, key: str, text: str) -> DataFrame:
    """shard, at, label, buckets and values (little-endian numbers) of the sampled ids: what training needs of their texts.

    An id teaches once, by the row whose text has the least hash: repeated rows are left behind where they lie, so max_rows bounds rows too.
    """
    chosen = F.broadcast(sample(labels, label, s, key))
    rows = bounded(docs).select(F.col(key).alias("_id"), F.col(text).alias("text")).join(chosen, F.col("_id") == F.col("_key"))
    rows = rows.select("_id", "text", F.col("_label").cast("double").alias("label"), F.pmod(F.xxhash64(F.lit(s.seed + 1), "_id"), F.lit(s.shards)).cast("int").alias("shard"), F.xxhash64("_id", "text").alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = list(s.rows(texts_of(batch)))
            buckets = pa.array([b.astype("<i4").tobytes() for b, _ in found], pa.binary())
            # All values of a binary model are 1.
            values = pa.nulls(len(found), pa.binary()) if s.binary else pa.array([x.astype("<f4").tobytes() for _, x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_id", "shard", "at", "label")), buckets, values], ["_id", "shard", "at", "label", "buckets", "values"])

    found = rows.mapInArrow(run, f"_id {dict(rows.dtypes)['_id']}, shard int, at long, label double, buckets binary, values binary")
    return found.groupBy("_id").agg(F.min_by(F.struct("shard", "at", "label", "buckets", "values"), "at").alias("row")).select("row.*")


def _numbers(column: pa.BinaryArray, kind: type) -> list[np.ndarray]:
    """The numbers of each cell of a binary column, apart from the batch that it came in."""
    return [np.frombuffer(cell.as_buffer(), kind).copy() for cell in column]


def _flat(rows: list[np.ndarray], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All rows one after another, and where each begins; rows is used up."""
    begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)))])
    out = np.empty(begin[-1], kind)
    for i in range(len(rows)):
        out[begin[i] : begin[i + 1]] = rows[i]
        rows[i] = None
    return out, begin


def train(docs: DataFrame, labels: DataFrame, label: str, s: Settings, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """Weights of all buckets and the bias. Without labelled rows all weights are 0, and each score is 0.5."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steady()
        at, label_, buckets, values = [], [], [], []
        for batch in batches:
            at += batch.column("at").to_pylist()
            label_ += batch.column("label").to_pylist()
            buckets += _numbers(batch.column("buckets"), np.int32)
            values += [] if s.binary else _numbers(batch.column("values"), np.float32)
            del batch
        place = np.argsort(np.array(at, np.int64), kind="stable").tolist()
        shares, numbers = [values[i] for i in place] if values else [], [buckets[i] for i in place]
        values.clear()
        buckets.clear()
        value = None if s.binary else _flat(shares, np.float32)[0]
        bucket, begin = _flat(numbers, np.int32)
        found, w, n = learned(bucket, value, begin, np.array([label_[i] for i in place], np.float64), s)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (found, w, n)], ["bucket", "weight", "seen"])
        del bucket, value
        give_back()

    each = hashed(docs, labels, label, s, key, text).groupBy("shard").applyInArrow(learn, "bucket long, weight double, seen double")
    mean = each.groupBy("bucket").agg((F.sum(F.col("weight") * F.col("seen")) / F.sum("seen")).alias("weight")).where("weight <> 0").toPandas()
    weights = np.zeros((1 << s.bits) + 1)
    weights[mean["bucket"].to_numpy(np.int64)] = mean["weight"].to_numpy()
    return weights


def score_texts(texts: list[bytes], weights: np.ndarray, s: Settings) -> np.ndarray:
    """The probability of label 1 of each text; one without features gets the bias alone."""
    total = np.full(len(texts), float(weights[-1]))
    for first, last, owner, bucket in getattr(features, s.kind)(texts, s.bits):
        n = last - first
        if s.binary:
            some = weights[bucket] != 0
            both = np.unique((owner[some] << s.bits) | bucket[some])
            total[first:last] += np.bincount(both >> s.bits, weights[both & ((1 << s.bits) - 1)], minlength=n)
        else:
            total[first:last] += s.scale * np.bincount(owner, weights[bucket], minlength=n) / np.maximum(np.bincount(owner, minlength=n), 1)
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def scored(docs: DataFrame, weights: np.ndarray, s: Settings, threshold: float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted (1 from the threshold on) of every row of docs."""
    held = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    kind = dict(docs.dtypes)[key]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            p = score_texts(texts_of(batch), held.value, s)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(p), pa.array((p >= threshold).astype(np.int32))], [key, "held_out", "score", "predicted"])

    return bounded(docs).select(key, F.col(text).alias("text"), (crc32_mod(key, 4) == 2).alias("held_out")).mapInArrow(score, f"`{key}` {kind}, held_out boolean, score double, predicted int")


def reaching(docs: DataFrame, weights: np.ndarray, s: Settings, threshold: float, text: str = "text") -> Column:
    """Whether a text's score reaches the threshold, to filter docs: only the text goes to Python, and one bit comes back."""
    held = bounded(docs).sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    @F.arrow_udf("boolean")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = slices([pa.RecordBatch.from_arrays([texts], ["text"])])
            found = [score_texts(texts_of(part), held.value, s) >= threshold for part in parts]
            yield pa.array(np.concatenate(found) if found else np.zeros(0, bool))

    return run(F.col(text))
