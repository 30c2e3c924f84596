"""Packing by power-of-two decomposition: documents are cut into pieces of binary lengths, and equal lengths share a bucket.

A document of n tokens gives n // capacity pieces of the capacity and one piece for each bit of the rest, longest
first. Each piece is a sequence of its own, so no sequence crosses documents and none needs padding.
Sequences are numbered bucket after bucket: all of one length have consecutive numbers, and a batch of equal
lengths is a range of them. Pieces never move for that: a task numbers its own, and a table with one row per
task and length says where each task's numbers begin.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.packing import WordIds
from chatloom.llm.tables import bounded, slices, written
from chatloom.llm.textbytes import texts_of


def binary_lengths(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The lengths of all pieces, document after document and longest first in each, and the number of each document's pieces."""
    top = capacity.bit_length() - 1
    bits = np.arange(top, -1, -1)
    times = (sizes[:, None] >> bits) & 1
    times[:, 0] = sizes >> top
    return np.repeat(np.tile(1 << bits, len(sizes)), times.ravel()), times.sum(axis=1)


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of each document: key, start, length, ids_crc32, doc_tokens, task, and the piece's number among the task's of its length."""
    schema = f"`{key}` {dict(docs.dtypes)[key]}, start long, length long, ids_crc32 long, doc_tokens long, task long, number long"
    end = np.array([end_id], "<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, task = _word_ids(tokenizer), TaskContext.get().partitionId()
        made = np.zeros(capacity.bit_length(), np.int64)
        for batch in slices(batches):
            arrays = [np.append(found, end).astype("<u4", copy=False) for found in ids.encode(texts_of(batch))]
            sizes = np.fromiter(map(len, arrays), np.int64, len(arrays))
            lengths, count = binary_lengths(sizes, capacity)
            stop = np.cumsum(lengths)
            data = memoryview(np.concatenate(arrays).view(np.uint8))
            crc = [zlib.crc32(data[a:b]) for a, b in zip((4 * (stop - lengths)).tolist(), (4 * stop).tolist(), strict=True)]
            row = np.repeat(np.arange(len(arrays)), count)
            start = stop - lengths - (np.cumsum(sizes) - sizes)[row]
            bucket = np.log2(lengths).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            many = np.bincount(bucket, minlength=len(made))
            number = np.empty(len(bucket), np.int64)
            number[order] = np.arange(len(order)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(made, many)
            made += many
            columns = [start, lengths, np.array(crc, np.int64), sizes[row], np.full(len(row), task), number]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *map(pa.array, columns)], [key, "start", "length", "ids_crc32", "doc_tokens", "task", "number"])

    return bounded(docs).select(key, F.col(text).alias("text")).mapInArrow(cut, schema)


def numbered(pieces: DataFrame) -> DataFrame:
    """Pieces with sequence_id in place of task and number: from 0 without gaps, shorter lengths first, and within a length by task.

    The running sums go over one row per length and task.
    """
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("many"))
    by_task = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_length = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as lengths: capacity's bits
    shorter = counts.groupBy("length").agg(F.sum("many").alias("all")).select("length", F.coalesce(F.sum("all").over(by_length), F.lit(0)).alias("shorter"))
    first = counts.select("length", "task", F.coalesce(F.sum("many").over(by_task), F.lit(0)).alias("before")).join(shorter, "length")
    return pieces.join(first, ["length", "task"]).withColumn("sequence_id", F.col("shorter") + F.col("before") + F.col("number")).drop("task", "number", "shorter", "before")


def decomposed_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048) -> DataFrame:
    """All documents in sequences whose lengths are powers of two up to capacity, itself one: one row per piece.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (always 0). A document is its ids and then end_id; null and
    empty texts are the end id alone; repeated rows and null ids are cut like any other; an empty table gives
    none. Other columns are not read. Sequences of one length have consecutive numbers.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    pieces = numbered(written(cut_documents(docs, tokenizer, end_id, capacity)))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"))


def batches(sequences: DataFrame, tokens: int) -> DataFrame:
    """Adds batch, length and batch number within the length: sequences of one length, about so many tokens a batch (at least one sequence)."""
    first = sequences.groupBy("length").agg(F.min("sequence_id").alias("first"))  # a row per length
    per_batch = F.greatest(F.lit(1).cast("long"), F.lit(tokens) / F.col("length")).cast("long")
    return sequences.join(F.broadcast(first), "length").withColumn("batch", F.floor((F.col("sequence_id") - F.col("first")) / per_batch)).drop("first")
