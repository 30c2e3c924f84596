"""Recall without reading all texts: which documents hold which three characters in a row.

Documents are numbered in blocks. The index has a row for each block and each distinct run of three characters of its folded texts, in the order of the characters:
the places in the block of the documents that hold the run. So a search reads the few row groups of its own runs. It takes the rarest runs of the query, keeps the
documents that hold all of them, and looks for the query in the texts of these alone, the first ones by key before the others. Texts end with two marks, so that
runs begin at each place, and shorter queries find runs that begin with them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators.retrieve import tags_match
from chatloom.session import written

#: Stands behind the last character.
END = "\u0000"
WIDTH = 3
#: Bits of a character in a run's number.
BITS = 21
#: So many of a query's rarest runs are looked up.
RAREST = 4
#: Up to so many candidates go to the scan of the documents as a list: all, or the first by key if enough of these hold the query. Else they are joined.
LISTED = 1000
#: A block ends at so many documents (a place is a short) or at so many runs of them.
BLOCK_DOCUMENTS, BLOCK_RUNS = 1 << 12, 1 << 22


def grams(text: bytes) -> np.ndarray:
    """The distinct runs of a folded text (UTF-8), as numbers in order."""
    codes = np.frombuffer((text.decode("utf-8", "replace") + END * (WIDTH - 1)).encode("utf-32-le"), "<u4").astype(np.uint64)
    runs = codes[: 1 - WIDTH]
    for i in range(1, WIDTH):
        runs = (runs << np.uint64(BITS)) | codes[i : len(codes) - WIDTH + 1 + i]
    runs.sort()
    return runs[np.concatenate(([True], runs[1:] != runs[:-1]))]


def named_runs(numbers: np.ndarray) -> list[str]:
    """The characters of runs."""
    codes = np.stack([numbers >> np.uint64(BITS * i) & np.uint64((1 << BITS) - 1) for i in range(WIDTH - 1, -1, -1)], 1)
    whole = codes.astype("<u4").tobytes().decode("utf-32-le")
    return [whole[i : i + WIDTH] for i in range(0, len(whole), WIDTH)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block a row with its documents, and a row for each of its runs: gram, block, n, places, documents."""
    names, number = ["gram", "block", "n", "places", "documents"], count(TaskContext.get().partitionId() << 32)
    documents: list[pa.Scalar] = []
    each: list[np.ndarray] = []
    held = 0

    def block() -> pa.RecordBatch:
        runs = np.concatenate(each)
        order = np.argsort(runs, kind="stable")
        runs, places = runs[order], np.repeat(np.arange(len(each), dtype=np.int16), [len(e) for e in each])[order]
        starts = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1])))
        edges = np.concatenate((starts, [len(runs)]))
        size, n = len(starts), len(documents)
        gram = pa.array([*named_runs(runs[starts]), None], pa.string())
        lists = pa.ListArray.from_arrays(pa.array([*edges, len(runs)], pa.int32()), pa.array(places))
        held_by = pa.ListArray.from_arrays(pa.array([*[0] * (size + 1), n], pa.int32()), pa.array([d.as_py() for d in documents], documents[0].type))
        return pa.RecordBatch.from_arrays([gram, pa.array([next(number)] * (size + 1), pa.int64()), pa.array([*np.diff(edges), n], pa.int64()), lists, held_by], names)

    for batch in batches:
        for document, text in zip(batch.column(0), batch.column(1), strict=True):
            documents.append(document)
            each.append(grams(text.as_py()))
            held += len(each[-1])
            if len(each) == BLOCK_DOCUMENTS or held >= BLOCK_RUNS:
                yield block()
                documents, each, held = [], [], 0
    if each:
        yield block()


def build(documents: DataFrame, path: str, content: str = "content", key: str = "document_id") -> None:
    """Writes the index: path/runs (gram, block, n, places) in order, so that a run of very many documents lies in several files, path/counts (gram, n) and path/blocks (block, documents)."""
    spark, kind = documents.sparkSession, documents.schema[key].dataType
    texts = documents.where(F.length(content) > 0).select(F.col(key).alias("document"), F.lower(content).cast("binary").alias("text"))
    made = written(texts.mapInArrow(_blocks, f"gram string, block bigint, n bigint, places array<smallint>, documents array<{kind.simpleString()}>"))
    made.where(F.col("gram").isNull()).select("block", "documents").write.parquet(f"{path}/blocks")
    made.where(F.col("gram").isNotNull()).select("gram", "block", "n", "places").repartitionByRange("gram", "block").sortWithinPartitions("gram", "block").write.parquet(f"{path}/runs")
    spark.read.parquet(f"{path}/runs").groupBy("gram").agg(F.sum("n").alias("n")).repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/counts")


def _documents_at(spark: SparkSession, path: str, blocks: DataFrame) -> DataFrame:
    """The documents at the places of blocks. Columns: block, places."""
    known = spark.read.parquet(f"{path}/blocks")
    return blocks.join(known, "block").select(F.explode(F.transform("places", lambda p: F.element_at("documents", p + 1))).alias("document"))


def candidates(spark: SparkSession, path: str, query: str) -> DataFrame:
    """Documents that may hold the query: all that do are among them. Column: document."""
    folded, runs = query.lower(), spark.read.parquet(f"{path}/runs")
    if len(folded) < WIDTH:
        return _documents_at(spark, path, runs.where(F.col("gram").startswith(folded)).groupBy("block").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places")))
    wanted = sorted({folded[i : i + WIDTH] for i in range(len(folded) - WIDTH + 1)})
    counts = {r.gram: r.n for r in spark.read.parquet(f"{path}/counts").where(F.col("gram").isin(wanted)).collect()}
    rarest = sorted(wanted, key=lambda g: (counts.get(g, 0), g))[:RAREST]
    lists = runs.where(F.col("gram").isin(rarest) & F.lit(len(counts) == len(wanted))).groupBy("block").agg(F.collect_list("places").alias("lists")).where(F.size("lists") == len(rarest))
    return _documents_at(spark, path, lists.select("block", F.reduce("lists", F.element_at("lists", 1), F.array_intersect).alias("places")))


def recalled(spark: SparkSession, path: str, documents: DataFrame, query: str, tags: list[str], limit: int, content: str = "content", key: str = "document_id") -> DataFrame:
    """The same documents as retrieve.recalled: at most limit that hold the query (any case) and have all tags, by key."""
    if not query.strip() or limit < 1:
        raise ValueError("a query with text and a positive limit are needed")
    fits = tags_match(F.col("tags"), tags) & F.contains(F.lower(content), F.lit(query.lower()))
    found = candidates(spark, path, query)
    listed = [r.document for r in found.orderBy("document").limit(LISTED + 1).collect()]
    near = documents.where(F.col(key).isin(listed) if listed else F.lit(False)).where(fits)
    if len(listed) > LISTED:
        first = [r[0] for r in near.orderBy(key).limit(limit).select(key).collect()]
        # Each document that holds the query is a candidate: if enough of the first ones do, no other comes before these.
        near = documents.where(F.col(key).isin(first)).where(fits) if len(first) == limit else documents.join(found, F.col(key) == F.col("document"), "left_semi").where(fits)
    return near.orderBy(key).limit(limit)
