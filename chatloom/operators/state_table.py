"""The import state in buckets of its document id: joined and updated where it lies, without moving it.

A state is Parquet files by hash of document_id, sorted inside. (One column: where all records are of one source, a join on source and source_id is one on
source_id alone, and buckets by both wouldn't serve it.) Registered as a bucketed table it joins records
bucket by bucket: only the records are shuffled, to the state's own buckets. So is an update: old and new rows of a key meet in
their bucket, and each task writes the bucket that it read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.model import STATE

BUCKETS = 64
KEY = "document_id"


def _name(path: str) -> str:
    """The table's name in the session's catalog; it goes with the place."""
    return "chatloom_state_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def write(state: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Writes a state in buckets, in place of what was there."""
    state.sparkSession.sql(f"drop table if exists {_name(path)}")
    state.write.format("parquet").mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(_name(path))


def read(spark: SparkSession, path: str, buckets: int = BUCKETS) -> DataFrame:
    """A written state as a bucketed table, also in a session that didn't write it."""
    place = path.replace("'", "\\'")
    spark.sql(f"create table if not exists {_name(path)} ({STATE}) using parquet options (path '{place}') clustered by ({KEY}) sorted by ({KEY}) into {buckets} buckets")
    return spark.table(_name(path))


def upserted(state: DataFrame, records: DataFrame, order: Column) -> DataFrame:
    """The state after records: one row per key, the last written wins; skips are never written. Only the records are shuffled."""
    names = [c for c in state.columns if c != KEY]
    new = records.where(F.col("status") != "skipped").withColumn("_seq", order.cast("bigint"))
    last = new.groupBy(KEY).agg(F.max_by(F.struct(*names), "_seq").alias("_new"))
    both = state.select(KEY, F.struct(*names).alias("_old")).join(last, KEY, "full_outer")
    row = F.coalesce("_new", "_old")
    return both.select(*(F.col(c) if c == KEY else row[c].alias(c) for c in state.columns))
