"""Import state and run reports: what to skip, the latest outcome of each key, and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.canonical import document_id
from chatloom.model import STAGES
from chatloom.operators.archive import latest

KEYS = ("source", "source_id")


def decided(incoming: DataFrame, state: DataFrame, force: bool = False) -> DataFrame:
    """Adds decision (skip or process) to incoming rows with a content_hash.

    A row is skipped if its key was imported with the same hash, unless force. Only ids, hash and status of the state are joined.
    """
    known = state.select(F.col("document_id").alias("_id"), F.col("content_hash").alias("_hash"), F.col("status").alias("_status"))
    same = F.lit(not force) & (F.col("_status") == "imported") & (F.col("_hash") == F.col("content_hash"))
    keyed = incoming.withColumn("_id", document_id(F.col("source"), F.col("source_id")))
    return keyed.join(known, "_id", "left").withColumn("decision", F.when(same, "skip").otherwise("process")).drop("_id", "_hash", "_status")


def upserted(state: DataFrame, records: DataFrame, order: Column) -> DataFrame:
    """The state after records: one row per key, the last written wins. Skips are never written."""
    old = state.withColumn("_seq", F.lit(-1).cast("bigint"))
    new = records.where(F.col("status") != "skipped").withColumn("_seq", order.cast("bigint"))
    return latest(old.unionByName(new.select(*old.columns)), KEYS, "_seq").drop("_seq")


def run_report(outcomes: DataFrame, terminal_error: str | None = None) -> DataFrame:
    """One row: imported, skipped, failed, run_status. A terminal error with nothing processed is a failure; an empty run is a success."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    counts = outcomes.agg(n("imported"), n("skipped"), n("failed"))
    good = F.col("imported") + F.col("skipped")
    bad = (F.col("failed") > 0) | F.lit(terminal_error is not None)
    return counts.withColumn("run_status", F.when(~bad, "success").when(good > 0, "partial_success").otherwise("failure"))


def failures_by_stage(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("status") == "failed").groupBy(stage(F.col("error")).alias("stage")).agg(F.count(F.lit(1)).alias("failures"))


def stage(error: Column) -> Column:
    """An error as a stage word; other text is unknown."""
    return F.when(error.isin(*STAGES), error).otherwise(F.lit("unknown"))


def status_rows(state: DataFrame) -> DataFrame:
    """State rows for people, by key: no hash, and errors as stages."""
    return state.select(*KEYS, "document_id", "status", F.when(F.col("status") == "failed", stage(F.col("error"))).alias("error")).orderBy(*KEYS)


def status_totals(state: DataFrame) -> DataFrame:
    return state.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.max("recorded_at").alias("last_recorded"))


def import_age(state: DataFrame, now: Column) -> DataFrame:
    """Seconds since the last import of each source."""
    return state.where(F.col("status") == "imported").groupBy("source").agg((F.unix_timestamp(now) - F.unix_timestamp(F.max("recorded_at"))).alias("age_seconds"))


def absent(known: DataFrame, export: DataFrame) -> DataFrame:
    """Keys that the newest export doesn't hold: a report only, nothing is deleted."""
    return known.select(*KEYS).join(export.select(*KEYS), list(KEYS), "left_anti")
