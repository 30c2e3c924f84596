"""Importing an export, and replaying an archive: parse, skip, sanitize, classify, enrich, archive, retain, record."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.aliases import swept_text
from chatloom.functions.canonical import content_hash, document_id
from chatloom.model import STATE
from chatloom.operators import archive as archives
from chatloom.operators import snapshots, state_table
from chatloom.operators.classify import project_hits, resolved
from chatloom.operators.conversation import field_defect, parsed, split_duplicates
from chatloom.operators.enrich import enriched
from chatloom.operators.retain import retained
from chatloom.operators.sanitize import sanitized
from chatloom.operators.state import decided, run_report
from chatloom.session import written
from chatloom.sources.exports import read_exports


STATUSES = ("imported", "skipped", "failed")


@dataclass(frozen=True)
class Places:
    """Folders of one import's tables, in any store that Spark writes to."""

    root: str
    #: Buckets of the state: at least as many as spark.sql.shuffle.partitions, or joins move it.
    buckets: int = state_table.BUCKETS

    @property
    def store(self) -> str:
        """The archive and the retained documents, which change together."""
        return f"{self.root}/store"

    @property
    def log(self) -> str:
        return f"{self.root}/log"

    def state(self, run: int) -> str:
        return f"{self.root}/state/run={run}"

    def batches(self, checkpoint: str) -> str:
        """Which batch of a stream became which run."""
        return f"{self.root}/batches/{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"

    def work(self, run: int) -> str:
        return f"{self.root}/work/run={run}"


def read_state(spark: SparkSession, places: Places, run: int) -> DataFrame:
    """The state that the run before left; empty at first."""
    return state_table.read(spark, places.state(run), places.buckets) if run >= 0 else spark.createDataFrame([], STATE)


def archived(spark: SparkSession, places: Places) -> DataFrame:
    return snapshots.read(spark, places.store, "archive")


def documents(spark: SparkSession, places: Places) -> DataFrame:
    return snapshots.read(spark, places.store, "documents")


def conversations(records: DataFrame) -> DataFrame:
    """Raw records to conversations with content_hash, document_id and error (a stage); duplicates and bad records have one.

    What is parsed is written before it is filtered: pushed below the parse, a filter would repeat it.
    """
    marked = split_duplicates(written(parsed(records.where(F.col("raw").isNotNull()))))
    rows = marked.withColumn("source", F.lit("chatgpt")).withColumn("document_id", document_id(F.col("source"), F.col("source_id")))
    reason = F.coalesce(F.col("reject_reason"), field_defect())
    return rows.withColumn("reject_reason", reason).withColumn("error", F.when(F.col("reject_reason").isNotNull(), F.lit("source"))).withColumn("content_hash", content_hash(F.col("messages")))


def run_import(spark: SparkSession, records: DataFrame, rules: DataFrame, places: Places, run: int, imported_at: Column, importer_version: str = "1", force: bool = False) -> DataFrame:
    """Imports raw records (file_no, pos, raw, error) as run number run, and returns the outcomes.

    Writes in this order, each keyed so that a rerun after a crash repeats it safely: archive and documents as one change, log, state. A conversation
    that fails is recorded as failed and doesn't stop others; source failures are reported only; skips aren't recorded.
    """
    return counted_import(spark, records, rules, places, run, imported_at, importer_version, force)[0]


def counted_import(spark: SparkSession, records: DataFrame, rules: DataFrame, places: Places, run: int, imported_at: Column, importer_version: str = "1", force: bool = False) -> tuple[DataFrame, dict[str, int]]:
    """run_import, and how many outcomes have each status: counted as the log is written, without reading it again."""
    state = read_state(spark, places, run - 1)
    read = conversations(records)
    read.write.mode("overwrite").parquet(f"{places.work(run)}/read")
    read = spark.read.parquet(f"{places.work(run)}/read")
    good = read.where(F.col("error").isNull())
    # Only keys and hashes meet the state; bodies of unchanged conversations are left behind after that.
    choice = decided(good.select("source", "source_id", "content_hash"), state, force)
    todo = good.join(choice.where("decision = 'process'").select("source", "source_id"), ["source", "source_id"])
    clean = sanitized(todo)
    clean = clean.withColumn("_swept", swept_text(F.col("title"), F.col("messages")))
    named = resolved(clean, project_hits(clean, rules, "document_id", "_swept"), "document_id").drop("_swept")
    full = enriched(named, imported_at, importer_version)
    full.write.mode("overwrite").parquet(f"{places.work(run)}/enriched")
    full = spark.read.parquet(f"{places.work(run)}/enriched")

    kept = full.select("document_id", "source", "source_id", "title", "started_at", "last_activity_at", "messages", "project", "provenance", "tags", content_hash(F.col("messages")).alias("content_hash"), F.lit("application/json").alias("media_type"), F.encode("raw", "utf-8").alias("content"))
    made = retained(full)
    fine = made.where(F.col("error").isNull()).drop("error").withColumn("shelf", archives.shelf(F.sha2("document_id", 256)))
    snapshots.store(spark, places.store, {"archive": archives.archive_rows(kept), "documents": fine})

    done = full.select("source", "source_id", "document_id", "content_hash", "project").join(made.select("document_id", F.col("error").alias("error")), "document_id")
    status = F.when(F.col("error").isNull(), "imported").otherwise("failed")
    processed = done.select("source", "source_id", "document_id", "content_hash", status.alias("status"), "error", "project")
    skipped = choice.where("decision = 'skip'").select("source", "source_id", document_id(F.col("source"), F.col("source_id")).alias("document_id"), "content_hash", F.lit("skipped").alias("status"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("project"))
    bad = read.where(F.col("error").isNotNull()).select(F.lit("chatgpt").alias("source"), "source_id", "document_id", F.lit(None).cast("string").alias("content_hash"), F.lit("failed").alias("status"), "error", F.lit(None).cast("string").alias("project"))
    files = records.where(F.col("error").isNotNull()).select(F.lit("chatgpt").alias("source"), *(F.lit(None).cast("string").alias(c) for c in ("source_id", "document_id", "content_hash")), F.lit("failed").alias("status"), F.lit("source").alias("error"), F.lit(None).cast("string").alias("project"))
    outcomes = processed.unionByName(skipped).unionByName(bad).unionByName(files).withColumn("recorded_at", imported_at.cast("timestamp"))
    seen = Observation()
    outcomes.observe(seen, *(F.count_if(F.col("status") == s).alias(s) for s in STATUSES)).write.mode("overwrite").parquet(f"{places.log}/run={run}")
    outcomes = spark.read.parquet(f"{places.log}/run={run}")
    recorded = outcomes.where(F.col("source_id").isNotNull() & ~F.col("error").eqNullSafe(F.lit("source"))).select(*state.columns)
    state_table.write(state_table.upserted(state, recorded, F.lit(run)), places.state(run), places.buckets)
    return outcomes, {s: int(seen.get[s]) for s in STATUSES}


def import_exports(spark: SparkSession, paths: list[str], rules: DataFrame, places: Places, run: int, imported_at: Column, importer_version: str = "1", force: bool = False) -> tuple[DataFrame, DataFrame]:
    """Outcomes and report of importing exports; where they can't be reached there are no outcomes, and the report has a terminal error."""
    try:
        records = read_exports(spark, *paths)
    except FileNotFoundError:
        none = spark.createDataFrame([], "source string, source_id string, document_id string, content_hash string, status string, error string, project string, recorded_at timestamp")
        return none, report(none, "source")
    outcomes, counts = counted_import(spark, records, rules, places, run, imported_at, importer_version, force)
    return outcomes, counted_report(spark, counts)


def counted_report(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """The report of a run whose outcomes were counted as they were written."""
    good, bad = counts["imported"] + counts["skipped"], counts["failed"]
    status = "success" if not bad else "partial_success" if good else "failure"
    return spark.createDataFrame([(counts["imported"], counts["skipped"], bad, status, 1, None)], "imported bigint, skipped bigint, failed bigint, run_status string, format_version int, terminal_error string")


def report(outcomes: DataFrame, terminal_error: str | None = None) -> DataFrame:
    """One versioned row about a run: its counts, status and terminal error."""
    return run_report(outcomes, terminal_error).withColumn("format_version", F.lit(1)).withColumn("terminal_error", F.lit(terminal_error).cast("string"))


def result_json(report: DataFrame) -> DataFrame:
    """A report as one JSON text, with its version first: what a caller outside Spark reads."""
    names = ("format_version", "run_status", "imported", "skipped", "failed", "terminal_error")
    return report.select(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("result"))


def last_run(spark: SparkSession, places: Places) -> int:
    """The number of the last run that left a state; -1 if there is none."""
    try:
        found = spark.read.parquet(f"{places.root}/state").agg(F.max("run")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return -1
    return -1 if found is None else int(found)
