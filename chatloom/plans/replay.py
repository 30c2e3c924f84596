"""Replaying the archive under changed rules: the archived originals go through the import again, all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators.conversation import parsed
from chatloom.plans.import_job import Places, archived, run_import
from chatloom.sources.exports import replay_records, replayed_defect


def replay(spark: SparkSession, places: Places, rules: DataFrame, run: int, imported_at: Column) -> tuple[DataFrame, DataFrame]:
    """Outcomes of the replay, and the archived rows that can't be replayed (document_id, defect)."""
    checked = parsed(replay_records(archived(spark, places))).withColumn("defect", replayed_defect())
    checked.select("document_id", "file_no", "pos", "raw", "defect").write.mode("overwrite").parquet(f"{places.work(run)}/replayed")
    rows = spark.read.parquet(f"{places.work(run)}/replayed")
    sound = rows.where(F.col("defect").isNull()).select("file_no", "pos", "raw", F.lit(None).cast("string").alias("error"))
    outcomes = run_import(spark, sound, rules, places, run, imported_at, force=True)
    return outcomes, rows.where(F.col("defect").isNotNull()).select("document_id", "defect")
