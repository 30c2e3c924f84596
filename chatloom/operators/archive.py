"""The archive: original and sanitized form of each document, in shelves by key prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.canonical import archive_key

FORMAT_VERSION = 1


def latest(df: DataFrame, keys: tuple[str, ...], order: str) -> DataFrame:
    """One row per key, the one that came last. max_by takes whole rows as it goes, so no key is sorted or gathered."""
    row = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.max_by(row, order).alias("_row")).select("_row.*")


def shelf(key: Column) -> Column:
    """The folder of a key. It begins with a letter, so that Spark doesn't read folder names as numbers."""
    return F.concat(F.lit("s"), F.left(key, F.lit(2)))


def archive_rows(df: DataFrame) -> DataFrame:
    """Rows to archive from document_id, enriched fields, content_hash of the sanitized form, media_type and content (the original's bytes)."""
    return df.withColumn("format_version", F.lit(FORMAT_VERSION)).withColumn("key", archive_key(F.col("document_id"))).withColumn("sha256", F.sha2("content", 256)).withColumn("shelf", shelf(F.col("key")))


def load(archive: DataFrame, document_id: str) -> DataFrame:
    """One document, by its key: Parquet filters on shelf and key leave little to read."""
    key = archive_key(F.lit(document_id))
    return archive.where((F.col("shelf") == shelf(key)) & (F.col("key") == key))


def not_found(wanted: DataFrame, archive: DataFrame) -> DataFrame:
    """Wanted ids that aren't archived: an error, not a null."""
    return wanted.join(archive.select("document_id"), "document_id", "left_anti")


def document_ids(archive: DataFrame, source: str | None = None) -> DataFrame:
    return (archive if source is None else archive.where(F.col("source") == source)).select("document_id")


def audit_defect(recomputed_hash: Column) -> Column:
    """What is wrong with an archived row, or null."""
    return (
        F.when(~F.col("format_version").eqNullSafe(F.lit(FORMAT_VERSION)), "format_version")
        .when(~F.col("document_id").eqNullSafe(F.concat_ws(":", "source", "source_id")), "identity")
        .when(~F.col("key").eqNullSafe(archive_key(F.col("document_id"))), "key")
        .when(~F.col("content_hash").eqNullSafe(recomputed_hash), "content_hash")
        .when(~F.col("sha256").eqNullSafe(F.sha2("content", 256)), "original")
    )


def pages(messages: DataFrame, per_page: int, keys: tuple[str, ...] = ("document_id",), order: str = "pos") -> DataFrame:
    """Adds page (from 0) and place (from 0) to messages of documents in their order."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    return messages.withColumn("place", n).withColumn("page", F.floor(F.col("place") / per_page).cast("int"))
