"""Documents for retrieval: one JSON document per conversation, and its decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.canonical import timestamp_text

VERSION = "1"
MAX_BYTES = 8 * 1024 * 1024
PROVENANCE = "source string, source_id string, project string, repository string, title string, imported_at timestamp, importer_version string"


def has_content(messages: Column) -> Column:
    """Whether any message has text that isn't blank, tool activity or a part."""
    return F.exists(messages, lambda m: m["text"].rlike(r"(?U)\S") | (F.size(m["tool_activity"]) > 0) | (F.size(m["non_text_parts"]) > 0))


def retained(df: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The document of each enriched conversation, and error: retain where it is empty or too large."""
    plain = {"ignoreNullFields": "false"}
    content = F.to_json(F.struct("source", "source_id", "title", "started_at", "last_activity_at", "messages"), plain)
    rows = df.select(
        "document_id",
        "messages",
        content.alias("content"),
        timestamp_text(F.col("started_at")).alias("timestamp"),
        F.lit("replace").alias("update_mode"),
        "tags",
        F.create_map(F.lit("version"), F.lit(VERSION), F.lit("provenance"), F.to_json("provenance"), F.lit("started_at"), timestamp_text(F.col("started_at"))).alias("metadata"),
    )
    document = F.to_json(F.struct("content", "document_id", "timestamp", "update_mode", "tags", "metadata"))
    bad = ~has_content(F.col("messages")) | (F.octet_length(document) > max_bytes)
    return rows.withColumn("error", F.when(bad, F.lit("retain"))).drop("messages")


def decoded(documents: DataFrame, required_tags: list[str]) -> DataFrame:
    """Retrieved documents with their provenance, and error where version, provenance, identity or tags don't fit."""
    p = F.from_json(F.col("metadata")["provenance"], PROVENANCE)
    rows = documents.withColumn("_p", p)
    missing = F.size(F.array_except(F.array(*map(F.lit, required_tags)).cast("array<string>"), F.col("tags")))
    fits = (F.col("metadata")["version"] == VERSION) & F.col("_p.source_id").isNotNull() & (F.col("document_id") == F.concat_ws(":", "_p.source", "_p.source_id")) & (missing == 0)
    return rows.withColumn("error", F.when(~F.coalesce(fits, F.lit(False)), F.lit("rejected"))).withColumnRenamed("_p", "provenance")
