"""Provenance and tags of a conversation, and checks on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.canonical import document_id, tag
from chatloom.operators.conversation import is_slug


def enriched(df: DataFrame, imported_at: Column, importer_version: str, repository: Column | None = None, user: Column | None = None) -> DataFrame:
    """Adds document_id, provenance and tags to conversations with a project. imported_at is a run parameter, never a clock."""
    none = F.lit(None).cast("string")
    provenance = F.struct("source", "source_id", "project", (none if repository is None else repository).alias("repository"), "title", imported_at.cast("timestamp").alias("imported_at"), F.lit(importer_version).alias("importer_version"))
    tags = F.array_compact(F.array(tag("source", F.col("source")), tag("project", F.col("project")), F.lit("type:conversation"), none if user is None else tag("user", user)))
    return df.withColumn("document_id", document_id(F.col("source"), F.col("source_id"))).withColumn("provenance", provenance).withColumn("tags", tags)


def tag_defect(tags: Column, source: Column, project: Column) -> Column:
    """The first rule that tags break, or null: one each of source, project and type that fit, slugs, no repeats."""
    values = lambda ns: F.filter(tags, lambda t: t.startswith(f"{ns}:"))
    return (
        F.when(F.size(F.array_distinct(tags)) != F.size(tags), "repeated_tag")
        .when(~values("source").eqNullSafe(F.array(tag("source", source))), "source_tag")
        .when(~values("project").eqNullSafe(F.array(tag("project", project))), "project_tag")
        .when(~is_slug(project), "project_slug")
    )
