"""Retrieval over archived documents: tag-scoped recall, tag match modes, listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tags_match(tags: Column, wanted: list[str], mode: str = "all_strict") -> Column:
    """Modes any, all, any_strict, all_strict and exact; those that aren't strict also admit untagged documents."""
    asked = F.array(*map(F.lit, wanted)).cast("array<string>")
    untagged = F.size(tags) == 0
    some, every = F.arrays_overlap(tags, asked), F.size(F.array_except(asked, tags)) == 0
    if mode == "exact":
        return every & (F.size(F.array_except(tags, asked)) == 0)
    if not wanted:
        return F.lit(True)
    kind = some if mode.startswith("any") else every
    return (kind & ~untagged) if mode.endswith("_strict") else (kind | untagged)


def recalled(documents: DataFrame, query: str, tags: list[str], limit: int, content: str = "content") -> DataFrame:
    """At most limit documents whose content holds the query (any case) and that have all tags, by document_id."""
    if not query.strip() or limit < 1:
        raise ValueError("a query with text and a positive limit are needed")
    hit = F.contains(F.lower(content), F.lit(query.lower()))
    return documents.where(tags_match(F.col("tags"), tags) & hit).orderBy("document_id").limit(limit)


def with_sources(hits: DataFrame, archive: DataFrame, fields: tuple[str, ...] = ("title", "started_at")) -> DataFrame:
    """document_id of recalled documents, with these fields of the conversations that they came from. Documents without an archived one are left out."""
    return hits.select("document_id").join(archive.select("document_id", *fields), "document_id")


def listed(archive: DataFrame, project: str | None = None, source: str | None = None, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """document_id, title, project, source, started_at of archived conversations in a scope; filters reach the scan."""
    for column, value in (("project", project), ("source", source)):
        if value is not None:
            archive = archive.where(F.col(column) == value)
    if since is not None:
        archive = archive.where(F.col("started_at") >= since)
    if until is not None:
        archive = archive.where(F.col("started_at") < until)
    return archive.select("document_id", "title", "project", "source", "started_at")
