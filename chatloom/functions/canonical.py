"""Canonical form and content hash of a conversation, timestamps and keys; built-in functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Control characters whose JSON escape has a hex letter; Spark writes it in capitals.
_HEX_ESCAPES = ("0b", "0e", "0f", "1a", "1b", "1c", "1d", "1e", "1f")


def timestamp_text(ts: Column) -> Column:
    """UTC with microseconds and Z; null stays null."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def canonical_json(messages: Column) -> Column:
    """Version and messages only: sorted keys, no spaces, no ASCII escapes, nulls kept, lower-case hex in escapes."""
    each = F.transform(
        messages,
        lambda m: F.struct(
            F.transform(m["non_text_parts"], lambda p: F.struct(p["kind"].alias("kind"), p["name"].alias("name"))).alias("non_text_parts"),
            m["role"].alias("role"),
            timestamp_text(m["sent_at"]).alias("sent_at"),
            m["text"].alias("text"),
            F.transform(m["tool_activity"], lambda t: F.struct(t["name"].alias("name"), t["request"].alias("request"), t["result"].alias("result"))).alias("tool_activity"),
        ),
    )
    text = F.to_json(F.struct(each.alias("messages"), F.lit(1).alias("version")), {"ignoreNullFields": "false"})
    # A pair of backslashes is one character of text; it is set apart, so that what follows is an escape only if it is one.
    apart = F.replace(text, F.lit("\\\\"), F.lit("\\\\\u0000"))
    lower = reduce(lambda t, h: F.replace(t, F.lit(f"\\u00{h.upper()}"), F.lit(f"\\u00{h}")), _HEX_ESCAPES, apart)
    return F.when(text.rlike(r"\\u00[01][A-F]"), F.replace(lower, F.lit("\\\\\u0000"), F.lit("\\\\"))).otherwise(text)


def content_hash(messages: Column) -> Column:
    return F.sha2(canonical_json(messages), 256)


def document_id(source: Column, source_id: Column) -> Column:
    return F.concat(source, F.lit(":"), source_id)


def archive_key(document: Column) -> Column:
    return F.sha2(document, 256)


def tag(namespace: str, value: Column) -> Column:
    return F.concat(F.lit(f"{namespace}:"), value)
