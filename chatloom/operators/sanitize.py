"""Redaction of every text field of a conversation, and counts by category."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.redact import redacted_all


def _all_texts(title: Column, messages: Column) -> Column:
    """Title, then each message's text, tool fields and part names, in one array; rebuilt by _put_back."""
    each = F.transform(
        messages,
        lambda m: F.concat(F.array(m["text"]), F.flatten(F.transform(m["tool_activity"], lambda t: F.array(t["name"], t["request"], t["result"]))), F.transform(m["non_text_parts"], lambda p: p["name"])),
    )
    return F.concat(F.array(title), F.flatten(each))


def sanitized(df: DataFrame, redact: Callable[[Column], Column] = redacted_all) -> DataFrame:
    """Replaces credentials in title and messages, and adds redactions (map of category to number).

    All texts of a row are one array, which goes to the redactor and back in place: nothing is dealt out. Ids, times, roles and kinds stay as they are.
    """
    done = df.withColumn("_done", redact(_all_texts(F.col("title"), F.col("messages"))))
    found = F.size("_done.counts") > 0
    title = F.when(found, F.element_at("_done.texts", 1)).otherwise(F.col("title"))
    messages = F.when(found, _put_back(F.col("messages"), F.col("_done.texts"))).otherwise(F.col("messages"))
    return done.withColumn("title", title).withColumn("messages", messages).withColumn("redactions", F.col("_done.counts")).drop("_done")


def _put_back(messages: Column, texts: Column) -> Column:
    """Messages with their texts taken from the array that _all_texts made."""
    size = lambda m: 1 + 3 * F.size(m["tool_activity"]) + F.size(m["non_text_parts"])
    start = F.transform(messages, lambda m, i: F.aggregate(F.slice(messages, F.lit(1), i), F.lit(2), lambda acc, x: acc + size(x)))

    def one(m: Column, i: Column) -> Column:
        at = F.element_at(start, i + 1)
        tools = F.size(m["tool_activity"])
        return F.struct(
            F.transform(m["non_text_parts"], lambda p, k: F.struct(p["kind"].alias("kind"), F.element_at(texts, at + 1 + 3 * tools + k).alias("name"))).alias("non_text_parts"),
            m["role"].alias("role"),
            m["sent_at"].alias("sent_at"),
            F.element_at(texts, at).alias("text"),
            F.transform(m["tool_activity"], lambda t, k: F.struct(*(F.element_at(texts, at + 1 + 3 * k + j).alias(n) for j, n in enumerate(("name", "request", "result"))))).alias("tool_activity"),
        )

    return F.transform(messages, one)


def redaction_counts(df: DataFrame, key: str = "document_id", counts: str = "redactions") -> DataFrame:
    """key, category, n of each category that occurs."""
    return df.select(key, F.explode(counts).alias("category", "n")).where("n > 0").groupBy(key, "category").agg(F.sum("n").alias("n"))
