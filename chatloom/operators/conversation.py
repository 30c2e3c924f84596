"""Export records to normalized conversations, with an account of every node; bad records leave with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.model import KINDS, ROLES, SLUG, SOURCES
from chatloom.operators import content
from chatloom.operators.graph import field, kind, mapping_of, text_field, with_links, with_thread

#: Columns of the account, each a count of nodes; together they make up nodes.
COUNTS = ("turns", "folded_tool_results", "structural", "hidden", "hidden_reasoning", "abandoned_branch")
_SURROGATE = r"\\u[dD][89a-fA-F][0-9a-fA-F]{2}"


def native_id(record: Column) -> Column:
    """The first non-empty string of conversation_id and id."""
    return F.coalesce(*(F.nullif(text_field(record, f"$.{n}"), F.lit("")) for n in ("conversation_id", "id")))


def lone_surrogate(raw: Column) -> Column:
    """Whether JSON text escapes an unpaired surrogate. Pairs and escaped backslashes are taken out first."""
    bare = F.regexp_replace(F.replace(raw, F.lit("\\\\"), F.lit("")), r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}", "")
    return bare.rlike(_SURROGATE)


def parsed(records: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds to raw JSON records: source_id, title, times, messages, the account, and reject_reason (null if sound).

    One record never stops the others: a bad one has a reason and no messages. Reasons name the rule, not content.
    """
    df = records.withColumn("_v", F.try_parse_json(raw)).withColumn("source_id", native_id(F.col("_v"))).withColumn("mapping", mapping_of(F.col("_v"))).withColumn("current_node", text_field(F.col("_v"), "$.current_node"))
    df = with_thread(with_links(df))
    bodies = F.transform("path", lambda i: field(F.col("entries")[i]["value"], "$.message"))
    given = F.filter("_bodies", lambda b: b.isNotNull() & (kind(b) != "VOID"))
    shown = F.filter("_given", lambda b: ~content.hidden(b))
    read = F.filter("_shown", lambda b: ~content.hidden_reasoning(b))
    df = df.withColumn("_bodies", bodies).withColumn("_given", given).withColumn("_shown", shown).withColumn("_read", read)
    df = df.withColumn("_turns", F.transform("_read", content.turn)).withColumn("messages", content.folded(F.col("_turns")))
    created, updated = field(F.col("_v"), "$.create_time"), field(F.col("_v"), "$.update_time")
    first_turn = F.array_min(F.transform("messages", lambda m: m["sent_at"]))
    df = df.withColumn("started_at", F.coalesce(content.export_time(created), first_turn)).withColumn("_updated", content.export_time(updated))
    reason = (
        F.when(F.col("_v").isNull(), "not_json")
        .when(kind(F.col("_v")) != "OBJECT", "not_an_object")
        .when(F.col("source_id").isNull(), "no_identifier")
        .when(F.col("defect").isNotNull(), F.col("defect"))
        .when(F.exists("_given", lambda b: kind(b) != "OBJECT"), "message_not_an_object")
        .when(F.exists("_given", lambda b: content.role(b).isNull()), "unknown_role")
        .when(content.any_of(content.bad_time(created), content.bad_time(updated), F.exists("_read", lambda b: content.bad_time(field(b, "$.create_time")))), "bad_time")
        .when(F.col("started_at").isNull(), "no_time")
        .when(lone_surrogate(F.col(raw)), "not_utf8")
    )
    df = df.withColumn("reject_reason", reason)
    late = F.coalesce(F.col("_updated") < F.col("started_at"), F.lit(False))
    columns = {
        "title": text_field(F.col("_v"), "$.title"),
        "last_activity_at": F.when(~late, F.col("_updated")),
        "nodes": F.size("links"),
        "turns": F.size("messages"),
        "folded_tool_results": F.size("_turns") - F.size("messages"),
        "structural": F.size("_bodies") - F.size("_given"),
        "hidden": F.size("_given") - F.size("_shown"),
        "hidden_reasoning": F.size("_shown") - F.size("_read"),
        "abandoned_branch": F.col("abandoned"),
        "start_from_messages": content.export_time(created).isNull(),
        "inconsistent_times": late,
        "unrecognized_types": F.array_sort(F.array_distinct(F.flatten(F.transform("_read", content.unrecognized)))),
    }
    good = F.col("reject_reason").isNull()
    df = df.withColumns({n: F.when(good, c) for n, c in columns.items()} | {n: F.when(good, F.col(n)) for n in ("messages", "started_at", "fallback_branch")})
    kept = [*records.columns, "source_id", "title", "started_at", "last_activity_at", "messages", "nodes", *COUNTS, "fallback_branch", "start_from_messages", "inconsistent_times", "unrecognized_types", "reject_reason"]
    return df.select(*kept)


def balanced() -> Column:
    """Whether an account's counts make up all nodes."""
    return sum((F.col(c) for c in COUNTS[1:]), F.col(COUNTS[0])) == F.col("nodes")


def split_duplicates(df: DataFrame, key: str = "source_id", order: tuple[str, ...] = ("file_no", "pos")) -> DataFrame:
    """Marks later readable records of an id as duplicates: the first is kept. Only ids and places are shuffled."""
    place = df.where(F.col("reject_reason").isNull()).select(key, *order)
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    later = place.withColumn("_n", n).where("_n > 1").drop("_n").withColumn("_later", F.lit("duplicate_id"))
    return df.join(later, [key, *order], "left").withColumn("reject_reason", F.coalesce("reject_reason", "_later")).drop("_later")


def assembled(turns: DataFrame) -> DataFrame:
    """Ordered conversations from turns(source, source_id, pos, role, text, sent_at): order is pos, never time."""
    each = F.struct("pos", F.struct(F.expr("cast(array() as array<struct<kind: string, name: string>>)").alias("non_text_parts"), F.col("role"), F.col("sent_at"), F.col("text"), F.expr("cast(array() as array<struct<name: string, request: string, result: string>>)").alias("tool_activity")).alias("m"))
    return turns.groupBy("source", "source_id").agg(F.transform(F.array_sort(F.collect_list(each)), lambda x: x["m"]).alias("messages"))


def field_defect() -> Column:
    """The first rule that a normalized conversation's fields break, or null."""
    messages = F.col("messages")
    return (
        F.when(F.col("source").isNull() | ~F.col("source").isin(*SOURCES), "source")
        .when(F.col("source_id").isNull() | (F.col("source_id") == "") | F.col("source_id").rlike(r"[\s\p{Cc}\p{Z}]"), "source_id")
        .when(F.col("started_at").isNull(), "started_at")
        .when(F.col("last_activity_at") < F.col("started_at"), "last_activity_at")
        .when(F.exists(messages, lambda m: m["role"].isNull() | ~m["role"].isin(*ROLES)), "role")
        .when(F.exists(messages, lambda m: F.exists(m["non_text_parts"], lambda p: p["kind"].isNull() | ~p["kind"].isin(*KINDS))), "kind")
        .when(F.exists(messages, lambda m: F.exists(m["tool_activity"], lambda t: t["name"].isNull() | (t["name"] == ""))), "tool_name")
    )


def is_slug(value: Column) -> Column:
    return F.coalesce(value.rlike(SLUG), F.lit(False))
