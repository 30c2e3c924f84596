"""Rows that the registered queries derive from the given tables by fixed rules, as the library's inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.canonical import content_hash, document_id
from chatloom.model import UNKNOWN_PROJECT
from chatloom.operators.conversation import assembled
from chatloom.sources.exports import rules_frame

START = "timestamp '2024-01-01 00:00:00'"
#: Alias rules of frequent words; "que" is a word of two languages.
RULES = [("english", ["the", "of"], 2), ("german", ["der", "die"], 1), ("french", ["des", "les"], 1), ("spanish", ["los", "el"], 1), ("romance", ["que"], 1)]
NODE = "map<string, struct<parent: string, children: array<string>, message: struct<author: struct<role: string>, create_time: bigint, content: struct<content_type: string, parts: array<string>>>>>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as turns: source, source_id, conv_id, pos, role, text, sent_at."""
    sent = F.expr(f"{START} + make_interval(0, 0, 0, 0, cast(conv_id as int), cast(turn as int), 0)")
    return table(spark, sf_dir, "conversations").select(F.lit("chatgpt").alias("source"), F.col("conv_id").cast("string").alias("source_id"), "conv_id", F.col("turn").alias("pos"), "role", "text", sent.alias("sent_at"))


def title(conv_id: Column) -> Column:
    return F.when(conv_id % 5 != 0, F.concat(F.lit("Conversation "), conv_id.cast("string")))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole conversations with conv_id, title, times, messages and content_hash."""
    whole = assembled(turns(spark, sf_dir)).withColumn("conv_id", F.col("source_id").cast("bigint"))
    first, last = (f(F.transform("messages", lambda m: m["sent_at"])) for f in (F.array_min, F.array_max))
    return whole.withColumn("title", title(F.col("conv_id"))).withColumn("started_at", first).withColumn("last_activity_at", last).withColumn("content_hash", content_hash(F.col("messages")))


def state(conversations: DataFrame) -> DataFrame:
    """A state by conv_id modulo 4: imported alike, imported otherwise, failed, never seen."""
    k = F.col("conv_id") % 4
    return conversations.where(k != 3).select(
        "source",
        "source_id",
        F.when(k == 1, F.sha2("content_hash", 256)).otherwise(F.col("content_hash")).alias("content_hash"),
        document_id(F.col("source"), F.col("source_id")).alias("document_id"),
        F.expr(f"{START} + make_interval(0, 0, 0, 0, cast(conv_id as int), 0, 0)").alias("recorded_at"),
        F.when(k == 2, "failed").otherwise("imported").alias("status"),
        F.when(k == 2, F.when(F.col("conv_id") % 8 == 2, "retain").otherwise("odd text")).alias("error"),
    )


def outcomes(decided: DataFrame) -> DataFrame:
    """Outcomes of decisions: every seventh processed conversation fails, at a stage by its number."""
    conv = F.col("source_id").cast("bigint")
    fails = (F.col("decision") == "process") & (conv % 7 == 1)
    stage = F.when(conv % 3 == 0, "retain").when(conv % 3 == 1, "sanitize").otherwise("no stage")
    return decided.select("source", "source_id", F.when(F.col("decision") == "skip", "skipped").when(fails, "failed").otherwise("imported").alias("status"), F.when(fails, stage).alias("error"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw export records: conversations as message graphs. file_no, pos, raw, error.

    Root, then a chain of the turns. Where conv_id % 4 = 1 each even turn has an abandoned sibling, listed first; where
    conv_id % 7 = 3 the current node is missing, so the last child is followed.
    """
    t = turns(spark, sf_dir)
    side = (F.col("conv_id") % 4 == 1) & (F.col("pos") % 2 == 0)
    whole = t.groupBy("source_id", "conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "role", "text", F.unix_seconds("sent_at").alias("at"), side.alias("side")))).alias("t"))

    def name(kind: str, pos: Column) -> Column:
        return F.concat(F.lit(kind), pos.cast("string"))

    def message(x: Column) -> Column:
        return F.struct(F.struct(x["role"].alias("role")).alias("author"), x["at"].alias("create_time"), F.struct(F.lit("text").alias("content_type"), F.array(x["text"]).alias("parts")).alias("content"))

    def child(x: Column) -> Column:
        real = F.array(name("n", x["pos"]))
        return F.when(x["side"], F.concat(F.array(name("x", x["pos"])), real)).otherwise(real)

    def before(i: Column) -> Column:
        return F.coalesce(name("n", F.try_element_at(F.col("t"), F.nullif(i, F.lit(0)))["pos"]), F.lit("root"))

    none = F.array().cast("array<string>")
    after = lambda i: F.coalesce(F.try_element_at(F.transform(F.slice("t", i + 2, F.lit(1)), child), F.lit(1)), none)
    main = F.transform("t", lambda x, i: F.struct(name("n", x["pos"]).alias("k"), F.struct(before(i).alias("parent"), after(i).alias("children"), message(x).alias("message")).alias("v")))
    left = F.transform("t", lambda x, i: F.when(x["side"], F.struct(name("x", x["pos"]).alias("k"), F.struct(before(i).alias("parent"), none.alias("children"), message(x).alias("message")).alias("v"))))
    root = F.array(F.struct(F.lit("root").alias("k"), F.struct(F.lit(None).cast("string").alias("parent"), after(F.lit(-1)).alias("children"), F.lit(None).alias("message")).alias("v")))
    mapping = F.map_from_entries(F.concat(root, main, F.array_compact(left))).cast(NODE)
    current = F.when(F.col("conv_id") % 7 == 3, "gone").otherwise(name("n", F.element_at("t", -1)["pos"]))
    raw = F.to_json(F.struct(F.col("source_id").alias("conversation_id"), title(F.col("conv_id")).alias("title"), F.element_at("t", 1)["at"].alias("create_time"), F.element_at("t", -1)["at"].alias("update_time"), current.alias("current_node"), mapping.alias("mapping")), {"ignoreNullFields": "false"})
    return whole.select(F.lit(0).cast("bigint").alias("file_no"), F.col("conv_id").alias("pos"), raw.alias("raw"), F.lit(None).cast("string").alias("error"), "conv_id")


def rules(spark: SparkSession) -> DataFrame:
    return rules_frame(spark, RULES)


def archive(conversations: DataFrame) -> DataFrame:
    """Conversations with a project by conv_id modulo 3 and what an archive holds."""
    project = F.element_at(F.array(F.lit("alpha"), F.lit("beta"), F.lit(UNKNOWN_PROJECT)), (F.col("conv_id") % 3 + 1).cast("int"))
    return conversations.withColumn("project", project).withColumn("document_id", document_id(F.col("source"), F.col("source_id"))).withColumn("media_type", F.lit("application/json")).withColumn("content", F.encode(F.concat(F.lit("original "), F.col("source_id")), "utf-8"))
