"""Projects of conversations by alias rules with priorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.aliases import alias_keys, aliases_found
from chatloom.model import UNKNOWN_PROJECT


#: Words of a text, and between them what is neither white space nor part of a word. Letters, digits, _ and - make words.
TOKEN = r"[\p{L}\p{N}_-]+|[^\p{L}\p{N}_\s-]+"
PLAIN = r"^[\p{L}\p{N}_-]+( [\p{L}\p{N}_-]+)*$"


def project_hits(df: DataFrame, rules: DataFrame, key: str, text: str) -> DataFrame:
    """key, project, priority: each project that a text names, once. The rule file is small and validated; its aliases make one trie."""
    keys = [r.alias_key for r in rules.select("alias_key").distinct().collect()]
    found = df.select(key, F.explode(aliases_found(F.col(text), keys)).alias("alias_key"))
    return found.join(rules.select("alias_key", "project", "priority"), "alias_key").select(key, "project", "priority").distinct()


def project_hits_by_join(df: DataFrame, rules: DataFrame, key: str, text: str) -> DataFrame:
    """The same for alias tables of any size whose aliases are plain words: runs of words equi-join the aliases.

    Runs are as long as the longest alias. Where aliases lie inside one another the longest from the left counts and its words are spent, as in
    project_hits: a text's matches are few against its words, and are taken in turn inside the row. An alias with other characters
    than words and spaces raises. Each row is a text of its own, also where keys repeat.
    """
    plain = F.when(F.col("alias_key").rlike(PLAIN), F.col("alias_key")).otherwise(F.raise_error(F.concat(F.lit("not of plain words: "), "alias_key")))
    known = rules.select(plain.alias("alias_key"), "project", "priority")
    longest = known.agg(F.max(F.size(F.split("alias_key", " ")))).first()[0] or 0
    tokens = F.regexp_extract_all(alias_keys(text), F.lit(TOKEN), F.lit(0))

    def runs_from(t: Column, at: Column) -> Column:
        """The runs of up to longest words that begin at a place."""
        lengths = F.sequence(F.lit(1), F.least(F.lit(longest), F.size(t) - at))
        return F.transform(lengths, lambda n: F.struct(at.alias("_at"), n.alias("n"), F.array_join(F.slice(t, at + 1, n), " ").alias("alias_key")))

    places = lambda t: F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda at: F.get(t, at).rlike(PLAIN))
    # The tokens are bound to a name in a lambda: they are taken apart once, and don't go along with each run.
    of_text = F.transform(F.array(tokens), lambda t: F.when(F.size(t) > 0, F.flatten(F.transform(places(t), lambda at: runs_from(t, at)))))[0]
    numbered = df.withColumn("_row", F.monotonically_increasing_id()).where(F.lit(longest > 0))
    runs = numbered.select("_row", key, F.explode(of_text).alias("r")).select("_row", key, "r.*")
    named = runs.join(known.select("alias_key").distinct(), "alias_key", "left_semi")
    in_turn = F.array_sort(F.collect_list(F.struct("_at", (-F.col("n")).alias("less"), "alias_key")))
    spent = F.aggregate(
        "m",
        F.struct(F.lit(0).alias("upto"), F.array().cast("array<string>").alias("kept")),
        lambda acc, x: F.when(x["_at"] < acc["upto"], acc).otherwise(F.struct((x["_at"] - x["less"]).alias("upto"), F.array_union(acc["kept"], F.array(x["alias_key"])).alias("kept"))),
    )
    found = named.groupBy("_row", key).agg(in_turn.alias("m")).select(key, F.explode(spent["kept"]).alias("alias_key"))
    return found.join(known, "alias_key").select(key, "project", "priority").distinct()


def resolved(df: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    """Adds project: the named one of highest priority; none, or a tie at the top, is unknown."""
    best = hits.groupBy(key).agg(F.max(F.struct("priority", "project")).alias("top"), F.collect_set(F.struct("priority", "project")).alias("named"))
    tied = F.size(F.filter("named", lambda n: n["priority"] == F.col("top.priority"))) > 1
    winner = best.select(key, F.when(tied, F.lit(UNKNOWN_PROJECT)).otherwise(F.col("top.project")).alias("_project"))
    return df.join(winner, key, "left").withColumn("project", F.coalesce("_project", F.lit(UNKNOWN_PROJECT))).drop("_project")


def first_known(*answers: Column) -> Column:
    """Chained classifiers: the first answer that isn't unknown."""
    return F.coalesce(*(F.nullif(a, F.lit(UNKNOWN_PROJECT)) for a in answers), F.lit(UNKNOWN_PROJECT))


def rule_conflicts(rules: DataFrame) -> DataFrame:
    """alias_key, projects: aliases that name several projects, after case folding. rules: project, alias."""
    return rules.withColumn("alias_key", alias_keys("alias")).groupBy("alias_key").agg(F.countDistinct("project").alias("projects")).where("projects > 1")
