"""Mixing sources to target weights by capped water-filling.

Sources share all words by weight; none is repeated more than max_epochs times, and what a clamped
source can't take goes to the others by weight. The level of each source follows from running sums
over the sources in the order in which they clamp, so no loop is needed. Within a source each document is taken whole as
often as the rate says, and once more if its seeded place lies under the fraction; the document on which the
fraction ends gives a part of a repetition. That place is found by radix: sums by hash digit, then only the
rows of the digit in which the fraction ends. Equal rows share a place and count together, so no source or row is ordered as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.tables import written

#: Rows of a source are first told apart by so many hash digits, twice.
DIGITS = 1024
#: Equal rows at which a fraction ends are written out again in parts of so many.
EQUAL_ROWS = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, columns: list[str], seed: int, text: str = "text") -> DataFrame:
    """Each row of docs as _row (the columns), with its _source, _size (words of its text; null: 0) and place.

    The place hashes id, source and text, then all columns but maps and variants, so equal rows have the same one.
    """
    plain = [F.col(f"`{c}`") for c, t in docs.select(*(F.col(f"`{c}`") for c in columns)).dtypes if "map<" not in t and "variant" not in t]
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_row"),
        F.col("source").alias("_source"),
        size.alias("_size"),
        F.xxhash64(F.lit(seed), "doc_id", "source", text).alias("_h"),
        F.xxhash64(F.lit(seed), *plain).alias("_g"),
    )
    return rows.withColumn("_d1", _digit(0)).withColumn("_d2", _digit(1))


def place() -> Column:
    """A row's place in its source's seeded order."""
    return F.struct("_d1", "_d2", "_h", "_size", "_g")


def _digit(level: int) -> Column:
    return F.pmod(F.shiftrightunsigned(F.col("_h"), 10 * level), F.lit(DIGITS)).cast("int")


def water_fill(totals: DataFrame, max_epochs: int, cycle: tuple[int, ...]) -> DataFrame:
    """Targets of sources: source, source_size, target. One row for each source passes through one task: sources are few beside documents.

    totals: source, source_size, one row each. Weights go by the source's order of code points, null last, repeating.
    A source clamps at max_epochs times its size; clamping goes by size over weight, so running
    sums in that order give the level that the unclamped ones share. Sources without words have no share to give or take.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = (F.row_number().over(by_name) - 1) % len(cycle)
    weight = F.element_at(F.array(*map(F.lit, cycle)), (n + 1).cast("int")).cast("double")
    ranked = totals.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    all_rows = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    clamp_order = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = clamp_order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    stepped = ranked.withColumn("level", level).withColumn("open", F.col("cap") > F.col("weight") * F.col("level"))
    # The first source that doesn't clamp sets the level of all that follow.
    shared = stepped.withColumn("share", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"), "level"))).over(all_rows)["level"])
    target = F.when(F.col("share").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("share")))
    return shared.select("source", "source_size", target.alias("target"))


def source_targets(sized: DataFrame, max_epochs: int, cycle: tuple[int, ...]) -> DataFrame:
    """_s, source_size, target, _whole (repetitions of every row) and _quota (words beyond them) of each source."""
    totals = sized.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"))
    words, size = F.round("target").cast("long"), F.nullif(F.col("source_size"), F.lit(0))
    whole = F.coalesce(F.floor(words / size), F.lit(0)).cast("long")
    return written(water_fill(totals, max_epochs, cycle).withColumnRenamed("source", "_s").withColumn("_whole", whole).withColumn("_quota", words - whole * F.col("source_size")))


def fraction_ends(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Where the fraction of each source ends: _s, _end (a place), _m equal rows there, of which _k are taken whole, and one more with _part words."""

    def cut(rows: DataFrame, by: list[str]) -> DataFrame:
        """Of each source, the cell in which _left words end: its columns, what is left there and how many rows it has."""
        cells = rows.groupBy("_source", *by).agg(F.sum("_size").alias("_n"), F.count(F.lit(1)).alias("_m"), F.first("_left").alias("_left"))
        running = cells.withColumn("_left", F.col("_left") - F.sum("_n").over(Window.partitionBy("_source").orderBy(*by)) + F.col("_n"))
        return written(running.where((F.col("_left") >= 0) & (F.col("_left") < F.col("_n"))).select(F.col("_source").alias("_s"), *by, "_left", "_m"))

    def inside(rows: DataFrame, cells: DataFrame, digit: str) -> DataFrame:
        at = cells.select("_s", F.col(digit).alias("_at"), F.col("_left").alias("_rest"))
        return rows.join(at, F.col("_source").eqNullSafe(F.col("_s")) & (F.col(digit) == F.col("_at"))).drop("_s", "_at", "_left").withColumnRenamed("_rest", "_left")

    quota = targets.select("_s", F.col("_quota").alias("_left"))
    rows = sized.drop("_row").join(quota, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = inside(rows, cut(rows, ["_d1"]), "_d1")
    rows = inside(rows, cut(rows, ["_d2"]), "_d2")
    return cut(rows, ["_d1", "_d2", "_h", "_size", "_g"]).select("_s", place().alias("_end"), "_m", F.floor(F.col("_left") / F.col("_size")).cast("long").alias("_k"), (F.col("_left") % F.col("_size")).alias("_part"))


def taken(rows: DataFrame, targets: DataFrame, ends: DataFrame) -> DataFrame:
    """_row, _source, _size, source_size, target, _repeats (whole repetitions) and _part (words of one more) of rows as sizes gives them, each once."""
    ends = ends.withColumnRenamed("_s", "_e")
    marked = rows.join(targets, F.col("_source").eqNullSafe(F.col("_s"))).join(ends, F.col("_source").eqNullSafe(F.col("_e")), "left")
    here = F.coalesce(place() == F.col("_end"), F.lit(False))
    columns = ["_row", "_source", "_size", "source_size", "target"]
    under = F.coalesce(place() < F.col("_end"), F.lit(False))
    alone = F.coalesce(F.col("_m"), F.lit(1)) == 1
    part = F.when(here, F.col("_part")).otherwise(0).cast("long")
    out = marked.where(~here | alone).select(*columns, (F.col("_whole") + under.cast("long")).alias("_repeats"), part.alias("_part"))
    if ends.where("_m > 1").isEmpty():
        return out
    # Equal rows at an end are alike, so one of them stands for all: it is written out so many times.
    one = marked.where(here & ~alone).groupBy("_source").agg(F.first(F.struct(*columns, "_whole", "_m", "_k", "_part")).alias("_one")).select("_one.*")
    last = F.floor((F.col("_m") - 1) / EQUAL_ROWS)
    parts = one.withColumn("_chunk", F.explode(F.sequence(F.lit(0), last))).repartition("_source", "_chunk")
    begin = F.col("_chunk") * EQUAL_ROWS
    each = parts.withColumn("_i", F.explode(F.sequence(begin, F.least(begin + EQUAL_ROWS, F.col("_m")) - 1)))
    extra, rest = (F.col("_i") < F.col("_k")).cast("long"), F.when(F.col("_i") == F.col("_k"), F.col("_part")).otherwise(0).cast("long")
    return out.union(each.select(*columns, (F.col("_whole") + extra).alias("_repeats"), rest.alias("_part")))


def mix_sources(docs: DataFrame, max_epochs: int = 3, cycle: tuple[int, ...] = (5, 2, 1), seed: int = 20240501) -> DataFrame:
    """What a mix of docs' sources takes of each document: doc_id, source, size, source_size, target, repeats, part, taken.

    Each source's taken words are its target, rounded. Null texts have size 0; a null source is a source of its own, last in
    order; null ids and repeated rows are rows like any other, each taken for itself; an empty table gives none. Sources without words have target 0.
    Other columns are not read.
    """
    sized = written(sizes(docs, ["doc_id"], seed))
    targets = source_targets(sized, max_epochs, cycle)
    words = F.col("_repeats") * F.col("_size") + F.col("_part")
    return taken(sized, targets, fraction_ends(sized, targets)).select("_row.doc_id", F.col("_source").alias("source"), F.col("_size").alias("size"), "source_size", "target", F.col("_repeats").alias("repeats"), F.col("_part").alias("part"), words.alias("taken"))


def mixed_documents(docs: DataFrame, max_epochs: int = 3, cycle: tuple[int, ...] = (5, 2, 1), seed: int = 20240501) -> DataFrame:
    """The mix itself: rows of docs (source and text among the columns, whatever the others are named), each as often as it is taken.

    The document on which a source's fraction ends also gives a row with its first words, one space between them, whose n_chars (if
    there is such a column) is its own. Documents without words are kept once. Edge cases are those of mix_sources.
    """
    rows = sizes(docs, docs.columns, seed)
    sized = written(rows.drop("_row"))
    targets = source_targets(sized, max_epochs, cycle)
    marked = taken(rows, targets, fraction_ends(sized, targets))
    times = F.when(F.col("_size") == 0, 1).otherwise(F.col("_repeats")).cast("int")
    ends = F.array_compact(F.array(F.when(F.col("_part") > 0, F.lit(True))))
    copies = marked.select("_row", "_part", F.explode(F.concat(F.array_repeat(F.lit(False), times), ends)).alias("_cut"))
    space = r"[\x20\x09-\x0D]+"
    first_words = F.array_join(F.slice(F.split(F.regexp_replace(F.col("_row.text"), "^" + space, ""), space), F.lit(1), F.col("_part").cast("int")), " ")
    copies = copies.withColumn("_text", F.when(F.col("_cut"), first_words).otherwise(F.col("_row.text")))

    def column(name: str, kind: str) -> Column:
        if name == "text":
            return F.col("_text").alias(name)
        if name == "n_chars":
            return F.when(F.col("_cut"), F.length("_text").cast(kind)).otherwise(F.col("_row.n_chars")).alias(name)
        return F.col(f"_row.`{name}`").alias(name)

    return copies.select(*(column(c, t) for c, t in docs.dtypes))
