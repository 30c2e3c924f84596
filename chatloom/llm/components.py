"""Connected components of an undirected graph, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.tables import written


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of edges(a, b). Each round's labels are written, and rounds grow with the logarithm of the longest path."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        heard = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("heard"))
        lower = labels.join(heard, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        at = labels.select(F.col("node").alias("at"), F.col("label").alias("jump"))
        new = written(lower.join(at, F.col("label") == F.col("at"), "left").select("node", F.least("label", F.coalesce("jump", "label")).alias("label"), "old"))
        labels = new.select("node", "label")
        if new.where(F.col("label") != F.col("old")).isEmpty():
            return labels.select("node", F.col("label").alias("component"))
