"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

L1 leaves few buckets with a weight, so the model that is broadcast stays small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from chatloom.llm.ftrl import Settings, scored, train

SETTINGS = Settings(kind="plain", bits=20, binary=True, alpha=1.0, l1=8.0, l2=0.1, epochs=6, max_rows=16_000, shards=1)
THRESHOLD = 0.3


def toxicity_scores(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None, settings: Settings = SETTINGS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted (1: toxic) of every row of docs.

    Learns from labelled rows of learn_from (docs by default) outside the held-out fold, at most
    settings.max_rows of them. Null and empty texts get the score of a text without features; null ids are scored and
    not learned from; repeated rows are scored each; an empty table gives none. Only id and text of docs are read.
    """
    return scored(docs, train(docs if learn_from is None else learn_from, labels, "toxic", settings), settings, threshold)
