"""Quality classifier: hashed word n-gram logistic regression trained by FTRL, scored as sparse dot products."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chatloom.llm.ftrl import Settings, scored, train

#: Word n-grams are taken of the words themselves and of their shapes (letters, capitals, marks, repeats).
SETTINGS = Settings(kind="shaped", bits=18, binary=False, scale=20.0, alpha=0.5, l1=0.2, l2=0.1, epochs=4)
THRESHOLD = 0.7


def quality_scores(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None, settings: Settings = SETTINGS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted (1: good) of every row of docs.

    Learns from labelled rows of learn_from (docs by default) outside the held-out fold, at most
    settings.max_rows of them. Null and empty texts get the score of a text without features; null ids are scored and
    not learned from; repeated rows are scored each; an empty table gives none. Only id and text of docs are read.
    """
    return scored(docs, train(docs if learn_from is None else learn_from, labels, "quality", settings), settings, threshold)
