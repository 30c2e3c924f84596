"""A corpus pipeline out of the operators: each stage works on all that the one before kept.

Stages take (spark, docs, sf_dir). All but the last return the columns of documents; the last returns the pieces
of the packed sequences. Rows that share a doc_id are rows of one document and stay or go together in the join stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm import quality, toxicity
from chatloom.llm.ftrl import reaching, train
from chatloom.llm.jaccard import link_components
from chatloom.llm.mixing import mixed_documents
from chatloom.llm.packing import packed_documents
from chatloom.llm.tables import read, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    weights = train(docs, read(spark, sf_dir, "labels"), "quality", quality.SETTINGS)
    return docs.where(reaching(docs, weights, quality.SETTINGS, quality.THRESHOLD))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity model rejects."""
    weights = train(docs, read(spark, sf_dir, "labels"), "toxic", toxicity.SETTINGS)
    return docs.where(~reaching(docs, weights, toxicity.SETTINGS, toxicity.THRESHOLD))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id; documents without an id stay."""
    kept = written(link_components(docs).where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct())
    return docs.join(kept, "doc_id", "left_semi").union(docs.where(F.col("doc_id").isNull())).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources have their target weights."""
    return mixed_documents(docs, max_epochs=3, cycle=(5, 2, 1))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    return packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)


STAGES = [
    ("quality classifier", keep_quality),
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", one_of_each_group),
    ("source mixing", mix),
    ("best-fit packing", pack),
]

#: Learned models and token ids are beyond SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
