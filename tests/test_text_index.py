"""Recall by the index against a look into all texts."""

import random

import pytest
from pyspark.sql import functions as F

from chatloom.operators import retrieve, text_index


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    rng = random.Random(6)
    texts = [None, "", "a", "ab", "The end", "THE End of it", "straße Über 漢字かな 😀!", "x" * 500, "tab\there\nline"]
    texts += [" ".join(rng.choice(["the", "then", "End", "of", "ab", "zebra", "漢字", "a-b"]) for _ in range(rng.randrange(30))) for _ in range(300)]
    df = spark.createDataFrame([(f"d{i:04}", t, ["project:a"] if i % 2 else []) for i, t in enumerate(texts)], "document_id string, content string, tags array<string>").repartition(4)
    path = str(tmp_path_factory.mktemp("index") / "i")
    text_index.build(df, path)
    return df.cache(), path


@pytest.mark.parametrize("query", ["the", "The En", "e", "ab", "a", "zebra zebra", "then of the", "absent words", "漢", "字か", "ÜBER", "😀!", "end of it", "xxxx", "\n", "t\nl", "!", "q"])
@pytest.mark.parametrize("listed", [1000, 3])
def test_equals_a_look_into_all_texts(spark, kept, query, listed, monkeypatch):
    df, path = kept
    monkeypatch.setattr(text_index, "LISTED", listed)
    if not query.strip():
        with pytest.raises(ValueError):
            text_index.recalled(spark, path, df, query, [], 5)
        return
    for tags in ([], ["project:a"]):
        want = [r.document_id for r in retrieve.recalled(df, query, tags, 20).collect()]
        assert [r.document_id for r in text_index.recalled(spark, path, df, query, tags, 20).collect()] == want


def test_candidates_are_few(spark, kept):
    df, path = kept
    holding = df.where(F.contains(F.lower("content"), F.lit("zebra then end"))).count()
    assert holding <= text_index.candidates(spark, path, "zebra then end").count() < df.count() / 2
    plan = spark.read.parquet(f"{path}/runs").where(F.col("gram").isin("the", "zeb"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(gram" in plan


def test_runs_are_lists_and_first_documents_come_without_a_join(spark, tmp_path, monkeypatch):
    texts = [f"the end of the {i}th night" if i % 3 else "ab" for i in range(400)]
    # Two documents of one key: each holds half of the runs of "ab the".
    rows = [(i, t) for i, t in enumerate(texts)] + [(500, "ab th"), (500, "b the"), (501, "x ab the y")]
    df = spark.createDataFrame(rows, "doc_id bigint, content string").repartition(2).withColumn("tags", F.array().cast("array<string>"))
    text_index.build(df, f"{tmp_path}/i", key="doc_id")
    pairs = [(d, g) for d, (_, t) in enumerate(rows) for g in {f"{t}\0\0"[i : i + 3] for i in range(len(t))}]
    runs = spark.read.parquet(f"{tmp_path}/i/runs")
    assert runs.count() <= 2 * len({g for _, g in pairs}) and runs.agg(F.sum("n")).first()[0] == len(pairs)
    assert [r.document for r in text_index.candidates(spark, f"{tmp_path}/i", "ab the").collect()] == [501]
    monkeypatch.setattr(text_index, "LISTED", 50)
    found = text_index.recalled(spark, f"{tmp_path}/i", df, "Th", [], 10, key="doc_id")
    assert [r.doc_id for r in found.collect()] == [i for i in range(20) if i % 3][:10]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
