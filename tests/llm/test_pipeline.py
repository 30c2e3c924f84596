"""Each stage of the pipeline on its own input."""

import corpus_pipeline as cp
from chatloom.llm.tables import written
from chatloom.llm.toxicity import toxicity_scores
from chatloom.llm.quality import quality_scores
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    names = [n for n, _ in cp.STAGES]
    assert len(names) == 5
    good = written(cp.keep_quality(spark, docs, SF))
    want = {r.doc_id for r in quality_scores(docs, labels).where("predicted = 1").collect()}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == want
    clean = written(cp.drop_toxic(spark, good, SF))
    want = {r.doc_id for r in toxicity_scores(good, labels).where("predicted = 0").collect()}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == want
    single = written(cp.one_of_each_group(spark, clean, SF))
    sets = {}
    for r in clean.collect():
        w = r.text.encode().lower().split()
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
    kept = {r.doc_id for r in single.collect()}
    alike = lambda a, b: bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)
    assert single.columns == docs.columns and not any(i < j and alike(sets[i], sets[j]) for i in kept for j in kept)
    assert all(any(alike(sets[d], sets[o]) for o in sets if o != d) for d in sets if d not in kept)
    mixed = written(cp.mix(spark, single, SF))
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= kept
    packed = cp.pack(spark, mixed, SF)
    assert packed.agg(F.sum("length")).first()[0] >= packed.count() and packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def _folder(tmp_path, docs, labels):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_run_equals_its_stages_on_odd_rows(spark, tmp_path):
    """Nulls, empty texts, a long text, repeated rows and columns with the names that stages use themselves."""
    given = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = [(None, None), (None, "no id"), (5001, None), (5002, ""), (5003, " \n"), (5004, "word " * 30_000), (5005, "same text here and there again"), (5005, "same text here and there again")]
    more = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long")
    clashing = {c: F.lit(3) for c in ("_id", "label", "score", "component_id", "size", "taken", "target", "length", "bin", "piece", "n", "row")}
    docs = given.select(*[F.col(f.name).cast(f.dataType) for f in more.schema]).unionByName(more).withColumns(clashing)
    sf = _folder(tmp_path, docs, spark.read.parquet(f"{SF}/labels.parquet"))
    step = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        step = written(stage(spark, step, sf))
        assert step.columns == docs.columns
    sizes = lambda df: sorted((str(r.doc_id), r.tokens) for r in df.groupBy("doc_id").agg(F.sum("length").alias("tokens")).collect())
    assert sizes(cp.run(spark, sf)) == sizes(cp.pack(spark, step, sf))


def test_run_on_empty_tables(spark, tmp_path):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    assert cp.run(spark, _folder(tmp_path / "a", docs.limit(0), labels.limit(0))).count() == 0
    assert cp.run(spark, _folder(tmp_path / "b", docs.limit(0), labels)).count() == 0


def test_no_labels_reject_nothing_but_by_the_score_without_features(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    sf = _folder(tmp_path, docs, spark.read.parquet(f"{SF}/labels.parquet").limit(0))
    assert cp.drop_toxic(spark, docs, sf).count() == 0  # each score is 0.5, and 0.3 is the threshold
    assert cp.keep_quality(spark, docs, sf).count() == 0
