"""Ranked search against scores of all documents, and that accumulators are limited without a change of results."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from chatloom.llm import lexical, queries
from chatloom.llm.lexical import Best, build_index, kth, ranked_documents, ranked_terms, search, terms_of, windows
from chatloom.llm.tables import written

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def found(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if text else []


def brute(docs, items, k=10):
    terms = [(key, found(text)) for key, text in docs]
    n_docs, n_terms = sum(bool(t) for _, t in terms), sum(len(t) for _, t in terms)
    df = Counter(t for _, ts in terms for t in set(ts))
    tfs = [(key, len(ts), Counter(ts)) for key, ts in terms]
    out = []
    for item, text in items:
        scored = []
        for key, n, tf in tfs:
            m = 100 - 75 + (75 * n * n_docs) // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in found(text) if t in tf)
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


def rows(df):
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()], key=str)


DOCS = [
    (1, "The cat and the dog"), (2, "the the the the"), (3, None), (4, ""), (5, "!!! ..."), (6, "Cat CAT cat naïve ÉCOLE"), (7, "école 42 x2"), (8, "dog"), (8, "dog"), (None, "dog"), (None, None),
    (9, "lazy dog " * 500), (10, "a_b-c d"), (12, "cat"), (11, "cat"),
]
ITEMS = [(1, "the cat"), (2, "dog dog dog"), (3, None), (4, ""), (5, "absent words"), (None, "cat"), (6, "É école naïve"), (6, "lazy"), (1, "the cat"), (7, "42-a")]


def test_equals_scores_of_all(spark):
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in DOCS], "doc_id long, text string, score int, item string").repartition(3)
    items = spark.createDataFrame([(k, t, 5) for k, t in ITEMS], "item_id long, text string, doc_id int")
    assert rows(ranked_documents(docs, items)) == sorted(brute(DOCS, ITEMS), key=str)
    assert rows(ranked_documents(docs, items, k=1)) == sorted(brute(DOCS, ITEMS, 1), key=str)


def test_many_copies_and_ties(spark):
    """A third of all rows are one text; equal scores go by id."""
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(i, "hot words w1 w2 here") for i in range(200)] + [(1000 + i, " ".join(rng.choice(vocabulary, rng.integers(1, 40)))) for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary, 12))) for i in range(20)] + [(99, "w1 hot here")]
    got = ranked_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got) == sorted(brute(docs, items), key=str)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    index = written(build_index(docs))
    whole = sorted(map(tuple, search(index, items).collect()), key=str)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 3)
    assert sorted(map(tuple, search(index, items).collect()), key=str) == whole


@pytest.mark.parametrize("docs,items", [([], ITEMS), (DOCS, []), ([], []), ([(1, None)], ITEMS)])
def test_empty_tables(spark, docs, items):
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rows(ranked_documents(d, i)) == []


def test_accumulators_stop_and_results_stay():
    """Frequent terms make no accumulators once the rare ones decide; what is left out can't be among the best."""
    rng = np.random.default_rng(5)
    for case in range(200):
        n, k = 300, int(rng.integers(1, 12))
        postings = []
        for i in range(int(rng.integers(1, 9))):
            docs = np.sort(rng.choice(n, int(rng.integers(1, n if i else 20)), replace=False))
            postings.append((docs, rng.integers(1, 1000 // (i + 1) ** 2 + 2, len(docs))))
        bounds = [int(adds.max()) for _, adds in postings]
        total = np.zeros(n, np.int64)
        for docs, adds in postings:
            total[docs] += adds
        for bar in (0, int(np.median(total)) + case % 3):
            got, score = ranked_terms(postings, bounds, n, k, bar)
            floor = max(1, bar, kth(total[total > 0], k))
            assert got.tolist() == np.flatnonzero(total >= floor).tolist()
            assert score.tolist() == total[got].tolist()


def test_frequent_terms_make_no_accumulators():
    """Postings beyond the stop are looked up for survivors alone: the document that only they hold never appears."""
    rare, frequent = (np.array([3]), np.array([1000])), (np.arange(100000), np.full(100000, 1))
    got, score = ranked_terms([rare, frequent], [1000, 1], 100000, 1, 0)
    assert got.tolist() == [3] and score.tolist() == [1001]


def test_best_lists():
    best = Best(2)
    best.add(np.array([5, 5, 4]), [None, 7, 1])
    assert best.ids == [7, None] and best.bar() == 5
    best.add(np.array([5, 6]), [2, None])
    assert best.ids == [None, 2] and best.score.tolist() == [6, 5]


def test_windows_cut_between_terms(monkeypatch):
    monkeypatch.setattr(lexical, "WINDOW_BYTES", 16)
    for text in (b"", b"abc", b"one two three four five six seven", b"x" * 100 + b" y", b"x" * 100, b" " * 50, "é à ".encode() * 20):
        assert b"".join(windows(text)) == text
        hashes = np.concatenate([h for h, _ in terms_of([text])] or [np.zeros(0, np.uint64)])
        monkeypatch.setattr(lexical, "WINDOW_BYTES", 1 << 20)
        again = np.concatenate([h for h, _ in terms_of([text])] or [np.zeros(0, np.uint64)])
        monkeypatch.setattr(lexical, "WINDOW_BYTES", 16)
        assert hashes.tolist() == again.tolist()


def test_given_tables_equal_the_sql(spark):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"create view {table} as select * from '/root/testdata/sf0.001/{table}.parquet'")
    want = con.sql(queries.SEARCH_SQL).fetchall()
    got = rows(queries.op12_lexical_search(spark, "/root/testdata/sf0.001"))
    assert got == sorted(want, key=str) and len(got) > 100
