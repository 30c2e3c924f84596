"""Each operator against a brute-force version or the library it stands for, and on odd input."""

import math
import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chatloom.llm import ftrl, html_text, jaccard, mixing, packing, quality, quality_rules, topk, toxicity
from chatloom.llm.bpe_counts import token_counts
from chatloom.llm.components import components
from chatloom.llm.html_text import extract
from chatloom.llm.jaccard import link_components
from chatloom.llm.maxent import Shape, language_scores
from chatloom.llm.mixing import mix_sources, mixed_documents
from chatloom.llm.packing import best_fit, packed_documents
from chatloom.llm.quality import quality_scores
from chatloom.llm.textbytes import words
from chatloom.llm.topk import top_k

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, n long, size long, node long, score double"
ODD = [
    (0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "one"), (5, "Straße ÀÉ ﬁ İ ²½ Ⅷ 日本語 😀 á"), (6, "it's <|endoftext|> <|startoftext|> we'll!?"),
    (7, "x" * 5000), (8, "word " * 3000), (None, "no id here at all"), (9, "a\x1cb c\xa0d\x85e  f"), (9, "a\x1cb c\xa0d\x85e  f"), (10, "| a | b |\n\n- c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", [None, "s1", "s2"][k % 3], None, 1, 2, 3, 0.5) for k, (i, t) in enumerate(ODD)], COLUMNS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def token_lists(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_token_counts_equal_the_library(odd, docs):
    for df in (odd, docs):
        rows = df.select("doc_id", "text").collect()
        want = Counter((r.doc_id, len((r.text or "").encode()), len(ids), len(ids) > 1024) for r, ids in zip(rows, token_lists(BYTE, [r.text or "" for r in rows]), strict=True))
        assert Counter(tuple(r) for r in token_counts(df, BYTE).collect()) == want
    assert token_counts(odd.limit(0), BYTE).count() == 0


def test_packing_is_a_partition_of_all_tokens(odd, docs):
    for df in (odd, docs):
        got = rows_of(packed_documents(df, WORD))
        bins = {}
        for r in got:
            bins.setdefault(r["sequence_id"], []).append(r)
        for rows in bins.values():
            at = 0
            for r in sorted(rows, key=lambda r: r["offset"]):
                assert r["offset"] == at
                at += r["length"]
            assert at <= 4096
        source = df.select("doc_id", "text").collect()
        want = Counter()
        total = 0
        for r, ids in zip(source, token_lists(WORD, [r.text or "" for r in source]), strict=True):
            ids = [*ids, 1]
            total += len(ids)
            for p in range(0, len(ids), 4096):
                part = np.array(ids[p : p + 4096], "<u4")
                want[r.doc_id, p // 4096, p, len(part), zlib.crc32(part.tobytes())] += 1
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
        assert len(bins) <= total / 4096 * 1.05 + 1
    assert packed_documents(odd.limit(0), WORD).count() == 0


def test_units_are_pre_tokens():
    pieces = ["'", "''", "'s", "'S", "'re", "'d", "a", "É", "ß", "×", "1", ",", "<", "<|endoftext|>", "ve", "ll", "—", "\x1f", "\x7f", "é", "日", " ", "x"]
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(pieces, rng.integers(0, 30))) for _ in range(4000)]
    ids = packing.WordIds(WORD)
    for kept in (packing.KEPT_BYTES, 1000):
        packing.KEPT_BYTES = kept
        assert [x.tolist() for x in ids.encode([t.encode() for t in texts])] == token_lists(WORD, texts)
    packing.KEPT_BYTES = 1 << 25


def test_packing_leaves_out_of_the_tree_what_nothing_fits(spark):
    # All items exceed half a sequence: none fits another, so no round is made.
    items = spark.range(5000, numPartitions=8).select(F.col("id"), (F.lit(2500) + F.col("id") % 7).alias("length"))
    packed = packing.pack(items, 4096)
    assert packed.select("sequence_id").distinct().count() == 5000 and "Join" not in packed._jdf.queryExecution().toString()
    # Small items fill bins in tasks of bounded size, round by round.
    packing.BLOCK_ITEMS = 500
    items = spark.range(8000, numPartitions=40).select(F.col("id"), (F.xxhash64("id") % 800 + 1000).alias("length"))
    packed = packing.pack(items, 4096)
    assert packed.select("sequence_id").distinct().count() <= 1.12 * items.agg(F.sum("length")).first()[0] / 4096
    places = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert places.where("n > 4096 or n <> end").count() == 0
    packing.BLOCK_ITEMS = 1 << 16


def test_best_fit_takes_the_fullest_bin():
    bins, offset, fill = best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offset.tolist() == [0, 0, 6, 5, 8] and fill.tolist() == [10, 10]


def test_mixing_meets_targets(odd, docs):
    for df in (odd, docs):
        got = rows_of(mix_sources(df))
        assert len(got) == df.count() and sorted(map(str, got)) == sorted(map(str, rows_of(mix_sources(df))))
        sizes = Counter()
        for r in df.collect():
            sizes[r.source] += len((r.text or "").encode().split())
        order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
        target, open_, left = {}, set(order), float(sum(sizes.values()))
        while open_:
            share = left / sum(weight[s] for s in open_)
            over = [s for s in open_ if weight[s] * share >= 3 * sizes[s]]
            for s in over or list(open_):
                target[s] = 3.0 * sizes[s] if over else weight[s] * share
                left -= target[s]
                open_.discard(s)
        for s in order:
            mine = [r for r in got if r["source"] == s]
            assert all(math.isclose(r["target"], target[s], rel_tol=1e-9, abs_tol=1e-9) and r["source_size"] == sizes[s] and 0 <= r["taken"] <= 3 * r["size"] for r in mine)
            assert abs(sum(r["taken"] for r in mine) - target[s]) <= 1
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    taken = {r["doc_id"]: r["taken"] for r in rows_of(mix_sources(docs))}
    again = Counter()
    for r in mixed.collect():
        again[r.doc_id] += len(r.text.encode().split())
    assert all(again[d] == t for d, t in taken.items())
    assert mix_sources(odd.limit(0)).count() == 0


def test_mixing_takes_repeated_rows(spark):
    # Null ids and ids that stand often: all rows of a source are alike, and its fraction ends among them.
    made = [(None if k % 2 else 7, "a b c d e", f"s{k % 2}", k % 2) for k in range(1000)] + [(k, "x y z", "s2", k) for k in range(50)]
    df = spark.createDataFrame(made, "doc_id long, text string, source string, part long")
    for many in (100_000, 7):
        mixing.EQUAL_ROWS = many
        got = rows_of(mix_sources(df))
        assert len(got) == len(made)
        for s in ("s0", "s1", "s2"):
            mine = [r for r in got if r["source"] == s]
            assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 1 and all(r["taken"] <= 3 * r["size"] for r in mine)
    mixing.EQUAL_ROWS = 100_000


def test_mixed_documents_have_any_columns(spark, docs):
    odd_names = docs.select("*", *(F.lit(k).alias(n) for k, n in enumerate(("size", "target", "part", "repeats", "taken", "rate", "source_size", "_size", "a.b"))), F.create_map(F.lit("k"), F.lit(1)).alias("m"))
    mixed = mixed_documents(odd_names.union(odd_names))
    assert mixed.columns == odd_names.columns
    words_ = Counter()
    for r in mixed.collect():
        words_[r.source] += len(r.text.encode().split())
        assert r["part"] == 2 and r["a.b"] == 8
    want = {r["source"]: r["target"] for r in rows_of(mix_sources(docs.union(docs)))}
    assert all(abs(words_[s] - want[s]) <= 1 for s in want)


def brute_components(rows):
    sets = {}
    for k, (_, t) in enumerate(rows):
        w = (t or "").encode().lower().split()
        sets[k] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])
    group = list(range(len(rows)))
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = group[i], group[j]
                    group = [min(a, b) if g in (a, b) else g for g in group]
    least = {}
    for k, g in enumerate(group):
        if rows[k][0] is not None:
            least[g] = min(least.get(g, rows[k][0]), rows[k][0])
    return Counter((rows[k][0], len(sets[k]), least.get(group[k]) if rows[k][0] is not None else None) for k in sets)


def test_jaccard_components_equal_brute_force(spark, odd, docs, monkeypatch):
    # A chain in which only neighbours are alike, stars of near copies, a shared passage, and copies.
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    chain = [" ".join(base[5 * i : 5 * i + 60]) for i in range(25)]
    stars = []
    for _ in range(60):
        w = base[:150].copy()
        for p in rng.integers(0, 150, rng.integers(0, 9)):
            w[p] = f"x{rng.integers(1000)}"
        stars.append(" ".join(w))
    shared = [" ".join([f"u{i}_{j}" for j in range(rng.integers(5, 60))] + base[150:]) for i in range(60)]
    made = [(i, t) for i, t in enumerate([*chain, *stars, *shared, *stars[:5], "one two", "ONE two"])]
    for df in (odd, spark.createDataFrame(made, "doc_id long, text string"), docs):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        assert Counter(tuple(r) for r in link_components(df).collect()) == brute_components(rows)
    assert link_components(odd.limit(0)).count() == 0
    # Constants choose the plan, not the links; and an id may have several texts.
    few = [*made[:6], *made[25:33], *made[85:91], *made[-4:]]
    twice = spark.createDataFrame([*few, *((i, t + " and more words at the end") for i, t in few[::3]), (0, "another text of its own in a few words")], "doc_id long, text string")
    rows = [(r.doc_id, r.text) for r in twice.collect()]
    for name in ("SENT_IDS", "LONG_LIST", "AGAIN", "LOCAL_NAMED", "FREQUENT", "PIVOT_PAIRS", "COUNTED"):
        monkeypatch.setattr(jaccard, name, 1)
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 8)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 500)
    assert Counter(tuple(r) for r in link_components(twice).collect()) == brute_components(rows)


def test_parity_bits_never_overstate_a_difference():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x, y = (np.unique(rng.integers(0, 2**63, rng.integers(1, 400), dtype=np.uint64)) for _ in range(2))
        y = np.unique(np.concatenate([y, x[: rng.integers(0, len(x) + 1)]]))
        assert jaccard.least_difference(jaccard.parity_bits(x), jaccard.parity_bits(y)) <= len(np.setxor1d(x, y))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100)], "a long, b long")
    assert {tuple(r) for r in components(edges).collect()} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}


def best_of_all(rows, k=20, every=20):
    """Each row that asks against each other row."""
    good = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for n, (q, mine) in enumerate(good):
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(mine, v, strict=True)), i) for m, (i, v) in enumerate(good) if m != n and len(v) == len(mine))[:k]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(want)


def test_top_k_is_exact(spark):
    """Repeated ids with equal and with other vectors each ask for themselves, and are candidates of one another."""
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)] + [(300 + i, [0.5] * 6) for i in range(60)]
    rows += [(400, None), (420, [None] * 6), (440, [float("nan")] * 6), (None, [1.0] * 6), (460, [1.0, 2.0]), (20, rows[20][1]), (20, [2.0] * 6), (40, rows[41][1]), (-20, [0.25] * 6)]
    df = spark.createDataFrame([(*r, 7, 7, 7) for r in rows], "vec_id long, embedding array<float>, label int, rank int, row int").repartition(5)
    assert sorted(tuple(r) for r in top_k(df).collect()) == best_of_all(rows)
    assert top_k(df.limit(0)).count() == 0


def test_top_k_in_small_blocks_and_tiles(monkeypatch):
    """Running lists over shards, in this process."""
    rng = np.random.default_rng(4)
    monkeypatch.setattr(topk, "PRODUCT_ROWS", 7)
    for n, q, k in ((50, 12, 3), (400, 30, 5), (8, 8, 20)):
        v = rng.integers(-3, 4, (n, 4)).astype(float)
        ids, rows = rng.integers(0, n // 2 + 1, n), np.arange(n)
        asks = np.sort(rng.choice(n, q, replace=False))
        lists = topk.Lists(rows[asks], ids[asks], v[asks], k)
        for at in range(0, n, 37):
            lists.add(rows[at : at + 37], ids[at : at + 37], v[at : at + 37])
        for i, a in enumerate(asks):
            want = sorted((-int(v[a] @ v[b]), int(ids[b])) for b in range(n) if b != a)[:k]
            mine = lists.query == i
            assert list(zip((-lists.score[mine]).tolist(), lists.vec_id[mine].tolist(), strict=True)) == want


def test_top_k_of_several_blocks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i // 2, [float(x) for x in rng.normal(size=3)]) for i in range(200)]
    monkeypatch.setattr(topk, "BLOCK_COMPONENTS", 10)
    got = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=4, every=5)
    assert sorted(tuple(r) for r in got.collect()) == best_of_all(rows, 4, 5)


def test_classifiers_learn_and_take_odd_rows(odd, docs, labels):
    known = {r.doc_id: r for r in labels.collect()}
    for f, label, threshold in ((quality_scores, "quality", 0.7),):
        got = rows_of(f(docs, labels))
        assert len(got) == docs.count()
        for r in got:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= threshold)
        judged = [r["predicted"] == known[r["doc_id"]][label] for r in got if r["doc_id"] in known]
        assert sum(judged) > 0.9 * len(judged)
    for f in (quality_scores, toxicity.toxicity_scores):
        assert f(odd, labels).count() == odd.count() and f(odd.limit(0), labels).count() == 0
        assert {r["score"] for r in rows_of(f(odd, labels.limit(0)))} == {0.5}


def test_training_rows_are_bounded_however_often_an_id_stands(spark):
    """One labelled id makes up nearly all rows: it teaches once, and all others that were chosen teach too."""
    often = spark.range(50_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("copy "), (F.col("id") % 3).cast("string")).alias("text"))
    docs = often.union(spark.range(10, 40).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text"))).repartition(4)
    labels = docs.select("doc_id").distinct().withColumn("quality", (F.col("doc_id") % 2).cast("int"))
    for most in (10, 100):
        s = replace(quality.SETTINGS, max_rows=most)
        rows = ftrl.hashed(docs, labels, "quality", s, "doc_id", "text")
        chosen = ftrl.sample(labels, "quality", s).count()
        assert rows.count() == chosen <= 2 * most
        assert ftrl.train(docs, labels, "quality", s).any() or chosen < 2


def test_toxicity_finds_one_bad_word_in_a_long_text():
    rng = np.random.default_rng(2)
    text = lambda bad: " ".join([*(f"w{i}" for i in rng.integers(0, 500, 300)), *(["Awful,"] if bad else [])]).encode()
    labels = np.array([float(i % 5 == 0) for i in range(600)])
    rows = [b for b, _ in toxicity.SETTINGS.rows([text(x) for x in labels])]
    at, w, _ = ftrl.learned(np.concatenate(rows), None, np.concatenate([[0], np.cumsum([len(b) for b in rows])]), labels, toxicity.SETTINGS)
    at, w = at[w != 0], w[w != 0]
    weights = np.zeros((1 << toxicity.SETTINGS.bits) + 1)
    weights[at] = w
    p = ftrl.score_texts([text(i % 2) for i in range(100)], weights, toxicity.SETTINGS)
    assert all((p >= 0.3) == (np.arange(100) % 2 == 1)) and len(at) < 500


def test_ftrl_equals_its_formulas():
    # Update by update, with dictionaries.
    s = ftrl.Settings(kind="plain", bits=6, binary=False, alpha=0.5, l1=0.05, l2=0.1, epochs=2)
    rng = np.random.default_rng(3)
    rows = [(np.sort(rng.choice(64, rng.integers(0, 9), replace=False)).astype(np.int32), rng.random(9).astype(np.float32)) for _ in range(40)]
    rows = [(b, x[: len(b)]) for b, x in rows]
    labels = rng.integers(0, 2, 40).astype(float)
    z, n = Counter(), Counter()
    weight = lambda k: 0.0 if abs(z[k]) <= (s.l1 if k < 64 else 0) else -math.copysign(abs(z[k]) - (s.l1 if k < 64 else 0), z[k]) / ((s.beta + math.sqrt(n[k])) / s.alpha + s.l2)
    order = np.random.default_rng(s.seed)
    full = np.array([i for i, (b, _) in enumerate(rows) if len(b)])
    for _ in range(s.epochs):
        for i in order.permutation(full):
            x = dict(zip([*rows[i][0].tolist(), 64], [*rows[i][1].astype(float).tolist(), 1.0], strict=True))
            w = {k: weight(k) for k in x}
            p = 1 / (1 + math.exp(-sum(w[k] * x[k] for k in x)))
            for k, v in x.items():
                g = (p - labels[i]) * v
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / s.alpha * w[k]
                n[k] += g * g
    at, w, seen = ftrl.learned(np.concatenate([b for b, _ in rows]), np.concatenate([x for _, x in rows]), np.concatenate([[0], np.cumsum([len(b) for b, _ in rows])]), labels, s)
    assert at.tolist() == sorted(k for k in n if n[k]) and np.allclose(w, [weight(k) for k in at.tolist()], atol=1e-5) and np.allclose(seen, [n[k] for k in at.tolist()], atol=1e-5)


def test_language_scores(spark, odd, docs):
    for df in (odd, docs):
        got = rows_of(language_scores(df))
        assert len(got) == df.count()
        tokens = lambda t: [*(t or "").encode().lower().split(), None]
        c = Counter()
        for r in df.collect():
            if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 10:
                c.update(tokens(r.text))
        n, v = sum(c.values()), len(c)
        want = Counter()
        for r in df.collect():
            w = tokens(r.text)
            base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
            want[r.doc_id, r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0, len(w), sum(c[x] > 0 for x in w), n, round(base, 4)] += 1
        assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
        assert all(r["score"] < 0 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert language_scores(odd.limit(0)).count() == 0


def test_language_model_is_a_distribution():
    from chatloom.llm.maxent import END, Trainer, Vocabulary, tokens

    texts = [" ".join(np.random.default_rng(i).choice(list("abcdefgh"), 50)).encode() for i in range(50)]
    found = [tokens(w) for w in words(texts)]
    word, n = np.unique(np.concatenate([t for t, _ in found]), return_counts=True)
    v = Vocabulary(word, n, int(n.sum()), len(word), Shape(classes=2, words=3))
    model = Trainer(v)
    for t, b in found:
        model.learn(t, b)
    # After the same two words, the probabilities of all known words and of the rest sum to 1.
    rest = word[v.ids(word) < 0][:1]
    each = [model.log_probability(np.array([word[0], word[1], x, END], np.uint64), np.array([0, 4]))[2] for x in [*word[v.ids(word) >= 0], *rest]]
    assert math.isclose(sum(map(math.exp, each)), 1, rel_tol=1e-4)


def test_language_model_chooses_rare_words_by_context():
    from chatloom.llm.maxent import Trainer, Vocabulary, tokens

    # Of 1,200 words that are equally frequent, each b follows its a; all but 4 are outside the classes.
    rng = np.random.default_rng(4)
    texts = [" ".join(f"a{i} b{i}" for i in rng.permutation(600)).encode() for _ in range(60)]
    found = [tokens(w) for w in words(texts)]
    word, n = np.unique(np.concatenate([t for t, _ in found]), return_counts=True)
    v = Vocabulary(word, n, int(n.sum()), len(word), Shape(classes=2, words=2, batch=4096))
    model = Trainer(v)
    for t, b in found:
        model.learn(t, b)
    (t, b), = [tokens(w) for w in words([b" ".join(b"a%d b%d" % (i, j) for i, j in zip(range(600), [*range(300), *range(301, 600), 300], strict=True))])]
    p = model.log_probability(t, b)[1::2][:600]
    assert p[:300].mean() > p[300:].mean() + 2
    # Words outside the vocabulary are chosen among by their leaves.
    few = np.argsort(n)[-1:]
    leaves = np.full(256, 0.1) + np.bincount(word >> np.uint64(56), n, minlength=256)
    v = Vocabulary(word[few], n[few], int(n.sum()), len(word), Shape(classes=2, words=2, batch=4096), leaves)
    model = Trainer(v)
    for x, y in found:
        model.learn(x, y)
    p = model.log_probability(t, b)[1::2][:600]
    assert p[:300].mean() > p[300:].mean() + 1
    assert Shape().grown(1 << 30).bits > Shape().grown(1 << 20).bits == Shape().bits


def test_language_model_sends_a_share_of_the_corpus():
    from chatloom.llm.maxent import Trainer, Vocabulary

    # Weights and sums that all shards send in all rounds, against about 6 bytes of input a token; half a GB took 11 bytes a token.
    sent = {}
    for tokens_ in (1 << 24, 85_000_000, 1 << 30, 5_000_000_000):
        shape = Shape().grown(tokens_)
        word = np.arange(2000, dtype=np.uint64) << np.uint64(50)
        model = Trainer(Vocabulary(word, np.full(2000, tokens_ // 2000), tokens_, 2000, shape))
        # Two bytes for a weight and two for a bucket's sum.
        sent[tokens_] = shape.rounds * shape.shards * sum(2 * getattr(model, f"{x}_w").size + 2 * len(getattr(model, f"{x}_g")) for x in ("class", "word", "tree"))
    # A tree's choice takes one weight of a context, not one for each branch.
    assert model.tree_w.ndim == 1
    assert all(n < 8 * k for k, n in sent.items() if k > 1 << 24)


def test_language_model_steps_equal_brute_force():
    from chatloom.llm.maxent import FIRST_SUM, Trainer, Vocabulary

    rng = np.random.default_rng(9)
    word = np.sort(rng.integers(0, 1 << 63, 700, dtype=np.uint64) * np.uint64(2))
    n = rng.integers(1, 90, 700)
    v = Vocabulary(word, n, int(n.sum()), 700, Shape(classes=3, words=4, width=4))
    # Words are found by slots as by a search, and others aren't.
    others = word + np.uint64(1)
    assert v.find(word).tolist() == list(range(700)) and (v.find(others) == -1).all() and v.find(word[:0]).size == 0
    assert (Vocabulary(word[:0], n[:0], 0, 0, Shape()).find(others) == -1).all()
    # Without weights a word's probability is its share of all counts and the smoothed rest.
    model = Trainer(v)
    p = np.exp(model.log_probability(word, np.array([0, 700])))
    assert np.allclose(p, n / (n.sum() + v.leaves.sum()), rtol=1e-3)
    # A step moves each bucket by its tokens' summed errors, over the root of their number and of the squares so far: few buckets of many, many of few, and one for all.
    for buckets, width in ((5000, 1), (40, 1), (40, 3), (5000, 3)):
        errors = rng.normal(size=(width, 300))
        rows = [100 + rng.integers(0, buckets, 300), np.array([7])]
        weights = rng.normal(size=(buckets + 100, width) if width > 1 else buckets + 100).astype(np.float32)
        sums, want, squares = np.full(len(weights), FIRST_SUM), weights.astype(float).reshape(len(weights), width), np.full(len(weights), float(FIRST_SUM))
        for r in rows:
            r = np.broadcast_to(r, 300)
            for b in set(r.tolist()):
                g = errors[:, r == b].sum(axis=1) / math.sqrt((r == b).sum())
                squares[b] += (g * g).mean()
                want[b] -= model.s.rate * g / math.sqrt(squares[b])
        model._step(weights, sums, rows, errors)
        assert np.allclose(weights.reshape(len(weights), width), want, atol=1e-4) and np.allclose(sums, squares, rtol=1e-4)


def test_quality_rules_equal_brute_force(odd, docs, labels):
    for df in (odd, docs):
        got = quality_rules.quality_rules(df, labels)
        want = Counter()
        for r in df.collect():
            t = r.text or ""
            w = re.findall("[^\x20\x09-\x0d]+", t)
            grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
            inside = {k for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
            lines = [x for x in t.split("\n") if x.strip(" \t\x0b\x0c\r")]
            failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
            want[r.doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside), failed] += 1
        rows = got.collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == want
        assert not any(r.kept for r in rows if r.base_failed)
    assert quality_rules.quality_rules(odd.limit(0), labels).count() == 0


def test_trusted_text_is_counted_over_all_good_rows(spark):
    texts = spark.createDataFrame([(i, f"w{i} w{i + 1} and w{7 * i}") for i in range(300)], "doc_id long, text string")
    good = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    # All rows are good, so trusted and raw text are the same.
    assert {r.log_ratio for r in quality_rules.quality_rules(texts, good).collect()} == {0.0}


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a<b) x="</p>";</script></head><body><nav><ul><li><a href="/">Home page</a></ul></nav>
<div class="cookie-notice">We use cookies here</div>{open}<h1>Head &amp; <i>tail</i></h1><p>First<br>para with <b>bold</b>ness &lt;x&gt;.<p>Second   one
goes on.<aside>Look aside</aside><form><input><label>Mail</label></form><section id="comments"><p>Nice!</p></section>{close}<footer>&copy; us</footer></body></html>"""


def test_main_text_of_pages(spark):
    want = "Head & tail First para with boldness <x>. Second one goes on."
    pages = [(1, "u", PAGE.format(open="<article>", close="</article>")), (2, None, PAGE.format(open='<div id="x">', close="</div>")), (None, "u", None), (4, "u", ""), (5, "u", "plain words only"), (6, "u", "<p>a < b <p"), (7, "u", "<script>never closed"), (1, "u", "<!-- open")]
    df = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, text string, n_chars int")
    got = rows_of(extract(df))
    by = {(r["page_id"], r["url"], r["text"]) for r in got}
    assert len(got) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert {(1, "u", want), (2, None, want), (None, "u", ""), (4, "u", ""), (5, "u", "plain words only"), (7, "u", ""), (1, "u", "")} <= by
    assert extract(df.limit(0)).count() == 0


def test_marks_on_wrappers_do_not_drop_the_article():
    weights = {(w, k): (1.0 if w == "word" else -0.5) for w in ("word", "tag") for k in [*html_text.KNOWN, "other", ""]}
    words_ = "a quick line of prose about many things that goes on for a while"
    ad = '<div class="ad">buy this</div><div id="sidebar-wrap"><p>links here</p></div><div class="comments">so nice</div>'
    for wrap in ("div class='content-sidebar-wrap'", "div class='layout has-sidebar'", "div class=page-with-nav", "div class='post comment-open tags-x'", "form id='aspnetForm'", "div class='sidebar-wrap'", "section class='share-price'", "p class='alert'"):
        inner = words_ if wrap[0] == "p" else f"<p>{words_}</p>"
        tag = wrap.split()[0]
        assert html_text.main_text(f"<body>{ad}<{wrap}>{inner}</{tag}>{ad}</body>", weights) == words_, wrap
        assert html_text.main_text(f"<body>{ad}<article><{wrap}>{inner}</{tag}>{ad}</article></body>", weights) == words_, wrap
    assert html_text.main_text(f"<div class='widget'><article>{words_}</article></div><nav>{words_}</nav>", weights) == words_


def test_best_region_is_the_best_of_all():
    rng = np.random.default_rng(6)
    for _ in range(300):
        score = rng.integers(-4, 4, rng.integers(0, 12)).astype(float).tolist()
        best = max((sum(score[a:b]) for a in range(len(score)) for b in range(a, len(score) + 1)), default=0)
        first, last = html_text.best_region(score)
        assert sum(score[first:last]) == best and (best > 0 or first == last)


def test_long_pages_take_linear_time():
    import time

    weights = {(w, k): (1.0 if w == "word" else -0.5) for w in ("word", "tag") for k in [*html_text.KNOWN, "other", ""]}
    for piece in ("<a ", "<b>x</i>", "<p", "<div>", "<!--", "<script", "<div class=ad>x", '<a href="'):
        began = time.perf_counter()
        html_text.main_text(piece * (500_000 // len(piece)), weights)
        assert time.perf_counter() - began < 8, piece


def test_best_region_is_contiguous():
    weights = {(w, k): (1.0 if w == "word" else -2.0) for w in ("word", "tag") for k in [*html_text.KNOWN, "other", ""]}
    assert html_text.main_text("<b>a</b><b>c</b><div>one two three four five six seven</div><b>z</b>", weights) == "one two three four five six seven"


@pytest.mark.parametrize("n", [1, 5, 80])
def test_comments_stay_out_however_many_there_are(n):
    """With and without an article element, and without any heading."""
    weights = {(w, k): 0.9 if w == "word" else -0.3 for w in ("word", "tag") for k in [*html_text.KNOWN, "other", ""]}
    body = "".join(f"<p>Sentence number {i} of the text itself, which goes on for a while.</p>" for i in range(6))
    said = "".join(f'<div class="comment"><p>I think so too, said reader {i} at length and more.</p></div>' for i in range(n))
    want = " ".join(f"Sentence number {i} of the text itself, which goes on for a while." for i in range(6))
    for page in (f"<article>{body}</article><div class='comments'>{said}</div>", f"<div class='text'>{body}</div><div class='comments'>{said}</div>", f"<main><div>{body}</div><section id='comments'>{said}</section></main>"):
        assert html_text.main_text(f"<html><body>{page}</body></html>", weights) == want
    for wrapper in ("banner", "ad wrapper", "sidebar"):
        assert html_text.main_text(f"<html><body><div>Menu</div><div class='{wrapper}'>{body}</div></body></html>", weights).endswith(want)
    beside = f"<article>{body}</article><div class='promo'>{'<p>Buy this and that now.</p>' * 9 * n}</div>"
    assert html_text.main_text(f"<html><body>{beside}</body></html>", weights) == want


@pytest.mark.parametrize("name", ["left-sidebar", "article-comments", "user-comments", "post-comments", "wp-comments", "site-footer", "page-footer", "main-nav", "google-ad", "ad-300x250", "cc-banner", "outbrain"])
def test_marks_behind_words_of_place(name):
    weights = {(w, k): 0.9 if w == "word" else -0.3 for w in ("word", "tag") for k in [*html_text.KNOWN, "other", ""]}
    page = f"<article><p>The text begins here and goes on.</p><div class='{name}'><p>Not of the text.</p></div><p>It ends here after some words.</p></article>"
    assert html_text.main_text(page, weights) == "The text begins here and goes on. It ends here after some words."
