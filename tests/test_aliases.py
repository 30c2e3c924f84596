"""Alias search against one regular expression over all aliases, and the join form against the search."""

import random
import re
import time

import pytest

from chatloom.functions import aliases
from chatloom.functions.aliases import AliasTrie, alias_key, aliases_found
from chatloom.operators.classify import project_hits, project_hits_by_join
from chatloom.sources.exports import rules_frame


def expression(keys):
    """What is specified: whole words, longest first, any white space where an alias has a space."""
    edge = lambda c: c.isalnum() or c in "_-"
    return re.compile("|".join(("(?<![\\w-])" if edge(k[0]) else "") + re.sub(" ", lambda _: r"\s+", re.escape(k).replace("\\ ", " ")) + ("(?![\\w-])" if edge(k[-1]) else "") for k in sorted(keys, key=len, reverse=True)))


def searched(keys, texts):
    trie = AliasTrie([alias_key(k) for k in keys])
    row, number = trie.search(texts)
    return [[trie.keys[n] for r, n in zip(row, number, strict=True) if r == i] for i in range(len(texts))]


def test_single_cases():
    found = lambda keys, text: set(searched(keys, [text])[0])
    assert found(["orchard"], "the orchard-pipeline") == set()
    assert found(["nz", "nz/orchard"], "see nz/orchard now") == {"nz/orchard"}
    assert found(["two words"], "Two\n  Words!") == {"two words"}
    assert found(["straße"], "STRASSE") == {"strasse"}
    assert found(["soft/"], "a soft/b") == {"soft/"}
    assert found(["c++", "++x"], "c++x") == {"c++"} and found(["c++"], "xc++") == set()
    assert found(["a b c d e", "b c"], "a b c d e b c") == {"a b c d e", "b c"}
    assert found(["a b", "b c"], "a b c") == {"a b"}
    assert searched([], ["x", None, ""]) == [[], [], []] and searched(["x"], []) == []


def test_equals_one_expression(monkeypatch):
    rng = random.Random(2)
    pieces = ["a", "b", "ab", "ba", "é", "ß", "_", "-", "+", "/", "x1", "漢"]
    word = lambda: "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 4)))
    for case in range(150):
        keys = {alias_key(" ".join(word() for _ in range(rng.randrange(1, 4)))) for _ in range(rng.randrange(1, 12))}
        texts = ["".join(rng.choice([word(), " ", "\n ", "　", "\0", "."]) for _ in range(rng.randrange(40))) for _ in range(12)]
        want = [sorted({alias_key(m) for m in expression(keys).findall(t.casefold())}) for t in texts]
        monkeypatch.setattr(aliases, "SEARCHED", 1 << 20 if case % 2 else 50)
        assert searched(keys, texts) == want, keys


def test_time_does_not_grow_with_the_aliases():
    rng = random.Random(3)
    name = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(4, 12)))
    text = [" ".join(name() for _ in range(14_000))] * 8

    def took(n):
        trie = AliasTrie([name() for _ in range(n)])
        trie.search(text[:1])
        times = []
        for _ in range(3):
            began = time.perf_counter()
            trie.search(text)
            times.append(time.perf_counter() - began)
        return min(times)

    assert took(1600) < 1.5 * took(100) + 0.02


def test_column(spark):
    rows = spark.createDataFrame([(1, "The Two  words, x"), (2, None), (3, ""), (4, "TWO WORDS two words X")], "i int, t string")
    got = {r.i: r.a for r in rows.select("i", aliases_found(rows.t, ["x", "two words"]).alias("a")).collect()}
    assert got == {1: ["two words", "x"], 2: [], 3: [], 4: ["two words", "x"]}
    assert [r[0] for r in rows.select(aliases_found(rows.t, [])).collect()] == [[]] * 4


def test_join_equals_search(spark):
    """One-word texts, aliases of up to six words, aliases inside others, folded letters, repeated keys, no words at all."""
    rules = rules_frame(spark, [("one", ["a", "x y z q r s"], 1), ("two", ["a b", "STRASSE"], 2), ("three", ["b c", "y-z"], 1), ("four", ["b"], 0)])
    rng = random.Random(5)
    texts = ["a", "", None, "...", "straße", "x y z q r s", "x y z q r", "a b c", "a, b c", "y-z y z", "b"] + [" ".join(rng.choice(["a", "b", "c", "x", "y", "z", ",", "A"]) for _ in range(rng.randrange(9))) for _ in range(60)]
    docs = spark.createDataFrame([(i // 2, t, 0) for i, t in enumerate(texts)], "k long, text string, priority int").repartition(3)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(project_hits_by_join(docs, rules, "k", "text")) == rows(project_hits(docs, rules, "k", "text"))
    assert rows(project_hits_by_join(docs, rules.limit(0), "k", "text")) == []
    with pytest.raises(Exception, match="plain words"):
        project_hits_by_join(docs, rules_frame(spark, [("p", ["c++"], 0)]), "k", "text").collect()
