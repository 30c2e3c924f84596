"""Tables that change together, states in buckets, and keyed latest rows in a stream's state."""

from itertools import takewhile

import pytest
from pyspark.sql import functions as F

from chatloom.operators import snapshots, state, state_table
from chatloom.streaming.refresh import keep_latest, latest_rows


def rows(df):
    return sorted(map(tuple, df.collect()))


def table(spark, values):
    return spark.createDataFrame([(f"d{i}", v, f"s{i % 3}") for i, v in values.items()], "document_id string, v string, shelf string")


def seen(spark, root):
    return {t: {r.document_id: r.v for r in snapshots.read(spark, root, t).collect()} for t in ("archive", "documents")}


def test_a_change_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    with pytest.raises(LookupError):
        snapshots.read(spark, root, "archive")
    first = {i: "a" for i in range(6)}
    snapshots.store(spark, root, {"archive": table(spark, first), "documents": table(spark, first)})
    before = seen(spark, root)
    old = snapshots.read(spark, root, "archive")
    broken = table(spark, {1: "b"}).withColumn("v", F.raise_error(F.lit("half-way")).cast("string"))
    with pytest.raises(Exception, match="half-way"):
        snapshots.store(spark, root, {"archive": table(spark, {1: "b", 9: "b"}), "documents": broken})
    assert seen(spark, root) == before
    with monkeypatch.context() as m:
        m.setattr(snapshots, "_replace", lambda *_: (_ for _ in ()).throw(OSError("no list")))
        with pytest.raises(OSError):
            snapshots.store(spark, root, {"archive": table(spark, {1: "b"}), "documents": table(spark, {1: "b"})})
    assert seen(spark, root) == before
    change = {"archive": table(spark, {1: "b", 9: "b"}), "documents": table(spark, {1: "b"})}
    assert snapshots.store(spark, root, change) == 1 and snapshots.store(spark, root, change) == 2
    after = seen(spark, root)
    assert after["archive"] == {f"d{i}": "b" if i in (1, 9) else "a" for i in (*range(6), 9)} and after["documents"]["d1"] == "b"
    assert {r.document_id: r.v for r in old.collect()} == before["archive"]  # what was read stays
    snapshots.expire(root, keep=1)
    assert seen(spark, root) == after
    assert snapshots.expire(root, keep=1) == 0


def test_only_touched_shelves_are_written(spark, tmp_path):
    root = str(tmp_path / "store")
    snapshots.store(spark, root, {"archive": table(spark, {i: "a" for i in range(6)})})
    first = snapshots.listing(root)["tables"]["archive"]["shelves"]
    snapshots.store(spark, root, {"archive": table(spark, {4: "b"})})
    second = snapshots.listing(root)["tables"]["archive"]["shelves"]
    assert {s for s in second if second[s] != first[s]} == {"s1"}
    snapshots.store(spark, root, {"archive": table(spark, {4: "b"}).limit(0)})
    assert snapshots.listing(root)["tables"]["archive"]["shelves"] == second


def _state(spark, n, status="imported"):
    return spark.range(n).select(F.lit("chatgpt").alias("source"), F.col("id").cast("string").alias("source_id"), F.sha2(F.col("id").cast("string"), 256).alias("content_hash"), F.concat(F.lit("chatgpt:"), F.col("id").cast("string")).alias("document_id"), F.lit("2025-01-01").cast("timestamp").alias("recorded_at"), F.lit(status).alias("status"), F.lit(None).cast("string").alias("error"))


def moved_rows(df):
    """What stands under the exchanges of a plan: for each the lines that are indented further."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    under = lambda i: takewhile(lambda j: depth[j] > depth[i], range(i + 1, len(lines)))
    return ["\n".join(lines[j] for j in under(i)) for i in range(len(lines)) if "Exchange hashpartitioning" in lines[i]]


def test_state_in_buckets_equals_the_plain_one_and_stays(spark, tmp_path):
    path = str(tmp_path / "it's state")
    state_table.write(_state(spark, 200), path, buckets=8)
    held = state_table.read(spark, path, buckets=8)
    new = _state(spark, 260, "failed").where(F.col("source_id").cast("int") % 3 != 0)
    new = new.unionByName(new.withColumn("status", F.lit("skipped"))).unionByName(new.limit(5))
    order = F.lit(1)
    assert rows(state_table.upserted(held, new, order)) == rows(state.upserted(_state(spark, 200), new, order))
    incoming = _state(spark, 300).select("source", "source_id", "content_hash")
    assert rows(state.decided(incoming, held)) == rows(state.decided(incoming, _state(spark, 200)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for df in (state.decided(incoming, held), state_table.upserted(held, new, order)):
            moved = moved_rows(df)
            assert moved and not any("parquet" in under for under in moved), moved
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    again = str(tmp_path / "next")
    state_table.write(state_table.upserted(held, new, order), again, buckets=8)
    assert state_table.read(spark, again, buckets=8).count() == 200 + sum(i % 3 != 0 for i in range(200, 260))


def test_latest_rows_of_a_stream(spark, tmp_path):
    """Three lots with a hot key, late rows, and a lot that comes twice."""
    check, folder = str(tmp_path / "check"), str(tmp_path / "in")
    lots = [[(k, t, f"{k}-{t}") for k, t in lot] for lot in ([(1, i) for i in range(500)] + [(2, 5)], [(1, 3), (2, 1), (3, 7)], [(1, 900), (None, 1)])]
    best = {}
    for lot in (*lots, lots[0]):
        spark.createDataFrame(lot, "k int, t int, v string").write.mode("append").parquet(folder)
        for k, t, v in lot:
            best[k] = max(best.get(k, (-1, "")), (t, v))
        for _ in range(2):  # nothing new the second time
            keep_latest(spark.readStream.schema("k int, t int, v string").parquet(folder), ("k",), "t", check).awaitTermination()
        assert {r.k: (r.t, r.v) for r in latest_rows(spark, check).collect()} == best
