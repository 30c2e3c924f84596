"""Exports of all forms, arrays that many tasks read, the data source as reader, stream and writer."""

import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from chatloom.sources import export_source, json_ranges
from chatloom.sources.export_source import ChatExports, listed
from chatloom.sources.exports import read_exports, scan_array

CASES = [
    "[]", "[ ]", "", "   ", "{}", "[1", "[1,", "[1,]", "[,1]", "[1,,2]", "[1] x", "[1] ]", "[] []", "[1 2]", '[{"a":1} {"b":2},3]', '[{"a":[1},2]', '["a,]\\"[","\\\\",{"x":"\\\\\\""}]',
    '﻿ [1, "é" ]\n', '[1, {"a": ]', '["x', '["\\', "[1e", "[tru", "[12 , 3.5e-2,-1]", '[[[[1,2],[3]],{"a":[{}]}],"]",","]', "[1}", "[1},2]", '[\\"a",1]', '["a"\\,1]', "[1]\\", "﻿", "﻿x", " \n [\n1\n,\n2\n]\n ",
]


def by_ranges(data, size):
    read = lambda at, n: data[at : at + n]
    begin = json_ranges.body_start(read)
    if begin is None:
        return [(None, "not_an_array")]
    entry, rows = json_ranges.Entry(), []
    for at in range(begin, max(len(data), begin + 1), size):
        end = min(at + size, len(data))
        if entry.depth > 0:
            rows += json_ranges.elements(read, at, end, entry, at == begin)
        entry = entry.after(json_ranges.summaries(read, at, end))
    bad = min((r for r in rows if r[3]), default=None)
    rows = sorted((r for r in rows if bad is None or r[0] < bad[0] or r == bad), key=lambda r: (r[0], r[1]))
    assert [r[1] for r in rows] == list(range(len(rows)))
    return [(r[2], r[3]) for r in rows]


@pytest.mark.parametrize("text", CASES)
def test_ranges_cut_at_every_byte(text, monkeypatch):
    want = list(scan_array(text))
    for part in (1, 3, 1 << 20):
        monkeypatch.setattr(json_ranges, "PART_BYTES", part)
        for size in range(1, len(text.encode()) + 2):
            assert by_ranges(text.encode(), size) == want


def test_random_and_damaged_arrays(monkeypatch):
    rng = random.Random(1)
    for i in range(1200):
        text = json.dumps([rng.choice([1, 'a,\\"]', {"k": ["x\\", {}]}, [], [[1, "}"]], None, -1.5e3, "é\n"]) for _ in range(rng.randrange(6))], ensure_ascii=rng.random() < 0.5)
        if i % 2:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["", ",", '"', "\\", "]", "}", "[", "x", " "]) + text[at + 1 :]
        monkeypatch.setattr(json_ranges, "PART_BYTES", rng.choice([1, 2, 7, 1 << 20]))
        assert by_ranges(text.encode(), rng.choice([1, 2, 3, 7, 20])) == list(scan_array(text)), text


def test_records_before_bytes_that_are_no_text_are_kept():
    assert by_ranges(b'[1, "\xff", 2]', 4) == [("1", None), (None, "not_utf8")]


def rows(df):
    return sorted((r.file_no, r.pos, r.raw, r.error) for r in df.fillna(-1).fillna("").collect())


def test_exports_of_each_form(spark, tmp_path):
    one = json.dumps([{"a": 1}])
    for name, files in {"whole": {"conversations.json": one}, "split": {"conversations-10.json": one, "conversations-9.json": one}, "none": {"chat.html": "x"}, "both": {"conversations.json": one, "conversations-1.json": one}}.items():
        (tmp_path / name).mkdir()
        for f, text in files.items():
            (tmp_path / name / f).write_text(text)
    (tmp_path / "any name.json").write_text(one)
    (tmp_path / "bad.json").write_bytes(b'[1, "\xff"]')
    (tmp_path / "broken.zip").write_bytes(b"PK\x03\x04 nothing")
    (tmp_path / "text.json").write_text("{}")
    for name, members in (("packed", ["conversations-3.json"]), ("empty.zip", ["chat.html"]), ("two.zip", ["x/conversations.json", "conversations-1.json"])):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for member in members:
                z.writestr(member, one)
    got = lambda *names: rows(read_exports(spark, *(str(tmp_path / n) for n in names)))
    assert got("whole") == got("any name.json") == [(0, 0, '{"a": 1}', "")]
    assert got("split") == [(9, 0, '{"a": 1}', ""), (10, 0, '{"a": 1}', "")]
    assert got("packed") == [(3, 0, '{"a": 1}', "")]
    assert got("none") == got("empty.zip") == [(-1, 0, "", "no_conversations")] and got("both") == got("two.zip") == [(-1, 0, "", "both_forms")]
    assert got("bad.json") == [(0, 0, "1", ""), (0, 1, "", "not_utf8")]
    assert got("broken.zip") == [(0, 0, "", "bad_zip")] and got("text.json") == [(0, 0, "", "not_an_array")]
    assert len(got("whole", "split", "none")) == 4
    (tmp_path / "many").mkdir()
    for name in ("a.zip", "b.zip"):
        with zipfile.ZipFile(tmp_path / "many" / name, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("conversations.json", one)
    assert got("many") == [(0, 0, '{"a": 1}', "")] * 2
    with pytest.raises(FileNotFoundError):
        listed([str(tmp_path / "nowhere")])


def test_one_array_in_many_tasks(spark, tmp_path):
    values = [{"id": i, "text": ('x,]"\\' * (i % 40))} for i in range(3000)]
    path = tmp_path / "large.json"
    path.write_text(json.dumps(values))
    assert len(listed([str(path)], 1 << 14)) > 10
    got = read_exports(spark, str(path), range_bytes=1 << 14)
    assert [json.loads(r.raw) for r in got.orderBy("pos").collect()] == values
    assert [r.pos for r in got.orderBy("pos").collect()] == list(range(3000))
    path.write_text(json.dumps(values)[:-1] + ', {"a": }, 7]')
    assert rows(read_exports(spark, str(path), range_bytes=1 << 14))[-1] == (0, 3000, "", "bad_json")
    path.write_text(json.dumps(values)[:90_000])
    cut = rows(read_exports(spark, str(path), range_bytes=1 << 12))
    assert [e for *_, e in cut if e] == ["bad_json"] and [p for _, p, *_ in cut] == list(range(len(cut)))


def test_only_columns_that_are_asked_for(spark, tmp_path):
    (tmp_path / "x.json").write_text("[1, 2]")
    spark.dataSource.register(ChatExports)
    got = spark.read.format("chat_export").schema("pos bigint, error string").load(str(tmp_path / "x.json"))
    assert sorted(map(tuple, got.collect())) == [(0, None), (1, None)]


@pytest.mark.parametrize("layout,exports", [("split", 1), ("single", 4), ("file", 4), ("zip", 4)])
def test_written_exports_read_back(spark, tmp_path, layout, exports):
    spark.dataSource.register(ChatExports)
    raw = spark.range(200).repartition(4).select(F.concat(F.lit('{"id": '), F.col("id").cast("string"), F.lit(', "t": "é\\n"}')).alias("raw"))
    raw.write.format("chat_export").option("layout", layout).mode("append").save(str(tmp_path / "out"))
    paths = [str(tmp_path / "out")] if layout == "split" else sorted(str(p) for p in (tmp_path / "out").iterdir())
    assert len(paths) == exports
    got = read_exports(spark, *paths, range_bytes=500).collect()
    assert sorted(r.raw for r in got) == sorted(r.raw for r in raw.collect()) and not any(r.error for r in got)


def test_a_stream_follows_a_folder(spark, tmp_path):
    spark.dataSource.register(ChatExports)
    (tmp_path / "in").mkdir()

    def go():
        stream = spark.readStream.format("chat_export").load(str(tmp_path / "in"))
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(once=True).start().awaitTermination()
        return sorted(r.raw for r in spark.read.parquet(str(tmp_path / "out")).collect())

    (tmp_path / "in" / "a.json").write_text("[1, 2]")
    assert go() == ["1", "2"]
    (tmp_path / "in" / "b").mkdir()
    (tmp_path / "in" / "b" / "conversations-0.json").write_text("[3]")
    assert go() == ["1", "2", "3"]
    assert go() == ["1", "2", "3"]


def test_small_files_share_tasks_that_write_and_read_them(spark, tmp_path):
    folder = f"{tmp_path}/out"
    spark.dataSource.register(export_source.ChatExports)
    rows = spark.range(600).select(F.concat(F.lit('{"id": '), F.col("id").cast("string"), F.lit("}")).alias("raw"), F.floor(F.col("id") / 4).alias("n"), "id")
    rows.repartition(3, "n").sortWithinPartitions("n", "id").select("raw", "n").write.format("chat_export").option("layout", "file").option("by", "n").mode("append").save(folder)
    paths = export_source.children(folder)
    assert len(paths) == 150
    plain = spark.read.format("chat_export").option("paths", json.dumps(paths)).load()
    assert plain.rdd.getNumPartitions() == export_source.LEAST_TASKS
    want = [(f"{folder}/export-{n:03}.json", k, f'{{"id": {4 * n + k}}}', None) for n in range(150) for k in range(4)]
    for found in (plain, read_exports(spark, *paths, range_bytes=16)):
        assert sorted((r.file, r.pos, r.raw, r.error) for r in found.collect()) == sorted(want)
    with pytest.raises(Exception, match="lie apart"):
        rows.repartition(3).select("raw", "n").write.format("chat_export").option("layout", "file").option("by", "n").mode("append").save(f"{tmp_path}/apart")
    assert not export_source.children(f"{tmp_path}/apart")
