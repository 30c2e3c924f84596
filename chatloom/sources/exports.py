"""Sources: exports as directories, single files or zips of JSON arrays; archived originals; project rules."""

from __future__ import annotations

import json
import re
import tomllib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.aliases import alias_key
from chatloom.model import SLUG, UNKNOWN_PROJECT
from chatloom.session import shared_folder, written
from chatloom.sources.export_source import LEAST_TASKS, NUMBERED, RANGE_BYTES, SINGLE, listed, plan

_SPACE = re.compile(r"[ \t\r\n]*")


def file_number(path: Column) -> Column:
    """The place of a split export's file; 0 for the single file, null for other files."""
    return F.when(path.rlike(SINGLE), F.lit(0).cast("bigint")).when(path.rlike(NUMBERED), F.regexp_extract(path, NUMBERED, 1).cast("bigint"))


def conversation_files(listing: DataFrame, export: str = "export", path: str = "path") -> DataFrame:
    """Adds file_no and verdict to a listing: each export's files in numeric order, or why it is rejected.

    An export holds either the single file or numbered ones: both or none is a format failure of the export.
    """
    numbered = listing.withColumn("file_no", file_number(F.col(path)))
    forms = numbered.groupBy(export).agg(F.bool_or(F.col(path).rlike(SINGLE)).alias("_one"), F.bool_or(F.col(path).rlike(NUMBERED)).alias("_many"))
    verdict = F.when(F.col("_one") & F.col("_many"), "both_forms").when(~F.col("_one") & ~F.col("_many"), "no_conversations").otherwise("ok")
    return numbered.join(forms.select(export, verdict.alias("verdict")), export).where(F.col("file_no").isNotNull() | (F.col("verdict") != "ok"))


def scan_array(text: str | Iterable[str]) -> Iterator[tuple[str | None, str | None]]:
    """The exact text of each element of a JSON array, then at most one error.

    A byte order mark, white space and one trailing comma are taken; elements before a syntax error are given. The text may come in parts: what
    is held is one element and the part in which it ends.
    """
    parts = iter([text] if isinstance(text, str) else text)
    decode = json.JSONDecoder().raw_decode
    held, at, ended = "", 0, False

    def more() -> bool:
        """Reads on, twice as much as is held, so that long elements aren't tried too often."""
        nonlocal held, at, ended
        got, size = [held[at:]], 0
        while size <= len(got[0]) and not ended:
            part = next(parts, None)
            ended = part is None
            got.append(part or "")
            size += len(got[-1])
        held, at = "".join(got), 0
        return size > 0

    def skip() -> str:
        """The next character that isn't white space, or nothing at the end."""
        nonlocal at
        while True:
            at = _SPACE.match(held, at).end()
            if at < len(held):
                return held[at]
            if not more():
                return ""

    if skip() == "\ufeff":
        at += 1
    if skip() != "[":
        yield None, "not_an_array"
        return
    at += 1
    comma = True
    while True:
        here = skip()
        if here == "]":
            at += 1
            if skip():
                yield None, "text_after_array"
            return
        if not here:
            yield None, "array_not_closed"
            return
        if not comma:
            yield None, "bad_json"
            return
        while True:
            try:
                _, end = decode(held, at)
            except RecursionError:
                yield None, "bad_json"
                return
            except ValueError:
                end = -1
            # A number may go on where the part ends, behind a point or an exponent's sign too.
            near = 3 if held[at] in "-0123456789" else 1
            if 0 <= end <= len(held) - near or end > 0 and ended:
                break
            if ended:
                yield None, "bad_json"
                return
            more()
        yield held[at:end], None
        at = end
        comma = skip() == ","
        at += comma


def read_exports(spark: SparkSession, *paths: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Raw records of exports: export, file, file_no, pos, raw, error (a failure of the file or of the export, without raw).

    A path is a JSON file of any name, a zip, or a folder of conversation files or zips. An export with both forms of conversation files, or
    with none, gives one row with an error. A path that isn't there raises FileNotFoundError. A file of more than range_bytes is read by many tasks; a file's records before its first error are
    given. The records are written to the shared folder once.
    """
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    tasks = max(LEAST_TASKS, 2 * spark.sparkContext.defaultParallelism)
    plan(spark, listed(list(paths), range_bytes), folder, tasks)
    found = written(spark.read.format("chat_export").option("plan", folder).option("tasks", tasks).load())
    first = found.where(F.col("error").isNotNull()).groupBy("export", "file").agg(F.min("at").alias("_first"))
    sound = found.join(first, ["export", "file"], "left").where(F.col("_first").isNull() | (F.col("at") < F.col("_first")) | F.col("error").isNotNull() & (F.col("at") == F.col("_first")))
    return sound.select("export", "file", "file_no", "pos", "raw", "error")


def records_of_texts(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """path, pos, raw, error of JSON arrays that lie in a column: what read_exports does to a file, for texts that lie in rows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [(name, pos, raw, error) for pos, (raw, error) in enumerate(scan_array(whole or ""))]
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["path", "pos", "raw", "error"])

    return files.select(F.col(path).cast("string"), text).mapInArrow(scan, "path string, pos bigint, raw string, error string")


def replay_records(archive: DataFrame) -> DataFrame:
    """Archived originals as raw records again: document_id, file_no, pos, raw, error (a media type that isn't JSON).

    Parse them like an export's; replayed_defect then tells which don't belong to their key.
    """
    wrong = F.when(F.col("media_type") != "application/json", "media_type")
    return archive.select("document_id", F.lit(0).cast("bigint").alias("file_no"), F.xxhash64("document_id").alias("pos"), F.decode("content", "utf-8").alias("raw"), wrong.alias("error"))


def replayed_defect() -> Column:
    """For a parsed replay: its failure, or a parsed identity that isn't the archive's."""
    return F.coalesce(F.col("error"), F.col("reject_reason"), F.when(~F.concat(F.lit("chatgpt:"), F.col("source_id")).eqNullSafe(F.col("document_id")), "other_identity"))


def rules_of_text(spark: SparkSession, text: str) -> DataFrame:
    """Project rules from the text of a TOML file."""
    return rules_frame(spark, [(p["project"], p["aliases"], p.get("priority", 0)) for p in tomllib.loads(text).get("project", [])])


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    """Project rules from TOML ([[project]] with project, aliases, priority): project, alias, alias_key, priority. Read as a text file by Spark, so any store will do."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    return rules_of_text(spark, text)


def rules_frame(spark: SparkSession, rules: list[tuple[str, list[str], int]]) -> DataFrame:
    """Rules as rows, one per alias; a set that isn't sound raises ValueError."""
    rows = [(p, a, alias_key(a), int(n)) for p, aliases, n in rules for a in aliases]
    names = [p for p, _, _ in rules]
    if len(set(names)) < len(names):
        raise ValueError("a project is declared twice")
    owner: dict[str, str] = {}
    for project, aliases, _ in rules:
        if project == UNKNOWN_PROJECT or not re.fullmatch(SLUG.strip("^$"), project):
            raise ValueError(f"{project!r} is no project name")
        if not aliases:
            raise ValueError(f"{project!r} has no alias")
        for alias in aliases:
            if not any(c.isalnum() for c in alias):
                raise ValueError(f"the alias {alias!r} has no letter or digit")
            if owner.setdefault(alias_key(alias), project) != project:
                raise ValueError(f"the alias {alias!r} names two projects")
    return spark.createDataFrame(rows, "project string, alias string, alias_key string, priority int")
