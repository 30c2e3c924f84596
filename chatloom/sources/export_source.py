"""Exports as a data source: ``spark.read.format("chat_export").load(path)``.

A task reads files, zips' members or byte ranges of files: one, or several small ones. Files lie in any store that Arrow reaches (a plain path, or file:, hdfs:, s3: ...), and
nothing is held whole. ``read_exports`` plans first: large files are cut into ranges, one job lexes them, and their summaries in order say how each
range begins; the source then reads the ranges by that plan. Only the columns of the schema that is asked for are made.
"""

from __future__ import annotations

import io
import json
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from itertools import groupby

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

from chatloom.sources.json_ranges import Entry, Read, Summary, body_start, elements, summaries

SINGLE, NUMBERED = r"(?:^|/)conversations\.json$", r"(?:^|/)conversations-(\d+)\.json$"
RECORDS = "export string, file string, file_no bigint, pos bigint, raw string, error string"
#: With the byte of the file at which the record begins or its error stands, and for streams when the export came.
PLACED = f"{RECORDS}, at bigint, come bigint"
SUMMARIES = "file string, begin bigint, state array<int>, depth array<bigint>, low array<bigint>, commas array<map<bigint, bigint>>"
#: Bytes of a range, and rows of a batch.
RANGE_BYTES, BATCH_ROWS = 1 << 26, 1000
#: Parts of fewer bytes share a task, but for so many tasks; files that the driver opens or moves at a time.
TASK_BYTES, LEAST_TASKS, AT_ONCE = 1 << 24, 16, 16
ZIP_MAGIC = (b"PK\x03\x04", b"PK\x05\x06")
#: What a damaged, encrypted or unknown member raises when it is opened or read.
BAD_MEMBER = (zipfile.BadZipFile, NotImplementedError, RuntimeError, EOFError, zlib.error, pa.ArrowInvalid)


@dataclass(frozen=True)
class Part(InputPartition):
    """What a task reads: bytes [begin, end) of a file's array, a member of a zip, or an error that is known already."""

    export: str
    file: str | None = None
    member: str | None = None
    begin: int = 0
    end: int = 0
    first: bool = False  #: whether the range begins behind the array's bracket
    cut: bool = False  #: whether the file has more ranges
    state: int = 0
    depth: int = 1
    number: int = 0
    error: str | None = None
    come: int = 0  #: when a stream saw the export, by its time


@dataclass(frozen=True)
class Task(InputPartition):
    """Parts that a task reads one after another."""

    parts: tuple[Part, ...]


def dealt(parts: list[Part], least: int = LEAST_TASKS) -> list[Task]:
    """Parts dealt out in turn, so that the ranges of a file go to several tasks: about TASK_BYTES a task, and at least so many tasks. A zip's member counts as a task's bytes."""
    size = sum(TASK_BYTES if p.member else p.end - p.begin for p in parts)
    n = min(len(parts), max(least, -(-size // TASK_BYTES)))
    return [Task(tuple(parts[i::n])) for i in range(n)]


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path, and the path there."""
    return pafs.FileSystem.from_uri(path) if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:/", path) else (pafs.LocalFileSystem(), path)


def children(folder: str) -> list[str]:
    """Paths of what lies in a folder, in the order of names."""
    fs, path = opened(folder)
    return sorted(f"{folder}/{i.base_name}" for i in fs.get_file_info(pafs.FileSelector(path)) if not i.base_name.startswith((".", "_")))


def moved(source: str, target: str) -> None:
    """Moves a file or folder inside a store, so that it appears whole."""
    (fs, path), (_, to) = opened(source), opened(target)
    fs.create_dir(to.rsplit("/", 1)[0])
    fs.move(path, to)


def reader_of(stream) -> Read:
    """Reads a place of a seekable stream."""

    def read(at: int, size: int) -> bytes:
        if stream.tell() != at:
            stream.seek(at)
        return stream.read(size)

    return read


def named(path: str) -> bool:
    return bool(re.search(SINGLE, path) or re.search(NUMBERED, path))


def forms(names: list[str]) -> str | None:
    """Why an export of such conversation files is rejected, or None."""
    one, many = (any(re.search(p, n) for n in names) for p in (SINGLE, NUMBERED))
    return "both_forms" if one and many else None if one or many else "no_conversations"


def listed(paths: list[str], range_bytes: int = RANGE_BYTES) -> list[Part]:
    """The parts of exports: JSON files of any name, zips (told by their content), or folders of conversation files and zips.

    A path that isn't there raises FileNotFoundError. Reads each file's first bytes and each zip's directory, on the driver.
    """
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return [p for found in pool.map(lambda path: _listed(path, range_bytes), paths) for p in found]


def _listed(given: str, range_bytes: int) -> list[Part]:
    given = given.rstrip("/")
    fs, path = opened(given)
    info = fs.get_file_info(path)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(given)
    if info.type == pafs.FileType.File:
        return _file(fs, given, given, info.path, info.size, range_bytes)
    parts: list[Part] = []
    inside = sorted((i for i in fs.get_file_info(pafs.FileSelector(path)) if i.type == pafs.FileType.File), key=lambda i: i.path)
    uri = lambda i: f"{given}/{i.base_name}"
    zips = [i for i in inside if i.base_name.lower().endswith(".zip")]
    plain = [i for i in inside if named(i.base_name)]
    for i in zips:
        parts += _file(fs, uri(i), uri(i), i.path, i.size, range_bytes)
    error = forms([i.base_name for i in plain])
    if error and not (error == "no_conversations" and zips):
        parts.append(Part(given, error=error))
    for i in plain if not error else ():
        parts += _file(fs, given, uri(i), i.path, i.size, range_bytes)
    return parts


def _file(fs: pafs.FileSystem, export: str, uri: str, path: str, size: int, range_bytes: int) -> list[Part]:
    with fs.open_input_file(path) as stream:
        read = reader_of(stream)
        if read(0, 4) in ZIP_MAGIC or uri.lower().endswith(".zip"):
            try:
                members = [n for n in zipfile.ZipFile(stream).namelist() if named(n)]
            except BAD_MEMBER:
                return [Part(export, uri, error="bad_zip")]
            error = forms(members)
            return [Part(export, error=error)] if error else [Part(export, uri, member=m) for m in members]
        begin = body_start(read)
    if begin is None:
        return [Part(export, uri, error="not_an_array")]
    edges = [*range(begin, max(size, begin + 1), range_bytes), max(size, begin)]
    return [Part(export, uri, begin=a, end=b, first=a == begin, cut=len(edges) > 2) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def planned(folder: str) -> list[Part]:
    """The parts of a written plan; ranges behind an array's end have nothing to read."""
    fs, path = opened(folder)
    return [Part(**row) for row in ds.dataset(path, filesystem=fs, format="parquet").to_table().to_pylist() if row["depth"] > 0]


def summarized(part: Part) -> dict:
    """A range's summary for each state in which it may begin."""
    fs, path = opened(part.file)
    with fs.open_input_file(path) as stream:
        found = summaries(reader_of(stream), part.begin, part.end)
    return {"file": part.file, "begin": part.begin, "state": [s.state for s in found], "depth": [s.depth for s in found], "low": [s.low for s in found], "commas": [dict(s.commas) for s in found]}


def records(part: Part) -> Iterator[tuple]:
    """Rows of PLACED of one part, without come. Behind a file's first error there may be more; read_exports leaves them out."""
    name = part.member or part.file
    numbered = re.search(NUMBERED, name or "")
    file_no = int(numbered[1]) if numbered else 0
    if part.error:
        yield part.export, name, file_no if name else None, 0, None, part.error, 0
        return
    fs, path = opened(part.file)
    with fs.open_input_file(path) as stream:
        if part.member is None:
            for at, number, text, error in elements(reader_of(stream), part.begin, part.end, Entry(part.state, part.depth, part.number), part.first):
                yield part.export, name, file_no, number, text, error, at
            return
        pos = at = 0
        try:
            with zipfile.ZipFile(stream) as packed, packed.open(part.member) as member:
                read = reader_of(member)
                begin = body_start(read)
                if begin is None:
                    yield part.export, name, file_no, 0, None, "not_an_array", 0
                    return
                for at, pos, text, error in elements(read, begin, packed.getinfo(part.member).file_size, Entry(), True):  # noqa: B007
                    yield part.export, name, file_no, pos, text, error, at
                    pos += 1
        except BAD_MEMBER:
            yield part.export, name, file_no, pos, None, "bad_zip", at + 1


class ChatExports(DataSource):
    """Reads exports, follows a folder of them as a stream, and writes them.

    Options: path or paths (a JSON list) to read, or the folder to follow; plan, a folder that read_exports wrote; view, "records" or "ranges" (their
    summaries); tasks, how many there are at least, if there are as many parts. To write (a column raw): path, and layout: "split" (numbered files in the folder),
    "single" (a folder with one file for each task), "file" (a JSON file of another name each) or "zip" (a zip each); by, a column with the number of a row's file,
    by which the rows of a task are in order and which no two tasks share: else a task writes one file, with its own number.
    """

    @classmethod
    def name(cls) -> str:
        return "chat_export"

    def schema(self) -> str:
        return SUMMARIES if self.options.get("view") == "ranges" else PLACED

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(dict(self.options), schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _Stream(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("exports are only added")
        return _Writer(self.options["path"].rstrip("/"), self.options.get("layout", "split"), self.options.get("by"))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.options, self.columns = options, [f.name for f in schema]
        self.ranges = options.get("view") == "ranges"

    def partitions(self) -> list[Task]:
        if "plan" in self.options:
            parts = planned(self.options["plan"])
            if self.ranges:
                parts = [p for p in parts if p.cut]
        else:
            paths = json.loads(self.options["paths"]) if "paths" in self.options else [self.options["path"]]
            parts = listed(paths, 1 << 62) or [Part("", error="no_conversations")]  # without a plan a file is one task's
        return dealt(parts, int(self.options.get("tasks", LEAST_TASKS)))

    def read(self, task: Task) -> Iterator[tuple | pa.RecordBatch]:
        if self.ranges:
            for row in map(summarized, task.parts):
                yield tuple(row[c] for c in self.columns)
        else:
            yield from batches(task.parts, self.columns)


def batches(parts: Iterable[Part], columns: list[str]) -> Iterator[pa.RecordBatch]:
    """The records of each part up to its first error, with these columns of PLACED."""
    names = [c.split()[0] for c in PLACED.split(", ")]
    kinds = dict(zip(names, (pa.string(), pa.string(), *[pa.int64()] * 2, pa.string(), pa.string(), *[pa.int64()] * 2), strict=True))
    wanted = [names.index(c) for c in columns]
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[names[i]]) for i in wanted], columns)

    size = 0
    for part in parts:
        for row in records(part):
            rows.append((*row, part.come))
            size += len(row[4] or "")
            if len(rows) == BATCH_ROWS or size > 1 << 22:
                yield batch()
                rows, size = [], 0
            if row[5]:
                break  # nothing counts behind a part's first error
    yield batch()


class _Stream(DataSourceStreamReader):
    """The exports of a folder as they come: an offset is the time and the name of the last one. An export must be whole when it appears (moved into the folder)."""

    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.folder, self.columns = options["path"].rstrip("/"), [f.name for f in schema]

    def _come(self) -> list[tuple[int, str]]:
        fs, path = opened(self.folder)
        return sorted((i.mtime_ns or 0, i.base_name) for i in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)) if not i.base_name.startswith((".", "_")))

    def initialOffset(self) -> dict:
        return {"time": -1, "name": ""}

    def latestOffset(self) -> dict:
        come = self._come()
        return dict(zip(("time", "name"), come[-1], strict=True)) if come else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Part]:
        between = [(t, n) for t, n in self._come() if (start["time"], start["name"]) < (t, n) <= (end["time"], end["name"])]
        return [replace(p, come=t) for t, n in between for p in listed([f"{self.folder}/{n}"], 1 << 62)]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        return batches([part], self.columns)

    def commit(self, end: dict) -> None:
        """Nothing is removed: exports stay where they were put."""


@dataclass
class _Staged(WriterCommitMessage):
    files: list[tuple[int, str]]  #: number and hidden path


class _Writer(DataSourceWriter):
    """A task writes its records as an array to a hidden file, or to one for each number that it has; all appear under their names when all tasks are done."""

    def __init__(self, folder: str, layout: str, by: str | None = None):
        if layout not in ("split", "single", "file", "zip"):
            raise ValueError(f"{layout!r} is no layout of exports")
        self.folder, self.layout, self.by = folder, layout, by

    def write(self, rows: Iterator[Row]) -> _Staged:
        task = TaskContext.get().partitionId()
        return _Staged([(number, self._staged(number, each)) for number, each in groupby(rows, lambda row: row[self.by] if self.by else task)])

    def _staged(self, number: int, rows: Iterator[Row]) -> str:
        fs, path = opened(f"{self.folder}/_{uuid.uuid4().hex}")
        first = next(rows)
        fs.create_dir(path.rsplit("/", 1)[0])
        with fs.open_output_stream(path) as out:
            if self.layout == "zip":
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as packed:
                    packed.writestr("chat.html", "<html></html>")
                    with packed.open(f"conversations-{number:03}.json", "w", force_zip64=True) as member:
                        _write_array(member, first, rows)
            else:
                _write_array(out, first, rows)
        return f"{self.folder}/{path.rsplit('/', 1)[1]}"

    def commit(self, messages: list[_Staged | None]) -> None:
        staged = [f for m in messages if m is not None for f in m.files]
        if len({number for number, _ in staged}) < len(staged):
            raise ValueError(f"rows of one file, by {self.by}, lie apart")
        name = {"split": "conversations-{:03}.json", "single": "export-{:03}/conversations.json", "file": "export-{:03}.json", "zip": "export-{:03}.zip"}[self.layout]
        with ThreadPoolExecutor(AT_ONCE) as pool:
            list(pool.map(lambda f: moved(f[1], f"{self.folder}/{name.format(f[0])}"), staged))

    def abort(self, messages: list[_Staged | None]) -> None:
        for m in messages:
            for _, staged in m.files if m is not None else ():
                fs, path = opened(staged)
                fs.delete_file(path)


def _write_array(out: io.IOBase | pa.NativeFile, first: Row, rows: Iterator[Row]) -> None:
    out.write(b"[" + first["raw"].encode())
    for row in rows:
        out.write(b",\n" + row["raw"].encode())
    out.write(b"]\n")


def entries(parts: list[Part], found: DataFrame) -> Iterator[Part]:
    """Parts with the state in which each range begins: summaries are taken in order, file by file."""
    known = {(r["file"], r["begin"]): [Summary(s, d, w, dict(c)) for s, d, w, c in zip(r["state"], r["depth"], r["low"], r["commas"], strict=True)] for r in found.toArrow().to_pylist()}
    entry = Entry()
    for part in parts:
        if not part.cut:
            yield part
            continue
        entry = Entry() if part.first else entry
        yield replace(part, state=entry.state, depth=entry.depth, number=entry.number)
        entry = entry.after(known[part.file, part.begin])


def plan(spark: SparkSession, parts: list[Part], folder: str, tasks: int = LEAST_TASKS) -> None:
    """Writes the plan of parts: a job lexes the ranges of files that have several. The driver holds a short row a range."""
    spark.dataSource.register(ChatExports)
    if any(p.cut for p in parts):
        _write_plan(spark, parts, f"{folder}-ranges")
        found = spark.read.format("chat_export").option("view", "ranges").option("plan", f"{folder}-ranges").option("tasks", tasks).load()
        parts = list(entries(parts, found))
    _write_plan(spark, parts, folder)


def _write_plan(spark: SparkSession, parts: list[Part], folder: str) -> None:
    kinds = {"str": pa.string(), "int": pa.int64(), "bool": pa.bool_()}
    schema = pa.schema([(n, kinds[k.split(" ")[0]]) for n, k in Part.__annotations__.items()])
    spark.createDataFrame(pa.Table.from_pylist([vars(p) for p in parts], schema)).coalesce(1).write.parquet(folder)
