"""Several tables by document id that change together: readers see all of a change or nothing of it.

A table lies in shelves by key prefix. A change writes only the shelves that it touches, to folders of their own; then a small
file lists the folder of each shelf of each table, and last another one, the pointer, is replaced in one step. Whoever
reads goes by the pointer, so a run that fails half-way leaves the tables as they were. Folders that no kept list names can be removed later.
"""

from __future__ import annotations

import json
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chatloom.operators.archive import latest
from chatloom.sources.export_source import opened

POINTER = "current"


def _text(path: str) -> str | None:
    fs, at = opened(path)
    if fs.get_file_info(at).type != pafs.FileType.File:
        return None
    with fs.open_input_file(at) as f:
        return f.read().decode()


def _replace(path: str, text: str) -> None:
    """Writes a small file so that others see the old or the new one whole."""
    fs, at = opened(path)
    fs.create_dir(at.rsplit("/", 1)[0])
    name = f"{at}.{uuid.uuid4().hex}"
    with fs.open_output_stream(name) as f:
        f.write(text.encode())
    fs.move(name, at)


def listing(root: str) -> dict:
    """The list that the pointer names: version, and for each table its schema and the folder of each shelf. Empty at first."""
    version = _text(f"{root}/{POINTER}")
    return json.loads(_text(f"{root}/lists/{version}.json")) if version else {"version": -1, "tables": {}}


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table as of now; later changes don't alter what was read. A table that was never written raises LookupError."""
    found = listing(root)["tables"].get(table)
    if found is None:
        raise LookupError(f"{table!r} isn't in {root}")
    return _rows(spark, root, table, found)


def _rows(spark: SparkSession, root: str, table: str, found: dict, shelves: list[str] | None = None) -> DataFrame:
    folders = [f"{root}/{table}/{folder}/shelf={shelf}" for shelf, folder in sorted(found["shelves"].items()) if shelves is None or shelf in shelves]
    schema = StructType.fromJson(found["schema"])
    return spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*folders).drop("part") if folders else spark.createDataFrame([], schema)


def store(spark: SparkSession, root: str, changes: dict[str, DataFrame]) -> int:
    """Upserts rows (with document_id and shelf) into several tables as one change, and gives its version.

    Only shelves that rows touch are read and written. One writer at a time; a repeated change gives the same tables.
    """
    before = listing(root)
    tables = {name: dict(found, shelves=dict(found["shelves"])) for name, found in before["tables"].items()}
    for name, rows in changes.items():
        found = tables.setdefault(name, {"schema": rows.schema.jsonValue(), "shelves": {}})
        touched = [r.shelf for r in rows.select("shelf").distinct().collect()]  # at most 256
        new, old = rows.withColumn("_new", F.lit(1)), _rows(spark, root, name, found, touched)
        folder = f"part={uuid.uuid4().hex}"
        last = latest(new.unionByName(old.withColumn("_new", F.lit(0)).select(*new.columns)), ("document_id",), "_new").drop("_new")
        last.write.partitionBy("shelf").parquet(f"{root}/{name}/{folder}")
        found["shelves"] |= dict.fromkeys(touched, folder)
    version = before["version"] + 1
    _replace(f"{root}/lists/{version}.json", json.dumps({"version": version, "tables": tables}))
    _replace(f"{root}/{POINTER}", str(version))
    return version


def expire(root: str, keep: int = 2) -> int:
    """Removes folders that none of the last lists names, and older lists; gives the number of folders. Not while a change is being written."""
    version = listing(root)["version"]
    kept = [json.loads(t) for v in range(max(version - keep + 1, 0), version + 1) if (t := _text(f"{root}/lists/{v}.json"))]
    removed = 0
    for table in kept[-1]["tables"] if kept else ():
        named = {f for k in kept for f in k["tables"].get(table, {"shelves": {}})["shelves"].values()}
        fs, at = opened(f"{root}/{table}")
        for info in fs.get_file_info(pafs.FileSelector(at)):
            if info.base_name not in named:
                fs.delete_dir(info.path)
                removed += 1
    fs, at = opened(f"{root}/lists")
    for info in fs.get_file_info(pafs.FileSelector(at, allow_not_found=True)):
        if info.base_name.removesuffix(".json") not in {str(k["version"]) for k in kept}:
            fs.delete_file(info.path)
    return removed
