"""Small helpers that several operators share: reading a table, and cutting lineage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm import textbytes

#: Bytes of an Arrow batch on its way to Python; a longer row comes alone.
BATCH_BYTES = 1 << 22
#: Bytes of texts that a task works on at once; a longer text comes alone.
SLICE_BYTES = 1 << 22


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which all machines share; a temporary folder only where it is unset and all work is on one machine (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """The same rows, from a Parquet table in the shared folder: later steps don't depend on executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc32_mod(column: str, by: int):
    """crc32 of an id as text, modulo so many; null ids give 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(by), F.lit(0))


def bounded(df: DataFrame) -> DataFrame:
    """df, with Arrow batches of at most BATCH_BYTES in its session. All operators that send texts to Python begin with this, so their memory doesn't depend on what ran before; a smaller bound of the session's own stays."""
    conf = df.sparkSession.conf
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = conf.get(name).lower().removesuffix("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES, small: bool = True) -> Iterator[pa.RecordBatch]:
    """The batches in slices, without copies, that hold about most bytes of a text column; empty batches are left out. At the end the worker gives memory back.

    small: freed arrays go back to the machine at once, which costs time where large ones are made again and again.
    """
    if small:
        steady()
    for batch in batches:
        if not batch.num_rows:
            continue
        length = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(length, dtype=np.int64) // most
        edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield batch.slice(a, b - a)
        del batch
    give_back()


def _libc():
    return ctypes.CDLL(None)


def steady() -> None:
    """Arrays of a megabyte and more of this worker go back to the machine when they are freed, as other workers of the executor need the memory (glibc only)."""
    if hasattr(_libc(), "mallopt"):
        _libc().mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD


def give_back() -> None:
    """Returns freed memory of this worker to the machine."""
    textbytes.forget_tables()
    pa.default_memory_pool().release_unused()
    if hasattr(_libc(), "malloc_trim"):
        _libc().malloc_trim(0)
