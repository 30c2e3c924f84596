"""Incremental refresh: new exports are imported as they come; keyed latest state from a stream of updates."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatloom.plans.import_job import Places, last_run, run_import
from chatloom.session import written
from chatloom.sources.export_source import RECORDS, ChatExports
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def refresh(spark: SparkSession, exports: str, rules: DataFrame, places: Places, checkpoint: str) -> StreamingQuery:
    """Imports the exports that came into a folder since the last time, oldest first and each as a run of its own, and ends when nothing is left.

    A batch's runs follow the last one that left a state, and stay the same runs if the batch is retried. What a batch reads is written before it is imported.
    """
    spark.dataSource.register(ChatExports)

    def batch(df: DataFrame, number: int) -> None:
        come = written(df)
        first = run_of_batch(spark, places, checkpoint, number)
        order = [r.export for r in come.groupBy("export").agg(F.min("come").alias("come")).orderBy("come", "export").collect()]  # a row per export
        for i, export in enumerate(order):
            run_import(spark, come.where(F.col("export") == export).select("file_no", "pos", "raw", "error"), rules, places, first + i, F.current_timestamp())

    stream = spark.readStream.format("chat_export").schema(f"{RECORDS}, come bigint").load(exports)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_of_batch(spark: SparkSession, places: Places, checkpoint: str, number: int) -> int:
    """The run number of a batch: the one noted when it was first tried, else the next."""
    path = f"{places.batches(checkpoint)}/batch={number}"
    try:
        noted = spark.read.schema("run bigint").parquet(path).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        noted = None
    if noted is not None:
        return noted.run
    run = last_run(spark, places) + 1
    spark.createDataFrame([(run,)], "run bigint").write.mode("overwrite").parquet(path)
    return run


def keep_latest(stream: DataFrame, keys: tuple[str, ...], order: str, checkpoint: str) -> StreamingQuery:
    """Keeps one row per key, the one with the greatest order, in the query's own state: a batch costs its own rows and keys, not all that were ever seen.

    Partial aggregates leave one row per key and task before the shuffle, so hot keys don't gather. Ends when nothing is left; the
    state is in the checkpoint, by versions of a batch, so a batch that is tried again starts from the one before. Read it with latest_rows.
    """
    last = stream.groupBy(*keys).agg(F.max_by(F.struct(*stream.columns), order).alias("row"))
    conf = stream.sparkSession.conf
    before = conf.get(PROVIDER)
    conf.set(PROVIDER, ROCKSDB)  # a started query keeps the session's settings of its start
    try:
        return last.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(PROVIDER, before)


def latest_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What keep_latest holds as of its last whole batch."""
    state = spark.read.format("statestore").load(checkpoint)
    row = state.schema["value"].dataType.fields[0].name
    return state.select(F.col("value")[row].alias("row")).select("row.*")
