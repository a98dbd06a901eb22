"""Rows whose key was not seen before, over all batches and restarts of a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.contracts import Contract
from loadlens.streaming.ingest import ALL_BATCHES, file_stream

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROGRESS = "spark.sql.streaming.numRecentProgressUpdates"


@dataclass(frozen=True)
class DistinctRun:
    """What a run did with its rows: ``rows_in`` is the sum of the four counts after it.

    ``untimed`` rows have no time, ``late`` ones lie behind the watermark. ``open_keys`` are held for the next run.
    """

    rows_in: int
    kept: int
    duplicates: int
    late: int
    untimed: int
    open_keys: int


def first_of_keys(rows: DataFrame, keys: list[str], time_column: str, delay: str) -> DataFrame:
    """The first row of each key of a stream, all columns kept.

    A key is remembered until the watermark, the greatest time less ``delay``, has passed its time by ``delay``, so the
    state holds the keys of the open stretch of time only. Null keys equal one another, as in the duplicate
    statistics. Rows without a time are left out; they are counted under the metric ``rows_in``.
    """
    timed = rows.withColumn("_event_time", F.col(time_column).cast("timestamp"))
    counted = timed.observe("rows_in", F.count_if(F.col("_event_time").isNull()).alias("untimed"))
    known = counted.filter(F.col("_event_time").isNotNull()).withWatermark("_event_time", delay)
    return known.dropDuplicatesWithinWatermark(keys).drop("_event_time")


def run_distinct(
    rows: DataFrame, keys: list[str], time_column: str, target: str, checkpoint: str, delay: str = "31 days",
    partition_by: list[str] | None = None,
) -> DistinctRun:
    """Append the first row of each key to ``target`` until what is there has been processed.

    The keys live in RocksDB and in the checkpoint, so a later run with the same checkpoint still knows them, whichever
    executors are left. Each batch appears once.
    """
    conf = rows.sparkSession.conf
    before = {name: conf.get(name, None) for name in (PROVIDER, PROGRESS)}
    conf.set(PROVIDER, ROCKSDB)
    conf.set(PROGRESS, str(ALL_BATCHES))
    try:
        writer = first_of_keys(rows, keys, time_column, delay).writeStream.format("parquet").option("path", target)
        writer = writer.partitionBy(*partition_by) if partition_by else writer
        query = writer.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)
    query.awaitTermination()
    return _summed(query.recentProgress)


def _summed(progress: list) -> DistinctRun:
    rows_in = duplicates = late = untimed = open_keys = 0
    for p in progress:
        rows_in += p["numInputRows"]
        untimed += (p.observedMetrics.get("rows_in") or {"untimed": 0})["untimed"] if p["numInputRows"] else 0
        for state in p.stateOperators:
            duplicates += state.customMetrics.get("numDroppedDuplicateRows", 0)
            late += state.numRowsDroppedByWatermark
            open_keys = state.numRowsTotal
    return DistinctRun(rows_in, rows_in - duplicates - late - untimed, duplicates, late, untimed, open_keys)


def ingest_distinct(
    spark: SparkSession, contract: Contract, folder: str, target: str, checkpoint: str, keys: list[str], time_column: str,
    delay: str = "31 days", max_files: int | None = None, strict: bool = True,
) -> DistinctRun:
    """As ``ingest.ingest_new_files``, but a key that an earlier row or file had within ``delay`` is not appended again."""
    rows = file_stream(spark, contract, folder, max_files, strict)
    return run_distinct(rows, keys, time_column, target, checkpoint, delay, ["period"])
