"""Incremental ingest: load files that were not loaded before, never twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.contracts import Contract
from loadlens.functions.text import null_if
from loadlens.sources import delimited, inventory

ALL_BATCHES = 1_000_000


def file_stream(
    spark: SparkSession, contract: Contract, folder: str, max_files: int | None = None, strict: bool = True
) -> DataFrame:
    """A contract's landing folder as a stream of typed rows with their period.

    The period comes from the folder (``2024-01`` or ``period=2024-01``). As in
    a batch load a bad value fails the batch; if not strict it comes out null.
    """
    reader = (
        spark.readStream.schema(delimited.string_schema(contract.expected_columns))
        .options(**delimited.scan_options(contract.separator, contract.quote_char, contract.header, None, False, contract.multiline))
        .option("recursiveFileLookup", "true")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    last = contract.expected_columns[-1]
    cell = lambda c: delimited.without_cr(F.col(c)) if c == last and not contract.multiline else F.col(c)
    rows = reader.csv(folder).select(
        *[null_if(cell(c)).alias(c) for c in contract.expected_columns],
        inventory.period_of_path(F.col("_metadata.file_path")).alias("period"),
    )
    return delimited.apply_types(rows, contract.types, strict)


def ingest_new_files(
    spark: SparkSession,
    contract: Contract,
    folder: str,
    target: str,
    checkpoint: str,
    max_files: int | None = None,
    strict: bool = True,
) -> int:
    """Append everything new since the last call and return the rows added.

    The checkpoint remembers the files seen and the sink's log makes each batch
    appear once, so a second call over the same folder adds nothing.
    """
    keep = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(keep)
    # Rows are added up from the progress of every batch, so all of it must be kept.
    spark.conf.set(keep, str(ALL_BATCHES))
    try:
        query = _append(file_stream(spark, contract, folder, max_files, strict), target, checkpoint)
    finally:
        spark.conf.set(keep, before)
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def _append(rows: DataFrame, target: str, checkpoint: str):
    return (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy("period")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
