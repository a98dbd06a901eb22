"""Running daily volume of an event stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _utc_day(time: str) -> Column:
    """The day of an instant in UTC, whatever the session's zone."""
    return F.expr(f"date_from_unix_date(CAST(unix_seconds({time}) DIV 86400 AS INT))")


def daily_volume(events: DataFrame, time_column: str, delay: str = "1 hour") -> DataFrame:
    """Rows per day, each day final once the watermark has passed it.

    Days are those of UTC. State is one row per open day. Rows later than ``delay`` are dropped and
    show up in the query's ``numRowsDroppedByWatermark``.
    """
    return (
        events.select(F.col(time_column).cast("timestamp").alias("at"))
        .withWatermark("at", delay)
        .groupBy(F.window("at", "1 day"))
        .agg(F.count("*").alias("row_count"))
        .select(_utc_day("window.start").alias("d"), "row_count")
    )


def run_daily_volume(events: DataFrame, time_column: str, target: str, checkpoint: str, delay: str = "1 hour"):
    """Process what is available, append finished days to ``target``, return the query."""
    query = (
        daily_volume(events, time_column, delay)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
