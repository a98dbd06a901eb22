"""Streaming queries, each run until what is there has been processed."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.queries import query, table
from loadlens.queries.file_queries import ORDERS, month_landing
from loadlens.session import scratch
from loadlens.streaming import distinct, ingest, volume


@query(
    "incremental_ingest",
    """SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS rows_loaded, (SELECT count(*) FROM orders) AS first_run,
      CAST(0 AS BIGINT) AS second_run FROM orders GROUP BY 1""",
)
def incremental_ingest(spark, folder):
    """Two runs over the same landing folder; the second adds nothing."""
    landing, target, state = month_landing(spark, folder), scratch(spark, "ingest"), scratch(spark, "ingest-state")
    first = ingest.ingest_new_files(spark, ORDERS, landing, target, state, max_files=200)
    second = ingest.ingest_new_files(spark, ORDERS, landing, target, state, max_files=200)
    counts = spark.read.parquet(target).groupBy(F.col("period").cast("string").alias("period")).agg(
        F.count("*").alias("rows_loaded")
    )
    return counts.withColumn("first_run", F.lit(first).cast("bigint")).withColumn("second_run", F.lit(second).cast("bigint"))


@query(
    "daily_volume_stream",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS d, count(*) AS row_count FROM events GROUP BY 1
    HAVING CAST(max(ts) AS DATE) + 1 <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
)
def daily_volume_stream(spark, folder):
    """Finished days of the event stream: those the watermark has passed."""
    events = (
        spark.readStream.schema(table(spark, folder, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(folder)
    )
    target = scratch(spark, "daily-volume")
    volume.run_daily_volume(events, "ts", target, scratch(spark, "daily-volume-state"))
    return spark.read.parquet(target).select(F.date_format("d", "yyyy-MM-dd").alias("d"), "row_count")


@query(
    "stream_distinct",
    """WITH keys AS (SELECT DISTINCT o_custkey, o_orderdate FROM orders WHERE o_orderdate IS NOT NULL),
    n AS (SELECT count(*) AS timed, (SELECT count(*) FROM keys) AS n_keys FROM orders WHERE o_orderdate IS NOT NULL)
    SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS kept, any_value(timed - n_keys) AS dropped_first,
      any_value(timed) AS dropped_second, CAST(0 AS BIGINT) AS late, any_value(n_keys) AS open_keys FROM keys, n GROUP BY 1""",
)
def stream_distinct(spark, folder):
    """Keys of orders, each once, after all files arrived a second time and the stream was started anew."""
    landing, target, state = (scratch(spark, name) for name in ("keys-landing", "keys", "keys-state"))
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate")
    runs = []
    for _ in range(2):
        orders.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(orders.schema).parquet(landing)
        runs.append(distinct.run_distinct(stream, ["o_custkey", "o_orderdate"], "o_orderdate", target, state, "36500 days"))
    counts = spark.read.parquet(target).groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("kept"))
    told = {
        "dropped_first": runs[0].duplicates, "dropped_second": runs[1].duplicates,
        "late": sum(r.late for r in runs), "open_keys": runs[1].open_keys,
    }
    return counts.select("*", *[F.lit(value).cast("bigint").alias(name) for name, value in told.items()])
