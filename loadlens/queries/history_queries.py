"""Load-history queries; events are read as a history of loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.operators import history as op
from loadlens.queries import query, table

# Error and purchase events are loads; what went wrong with the errors follows from user and value.
HISTORY_SQL = """
history AS (
  SELECT CAST(event_id AS VARCHAR) AS query_id, 'COPY INTO ' || event_type AS query_text,
    CASE WHEN event_type IN ('error', 'purchase') THEN 'COPY' ELSE upper(event_type) END AS query_type,
    CASE WHEN event_type = 'error' THEN CASE WHEN value >= 100 THEN '000603' WHEN value >= 50 THEN '300005' ELSE '100035' END END AS error_code,
    CASE WHEN event_type = 'error' THEN CASE user_id % 4 WHEN 0 THEN 'Internal incident ' || event_id WHEN 1 THEN 'Statement TIMEOUT reached'
      WHEN 2 THEN 'out of memory, timeout' ELSE 'bad value' END END AS error_message,
    ts AS start_time, value * 2 AS elapsed_seconds, value AS exec_seconds, value / 2 AS queue_seconds, value / 4 AS compile_seconds,
    user_id * 10 AS rows_produced, value * 3 AS mb_scanned, props AS table_name
  FROM events
),
recent AS (SELECT * FROM history WHERE start_time >= (SELECT max(ts) FROM events) - INTERVAL 48 HOUR)"""
HOURS = 48


def load_history(spark, folder):
    value, user, kind = F.col("value"), F.col("user_id"), F.col("event_type")
    code = F.when(value >= 100, "000603").when(value >= 50, "300005").otherwise("100035")
    message = (
        F.when(user % 4 == 0, F.concat(F.lit("Internal incident "), F.col("event_id").cast("string")))
        .when(user % 4 == 1, "Statement TIMEOUT reached")
        .when(user % 4 == 2, "out of memory, timeout")
        .otherwise("bad value")
    )
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("query_id"),
        F.concat(F.lit("COPY INTO "), kind).alias("query_text"),
        F.when(kind.isin("error", "purchase"), "COPY").otherwise(F.upper(kind)).alias("query_type"),
        F.when(kind == "error", code).alias("error_code"),
        F.when(kind == "error", message).alias("error_message"),
        F.col("ts").cast("timestamp").alias("start_time"),
        (value * 2).alias("elapsed_seconds"),
        value.alias("exec_seconds"),
        (value / 2).alias("queue_seconds"),
        (value / 4).alias("compile_seconds"),
        (user * 10).alias("rows_produced"),
        (value * 3).alias("mb_scanned"),
        F.col("props").alias("table_name"),
    )


def newest(spark, folder):
    """The latest start time, standing in for the present."""
    return table(spark, folder, "events").agg(F.max(F.col("ts").cast("timestamp"))).scalar()


_FAILED = "(error_code IN ('000603', '300005') OR contains(error_message, 'incident') OR (query_type = 'COPY' AND error_code IS NOT NULL))"


@query(
    "load_errors",
    f"""WITH {HISTORY_SQL} SELECT query_id, error_code, error_message, elapsed_seconds FROM recent WHERE {_FAILED}
    ORDER BY start_time DESC, query_id LIMIT 10""",
)
def load_errors(spark, folder):
    found = op.load_errors(load_history(spark, folder), HOURS, newest(spark, folder), limit=10)
    return found.select("query_id", "error_code", "error_message", "elapsed_seconds")


@query(
    "load_errors_all",
    f"WITH {HISTORY_SQL} SELECT query_id, error_code, error_message FROM recent WHERE {_FAILED}",
)
def load_errors_all(spark, folder):
    found = op.load_errors(load_history(spark, folder), HOURS, newest(spark, folder), limit=None)
    return found.select("query_id", "error_code", "error_message")


@query(
    "error_classes",
    f"""WITH {HISTORY_SQL}, failed AS (SELECT lower(error_message) AS m FROM recent WHERE {_FAILED})
    SELECT c AS error_class, count(*) AS errors FROM failed JOIN (VALUES ('incident'), ('timeout'), ('memory')) v(c) ON contains(m, c) GROUP BY c""",
)
def error_classes(spark, folder):
    found = op.load_errors(load_history(spark, folder), HOURS, newest(spark, folder), limit=None)
    return op.error_classes(found).select("error_class", "errors")


@query(
    "load_perf",
    f"""WITH {HISTORY_SQL} SELECT query_id, elapsed_seconds, exec_seconds, queue_seconds, compile_seconds, rows_produced, mb_scanned,
      elapsed_seconds > 300 AS slow FROM recent WHERE query_type = 'COPY' ORDER BY start_time DESC, query_id LIMIT 10""",
)
def load_perf(spark, folder):
    return op.load_performance(load_history(spark, folder), HOURS, newest(spark, folder), limit=10).drop("start_time")


@query(
    "load_throughput",
    f"""WITH {HISTORY_SQL} SELECT table_name, count(*) AS loads, CAST(sum(rows_produced) AS BIGINT) AS rows_loaded,
      round(sum(elapsed_seconds), 4) AS seconds, round(avg(elapsed_seconds), 6) AS avg_seconds,
      count(*) FILTER (WHERE elapsed_seconds > 300) AS slow_loads, round(sum(rows_produced) / sum(elapsed_seconds), 4) AS rows_per_second
    FROM history WHERE query_type = 'COPY' AND error_code IS NULL GROUP BY table_name""",
)
def load_throughput(spark, folder):
    out = op.load_throughput(load_history(spark, folder))
    return out.withColumns({c: F.round(c, 6 if c == "avg_seconds" else 4) for c in ("seconds", "avg_seconds", "rows_per_second")})


@query(
    "load_estimate",
    f"""WITH {HISTORY_SQL}, speed AS (SELECT table_name, sum(rows_produced) / sum(elapsed_seconds) AS r FROM history
      WHERE query_type = 'COPY' AND error_code IS NULL GROUP BY table_name),
    waiting AS (SELECT props AS table_name, count(*) AS row_count FROM events WHERE event_type = 'signup' GROUP BY props)
    SELECT table_name, row_count, round(row_count / nullif(r, 0), 4) AS estimated_seconds FROM waiting LEFT JOIN speed USING (table_name)""",
)
def load_estimate(spark, folder):
    waiting = (
        table(spark, folder, "events")
        .filter(F.col("event_type") == "signup")
        .groupBy(F.col("props").alias("table_name"))
        .agg(F.count("*").alias("row_count"))
    )
    out = op.estimate_load_seconds(op.load_throughput(load_history(spark, folder)), waiting)
    return out.withColumn("estimated_seconds", F.round("estimated_seconds", 4))
