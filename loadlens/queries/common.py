"""Targets and SQL fragments shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.operators.series import Target, daily_series_of
from loadlens.queries import table

MONTH = "1996-03"
MONTH_START, MONTH_END = "1996-03-01", "1996-03-31"


def audited(spark: SparkSession, folder: str) -> list[Target]:
    """The three dated tables with their keys."""
    t = lambda n: table(spark, folder, n)
    return [
        Target("orders", t("orders"), "o_orderdate", ["o_custkey", "o_orderdate"]),
        Target("lineitem", t("lineitem"), "l_shipdate", ["l_orderkey", "l_linenumber"]),
        Target("events", t("events"), "ts", ["user_id", "event_type", "ts"]),
    ]


def reported(spark: SparkSession, folder: str) -> list[Target]:
    """The dated tables, a table without dates, an empty table and a missing one."""
    none_left = table(spark, folder, "orders").filter(F.col("o_orderkey") < 0)
    return [
        *audited(spark, folder),
        Target("region", table(spark, folder, "region")),
        Target("orders_archive", none_left, "o_orderdate", ["o_orderkey"]),
        Target("returns", None, "r_date", ["r_id"]),
    ]


def series(spark: SparkSession, folder: str) -> DataFrame:
    return daily_series_of(audited(spark, folder))


def day_text(*columns: str) -> dict:
    return {c: F.date_format(c, "yyyy-MM-dd") for c in columns}


SERIES_SQL = """
series AS (
  SELECT 'orders' AS table_name, CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1, 2
  UNION ALL
  SELECT 'lineitem', CAST(l_shipdate AS DATE), count(*) FROM lineitem GROUP BY 1, 2
  UNION ALL
  SELECT 'events', CAST(ts AS DATE), count(*) FROM events GROUP BY 1, 2
)"""

STATS_SQL = """
stats AS (
  SELECT table_name, avg(n) AS avg_count, stddev_samp(n) AS std_dev,
         quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.5) AS median, quantile_cont(n, 0.75) AS q3
  FROM series WHERE d IS NOT NULL GROUP BY table_name
)"""

CLASSIFIED_SQL = """
classified AS (
  SELECT s.table_name, s.d, s.n AS row_count, t.avg_count,
         CASE WHEN s.n < t.avg_count * 0.10 THEN 'SEVERELY_LOW'
              WHEN s.n < t.q1 - 1.5 * (t.q3 - t.q1) THEN 'OUTLIER_LOW'
              WHEN s.n < t.avg_count * 0.50 THEN 'LOW'
              WHEN s.n > t.q3 + 1.5 * (t.q3 - t.q1) THEN 'OUTLIER_HIGH'
              ELSE 'NORMAL' END AS severity
  FROM series s JOIN stats t USING (table_name) WHERE s.d IS NOT NULL
)"""

GAPS_SQL = """
steps AS (
  SELECT table_name, d, lag(d) OVER (PARTITION BY table_name ORDER BY d) AS prev
  FROM series WHERE d IS NOT NULL
),
gaps AS (
  SELECT table_name, prev, d, date_diff('day', prev, d) - 1 AS missing_days
  FROM steps WHERE date_diff('day', prev, d) > 1
)"""

DUP_GROUPS_SQL = """
groups AS (
  SELECT 'orders' AS table_name, count(*) AS n FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)
  UNION ALL
  SELECT 'lineitem', count(*) FROM lineitem GROUP BY l_orderkey, l_linenumber
  UNION ALL
  SELECT 'events', count(*) FROM events GROUP BY user_id, event_type, CAST(ts AS DATE)
),
dups AS (
  SELECT table_name, CAST(sum(n) AS BIGINT) AS total_rows,
         count(*) FILTER (WHERE n > 1) AS duplicate_keys,
         CAST(coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS excess_rows,
         CAST(coalesce(max(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS max_duplicates,
         round(coalesce(avg(n) FILTER (WHERE n > 1), 0), 2) AS avg_duplicates
  FROM groups GROUP BY table_name
)"""

COUNT_SEVERITY_SQL = """
CASE WHEN duplicate_keys = 0 THEN 'NONE'
     WHEN max_duplicates > 100 OR duplicate_keys > 1000 THEN 'CRITICAL'
     WHEN max_duplicates > 50 OR duplicate_keys > 100 THEN 'HIGH'
     WHEN max_duplicates > 10 OR duplicate_keys > 10 THEN 'MEDIUM'
     ELSE 'LOW' END"""

AUDIT_SQL = f"""
{SERIES_SQL},
{STATS_SQL},
{CLASSIFIED_SQL},
{GAPS_SQL},
{DUP_GROUPS_SQL},
extent AS (
  SELECT table_name, min(d) AS lo, max(d) AS hi, count(d) AS unique_dates,
         CAST(sum(n) FILTER (WHERE d IS NOT NULL) AS BIGINT) AS total_rows, CAST(sum(n) AS BIGINT) AS row_count
  FROM series GROUP BY table_name
),
gap_counts AS (
  SELECT table_name, count(*) AS gap_count, CAST(sum(missing_days) AS BIGINT) AS missing_dates
  FROM gaps GROUP BY table_name
),
kinds AS (
  SELECT table_name, count(*) FILTER (WHERE severity <> 'NORMAL') AS anomaly_count,
         count(*) FILTER (WHERE severity = 'SEVERELY_LOW') AS severely_low,
         count(*) FILTER (WHERE severity = 'OUTLIER_LOW') AS outlier_low,
         count(*) FILTER (WHERE severity = 'LOW') AS low,
         count(*) FILTER (WHERE severity = 'OUTLIER_HIGH') AS outlier_high
  FROM classified GROUP BY table_name
),
audit AS (
  SELECT e.table_name, e.row_count, e.total_rows, e.unique_dates, date_diff('day', e.lo, e.hi) + 1 AS expected_dates,
         CAST(e.lo AS VARCHAR) AS actual_start, CAST(e.hi AS VARCHAR) AS actual_end,
         coalesce(g.missing_dates, 0) AS missing_dates, coalesce(g.gap_count, 0) AS gap_count,
         k.anomaly_count, k.severely_low, k.outlier_low, k.low, k.outlier_high,
         p.duplicate_keys, p.excess_rows, p.max_duplicates, {COUNT_SEVERITY_SQL} AS duplicate_severity,
         e.total_rows / e.unique_dates AS avg_rows_per_day,
         coalesce(g.missing_dates, 0) = 0 AND k.severely_low = 0 AND k.outlier_low = 0
           AND p.duplicate_keys = 0 AS valid
  FROM extent e JOIN kinds k USING (table_name) JOIN dups p USING (table_name)
  LEFT JOIN gap_counts g USING (table_name)
)"""
