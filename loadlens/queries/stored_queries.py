"""Audits from stored summaries, after a month was added to a table and another taken away."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.operators import duplicates, sketches
from loadlens.operators.series import Target
from loadlens.plans import audit, stored
from loadlens.queries import query, table
from loadlens.queries.common import COUNT_SEVERITY_SQL, MONTH
from loadlens.session import scratch

_GONE = "1995-06"
_KEYS = ["o_custkey", "o_orderdate"]
_LEFT = f"strftime(o_orderdate, '%Y-%m') <> '{_GONE}'"


def _changed_table(spark, folder, summaries) -> tuple:
    """Orders by month: summaries are made without one month, then it is added, another is left out, and they catch up."""
    target = scratch(spark, "orders-by-month")
    rows = table(spark, folder, "orders").withColumn("period", F.date_format("o_orderdate", "yyyy-MM"))
    later = F.col("period") == MONTH
    for some in (rows.filter(~later | F.col("period").isNull()), rows.filter(later)):
        some.hint("rebalance", "period").write.mode("append").partitionBy("period").parquet(target)
        held = spark.read.option("basePath", target).parquet(target)
        done = [s.refresh(held) for s in summaries]
    # As after a delete by month: the partition is no longer part of the table, its files still lie there.
    listed = [f"{target}/period={r['period']}" for r in held.select("period").distinct().collect() if r["period"] != _GONE]
    left = spark.read.option("basePath", target).parquet(*listed)
    last = [s.refresh(left) for s in summaries]
    return left, done, last


@query(
    "stored_series",
    f"""SELECT 'orders' AS table_name, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d, count(*) AS n,
      (SELECT count(*) FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '{MONTH}') AS rows_read_for_added,
      CAST(0 AS BIGINT) AS rows_read_for_removed
    FROM orders WHERE {_LEFT} GROUP BY 2""",
)
def stored_series(spark, folder):
    """The daily series from the summary, and the rows that were read for the added and for the removed month."""
    days = stored.StoredSeries(spark, scratch(spark, "orders-series"), "o_orderdate", "orders")
    _, [added], [removed] = _changed_table(spark, folder, [days])
    return days.series().select(
        "table_name", F.date_format("d", "yyyy-MM-dd").alias("d"), "n",
        F.lit(added.rows_read).cast("bigint").alias("rows_read_for_added"), F.lit(removed.rows_read).cast("bigint").alias("rows_read_for_removed"),
    )


@query(
    "stored_duplicates",
    f"""WITH groups AS (SELECT count(*) AS n FROM orders WHERE {_LEFT} GROUP BY o_custkey, CAST(o_orderdate AS DATE)),
    s AS (SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) FILTER (WHERE n > 1) AS duplicate_keys,
        CAST(coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS excess_rows,
        CAST(coalesce(max(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS max_duplicates FROM groups)
    SELECT *, {COUNT_SEVERITY_SQL} AS severity,
      (SELECT count(*) FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '{MONTH}') AS rows_read_for_added,
      (SELECT count(*) FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '{_GONE}') AS rows_read_for_removed
    FROM s""",
)
def stored_duplicates(spark, folder):
    """Duplicate statistics from the stored keys, and the rows that were read for the added and for the removed month."""
    keys = stored.StoredKeys(spark, scratch(spark, "orders-keys"), _KEYS, "o_orderdate", buckets=8)
    _, [added], [removed] = _changed_table(spark, folder, [keys])
    stats = duplicates.duplicate_stats(keys.groups(), _KEYS)
    return stats.select(
        "total_rows", "duplicate_keys", "excess_rows", "max_duplicates", duplicates.severity("count").alias("severity"),
        F.lit(added.rows_read).cast("bigint").alias("rows_read_for_added"), F.lit(removed.rows_read).cast("bigint").alias("rows_read_for_removed"),
    )


@query(
    "validate_month_stored",
    f"""WITH days AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '{MONTH}' GROUP BY 1),
    groups AS (SELECT count(*) AS n FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '{MONTH}' GROUP BY o_custkey, CAST(o_orderdate AS DATE))
    SELECT 'orders' AS table_name, (SELECT count(*) FROM orders WHERE {_LEFT}) AS row_count, CAST(sum(n) AS BIGINT) AS total_rows,
      count(*) AS unique_dates, CAST(31 - count(*) AS BIGINT) AS missing_dates,
      (SELECT count(*) FILTER (WHERE n > 1) FROM groups) AS duplicate_keys FROM days""",
)
def validate_month_stored(spark, folder):
    """Validation of the added month: days from the summary, keys from the month's own rows."""
    days = stored.StoredSeries(spark, scratch(spark, "orders-series"), "o_orderdate", "orders")
    left, _, _ = _changed_table(spark, folder, [days])
    target = Target("orders", left, "o_orderdate", _KEYS, series=days.series())
    out = audit.validate_month(spark, [target], MONTH)
    return out.select(
        "table_name", "row_count", "total_rows", "unique_dates", F.col("missing_dates").cast("bigint").alias("missing_dates"), "duplicate_keys"
    )


_PROFILED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query(
    "stored_profile",
    "WITH t AS (SELECT * FROM orders WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '1995-01' AND '1996-12' AND "
    + _LEFT
    + ") "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"{'min(' + c + ')' if c not in ('o_orderstatus', 'o_orderpriority') else 'NULL'}::DOUBLE AS low_number, "
        f"true AS distinct_near, {'true' if c not in ('o_orderstatus', 'o_orderpriority') else 'NULL'} AS median_near FROM t"
        for c in _PROFILED
    ),
)
def stored_profile(spark, folder):
    """Two years' profile united from sketches per file and month, held against the exact counts of the rows."""
    kept = stored.StoredSketches(spark, scratch(spark, "orders-sketches"), "o_orderdate", _PROFILED)
    left, _, _ = _changed_table(spark, folder, [kept])
    told = kept.profile("1995-01", "1996-12")
    rows = left.filter(F.date_format("o_orderdate", "yyyy-MM").between("1995-01", "1996-12"))
    exact = rows.agg(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("exact")) for c in _PROFILED
    ]).alias("x")).select(F.inline("x"))
    medians = told.filter("quantile_estimates IS NOT NULL").select("column_name", F.col("quantile_estimates")[1].alias("median"))
    values = rows.select(*[F.col(c).cast("double").alias(c) for c in _PROFILED if c not in ("o_orderstatus", "o_orderpriority")])
    ranked = values.unpivot([], values.columns, "column_name", "value").join(medians, "column_name").groupBy("column_name").agg(
        F.avg((F.col("value") < F.col("median")).cast("double")).alias("under"), F.avg((F.col("value") <= F.col("median")).cast("double")).alias("upto")
    )
    near = (F.col("under") <= 0.5 + sketches.RANK_BOUND) & (F.col("upto") >= 0.5 - sketches.RANK_BOUND)
    off = F.abs(F.col("distinct_estimate") - F.col("exact")) <= F.col("exact") * sketches.DISTINCT_BOUND
    return told.join(exact, "column_name").join(ranked, "column_name", "left").select(
        "column_name", "row_count", "null_count", "low_number", off.alias("distinct_near"), near.alias("median_near")
    )
