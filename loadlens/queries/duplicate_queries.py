"""Duplicate-key queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.operators import duplicates as op
from loadlens.queries import query, table
from loadlens.queries.common import COUNT_SEVERITY_SQL, DUP_GROUPS_SQL, MONTH_END, MONTH_START, audited

_STATS = ("total_rows", "duplicate_keys", "excess_rows", "max_duplicates", "avg_duplicates")


@query("dup_stats", f"WITH {DUP_GROUPS_SQL} SELECT * FROM dups")
def dup_stats(spark, folder):
    return op.check_tables(audited(spark, folder)).select("table_name", *_STATS)


@query(
    "dup_multi_table",
    f"""WITH {DUP_GROUPS_SQL}
    SELECT table_name, total_rows, duplicate_keys, excess_rows, round(excess_rows / total_rows * 100, 4) AS duplicate_pct,
           {COUNT_SEVERITY_SQL} AS severity FROM dups""",
)
def dup_multi_table(spark, folder):
    return op.check_tables(audited(spark, folder)).select(
        "table_name", "total_rows", "duplicate_keys", "excess_rows",
        F.round("duplicate_pct", 4).alias("duplicate_pct"), "severity",
    )


@query(
    "dup_severity_count",
    f"WITH {DUP_GROUPS_SQL} SELECT table_name, {COUNT_SEVERITY_SQL} AS severity FROM dups",
)
def dup_severity_count(spark, folder):
    return op.check_tables(audited(spark, folder), "count").select("table_name", "severity")


_RATIO = """CASE WHEN duplicate_keys = 0 THEN 'NONE'
  WHEN excess_rows * 100.0 / total_rows > 10 OR {r} > 100 THEN 'CRITICAL'
  WHEN excess_rows * 100.0 / total_rows > 5 OR {r} > 50 THEN 'HIGH'
  WHEN excess_rows * 100.0 / total_rows > 1 OR {r} > 10 THEN 'MEDIUM' ELSE 'LOW' END"""


@query(
    "dup_severity_ratio",
    f"WITH {DUP_GROUPS_SQL} SELECT table_name, {_RATIO.format(r='total_rows / duplicate_keys')} AS severity FROM dups",
)
def dup_severity_ratio(spark, folder):
    return op.check_tables(audited(spark, folder), "ratio").select("table_name", "severity")


@query(
    "dup_severity_documented",
    f"""WITH {DUP_GROUPS_SQL}
    SELECT table_name, {_RATIO.format(r='(excess_rows + duplicate_keys) / duplicate_keys')} AS severity FROM dups""",
)
def dup_severity_documented(spark, folder):
    return op.check_tables(audited(spark, folder), "documented").select("table_name", "severity")


@query(
    "dup_samples",
    """SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem GROUP BY ALL
    HAVING count(*) > 1 ORDER BY duplicate_count DESC, l_orderkey, l_linenumber LIMIT 10""",
)
def dup_samples(spark, folder):
    keys = ["l_orderkey", "l_linenumber"]
    return op.duplicate_samples(op.key_groups(table(spark, folder, "lineitem"), keys), keys)


@query(
    "dup_samples_dated",
    """SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, count(*) AS duplicate_count
    FROM orders GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY duplicate_count DESC, 1, 2 LIMIT 3""",
)
def dup_samples_dated(spark, folder):
    keys = ["o_custkey", "o_orderdate"]
    groups = op.key_groups(table(spark, folder, "orders"), keys, date_column="o_orderdate")
    out = op.duplicate_samples(groups, keys, limit=3)
    return out.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query(
    "dup_check_range",
    f"""WITH groups AS (SELECT count(*) AS n FROM events
      WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-14' GROUP BY user_id, event_type, CAST(ts AS DATE)),
    dups AS (SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) FILTER (WHERE n > 1) AS duplicate_keys,
      CAST(sum(n - 1) AS BIGINT) AS excess_rows FROM groups)
    SELECT *, round(excess_rows / total_rows * 100, 4) AS duplicate_pct, {_RATIO.format(r='total_rows / duplicate_keys')} AS severity
    FROM dups""",
)
def dup_check_range(spark, folder):
    out = op.check_duplicates(
        table(spark, folder, "events"), ["user_id", "event_type", "ts"], "ts", "2024-01-05", "2024-01-14"
    )
    return out.select(
        "total_rows", "duplicate_keys", "excess_rows", F.round("duplicate_pct", 4).alias("duplicate_pct"), "severity"
    )


@query(
    "dup_range_empty",
    f"""SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS duplicate_keys, 'NONE' AS severity FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '{MONTH_START}' AND DATE '{MONTH_END}'""",
)
def dup_range_empty(spark, folder):
    out = op.check_duplicates(table(spark, folder, "events"), ["user_id"], "ts", MONTH_START, MONTH_END)
    return out.select("total_rows", "duplicate_keys", "severity")


@query(
    "dup_null_keys",
    """WITH groups AS (SELECT o_custkey, nullif(o_orderpriority, '5-LOW') AS priority, count(*) AS n FROM orders GROUP BY ALL)
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) FILTER (WHERE n > 1) AS duplicate_keys,
           CAST(coalesce(sum(n) FILTER (WHERE o_custkey IS NULL OR priority IS NULL), 0) AS BIGINT) AS null_key_rows,
           count(*) FILTER (WHERE n > 1 AND (o_custkey IS NULL OR priority IS NULL)) AS null_duplicate_keys
    FROM groups""",
)
def dup_null_keys(spark, folder):
    keys = ["o_custkey", "priority"]
    orders = table(spark, folder, "orders").withColumn("priority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    out = op.duplicate_stats(op.key_groups(orders, keys), keys)
    return out.select("total_rows", "duplicate_keys", "null_key_rows", "null_duplicate_keys")


@query(
    "dup_long_text",
    """WITH groups AS (SELECT text, count(*) AS n FROM documents GROUP BY text)
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) FILTER (WHERE n > 1) AS duplicate_keys,
           CAST(sum(n - 1) AS BIGINT) AS excess_rows, CAST(coalesce(max(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS max_duplicates,
           round(coalesce(avg(n) FILTER (WHERE n > 1), 0), 2) AS avg_duplicates FROM groups""",
)
def dup_long_text(spark, folder):
    groups = op.key_groups(table(spark, folder, "documents"), ["text"], digest=("text",))
    return op.duplicate_stats(groups, ["text"]).select(*_STATS)


@query(
    "dup_turns",
    """WITH groups AS (SELECT conv_id, turn, count(*) AS n FROM conversations GROUP BY ALL)
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) FILTER (WHERE n > 1) AS duplicate_keys,
           CAST(sum(n - 1) AS BIGINT) AS excess_rows FROM groups""",
)
def dup_turns(spark, folder):
    keys = ["conv_id", "turn"]
    groups = op.key_groups(table(spark, folder, "conversations"), keys)
    return op.duplicate_stats(groups, keys).select("total_rows", "duplicate_keys", "excess_rows")
