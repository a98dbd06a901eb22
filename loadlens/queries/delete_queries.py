"""Period-delete queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from loadlens.functions import dates
from loadlens.plans import delete as op
from loadlens.queries import query, table
from loadlens.queries.common import MONTH, day_text
from loadlens.queries.series_queries import SPELLED_SQL, spelled_orders

_MONTHS = ("1996-03", "1997-01", "2001-08")


def _month_test(column: str, month: str) -> str:
    first, last = dates.month_range(month)
    return f"CAST({column} AS DATE) BETWEEN DATE '{first}' AND DATE '{last}'"


@query(
    "delete_impact",
    f"""SELECT 'orders' AS table_name, count(*) AS total_rows, count(*) FILTER (WHERE {_month_test("o_orderdate", MONTH)}) AS rows_to_delete,
      round(count(*) FILTER (WHERE {_month_test("o_orderdate", MONTH)}) / count(*) * 100, 4) AS deletion_pct FROM orders""",
)
def delete_impact(spark, folder):
    out = op.delete_impact(table(spark, folder, "orders"), op.Deletion.of_month("orders", "o_orderdate", MONTH))
    return out.withColumn("deletion_pct", F.round("deletion_pct", 4))


@query(
    "delete_impact_multi",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, count(*) AS total_rows, '{dates.month_range(m)[0]}' AS period_start,
        '{dates.month_range(m)[1]}' AS period_end, count(*) FILTER (WHERE {_month_test(c, m)}) AS rows_to_delete FROM {t}"""
        for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
        for m in _MONTHS
    ),
)
def delete_impact_multi(spark, folder):
    frames = {n: table(spark, folder, n) for n in ("orders", "lineitem")}
    targets = [
        op.Deletion.of_month(t, c, m) for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate")) for m in _MONTHS
    ]
    return op.impact_of(frames, targets).withColumns(day_text("period_start", "period_end"))


@query(
    "delete_preview",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE {_month_test("o_orderdate", MONTH)}
    ORDER BY o_orderkey, o_custkey, o_totalprice LIMIT 10""",
)
def delete_preview(spark, folder):
    target = op.Deletion.of_month("orders", "o_orderdate", MONTH)
    out = op.delete_preview(table(spark, folder, "orders"), target, order=["o_orderkey", "o_custkey", "o_totalprice"])
    return out.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query(
    "delete_keep_month",
    f"""SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate FROM orders
    WHERE NOT coalesce({_month_test("o_orderdate", MONTH)}, false)""",
)
def delete_keep_month(spark, folder):
    kept = op.keep_rows(table(spark, folder, "orders"), [op.Deletion.of_month("orders", "o_orderdate", MONTH)])
    return kept.select("o_orderkey", "o_custkey", *[v.alias(k) for k, v in day_text("o_orderdate").items()])


@query(
    "delete_multi",
    f"""SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS d, count(*) AS n FROM lineitem
    WHERE NOT ({" OR ".join(_month_test("l_shipdate", m) for m in _MONTHS)}) GROUP BY 1""",
)
def delete_multi(spark, folder):
    targets = [op.Deletion.of_month("lineitem", "l_shipdate", m) for m in _MONTHS]
    kept = op.keep_rows(table(spark, folder, "lineitem"), targets)
    return kept.groupBy(F.date_format("l_shipdate", "yyyy-MM-dd").alias("d")).agg(F.count("*").alias("n"))


@query(
    "delete_by_spelling",
    f"""WITH {SPELLED_SQL} SELECT o_orderkey, cell FROM spelled
    WHERE NOT (cell LIKE '1996-03-%' OR cell LIKE '199603%' OR cell LIKE '%-03-1996' OR cell LIKE '03/%/1996')""",
)
def delete_by_spelling(spark, folder):
    target = op.Deletion.of_month("orders", "cell", MONTH, by_spelling=True)
    return op.keep_rows(spelled_orders(spark, folder), [target]).select("o_orderkey", "cell")


def _applied(spark, folder, partitioned: bool):
    """Delete a month from a copy of orders and count what the table then holds."""
    name = f"orders_{uuid.uuid4().hex[:8]}"
    orders = table(spark, folder, "orders")
    if partitioned:
        orders = orders.withColumn("period", F.date_format("o_orderdate", "yyyy-MM")).hint("rebalance", "period")
    op.external_table(spark, orders, name, "period" if partitioned else None)
    done = op.delete_period(
        spark,
        op.Deletion.of_month(name, "o_orderdate", MONTH),
        dry_run=False,
        month_partition="period" if partitioned else None,
    )
    if done[3] != "success":
        raise RuntimeError(f"delete ended as {done[3]}: {done[8]}")
    left = spark.table(name).groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))
    return left.withColumn("deleted", F.lit(done[5]).cast("bigint"))


_APPLIED_SQL = f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n,
  (SELECT count(*) FROM orders WHERE {_month_test("o_orderdate", MONTH)}) AS deleted
FROM orders WHERE NOT {_month_test("o_orderdate", MONTH)} GROUP BY 1"""


@query("delete_applied", _APPLIED_SQL)
def delete_applied(spark, folder):
    return _applied(spark, folder, partitioned=False)


@query("delete_applied_partition", _APPLIED_SQL)
def delete_applied_partition(spark, folder):
    return _applied(spark, folder, partitioned=True)


@query(
    "delete_restored",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1""",
)
def delete_restored(spark, folder):
    """A month is deleted and brought back from the recovery point."""
    name = f"orders_{uuid.uuid4().hex[:8]}"
    op.external_table(spark, table(spark, folder, "orders"), name)
    done = op.delete_period(spark, op.Deletion.of_month(name, "o_orderdate", MONTH), dry_run=False)
    op.restore(spark, name, done[7])
    return spark.table(name).groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


@query(
    "delete_records",
    f"""SELECT 'dry_run' AS status, count(*) AS total_rows_before, count(*) FILTER (WHERE {_month_test("o_orderdate", MONTH)}) AS rows_affected FROM orders
    UNION ALL SELECT 'skipped', count(*), 0 FROM orders
    UNION ALL SELECT 'failed', 0, 0""",
)
def delete_records(spark, folder):
    name = f"orders_{uuid.uuid4().hex[:8]}"
    op.external_table(spark, table(spark, folder, "orders"), name)
    targets = [
        op.Deletion.of_month(name, "o_orderdate", MONTH),
        op.Deletion.of_month(name, "o_orderdate", "1980-01"),
        op.Deletion.of_month("no_such_table", "o_orderdate", MONTH),
    ]
    return op.delete_periods(spark, targets, dry_run=True).select("status", "total_rows_before", "rows_affected")
