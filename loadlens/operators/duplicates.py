"""Duplicate keys: statistics, samples, severities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions import dates
from loadlens.operators.series import Target, union_all
from loadlens.session import literal_frame

POLICIES = ("count", "ratio", "documented")


def key_groups(
    df: DataFrame,
    keys: list[str],
    date_column: str | None = None,
    start=None,
    end=None,
    digest: tuple[str, ...] = (),
) -> DataFrame:
    """Rows per key, nulls grouping together; the date key is compared as a day.

    Counting starts inside each task, so a key that holds a third of the rows
    sends one row per task. ``digest`` columns are long texts: they are grouped
    by their SHA-256, which keeps whole documents out of the shuffle.
    """
    if date_column and start is not None and end is not None:
        df = df.filter(dates.date_between(df, date_column, start, end))
    exprs = []
    for k in keys:
        if date_column and k.lower() == date_column.lower():
            exprs.append(dates.as_date(df, k).alias(k))
        elif k in digest:
            exprs.append(F.sha2(F.col(k), 256).alias(k))
        else:
            exprs.append(F.col(k))
    return df.groupBy(*exprs).agg(F.count("*").alias("n"))


def null_key(keys: list[str]) -> Column:
    test = F.lit(False)
    for k in keys:
        test = test | F.col(k).isNull()
    return test


_STATS = (
    "coalesce(sum(n), 0) as total_rows",
    "count_if(n > 1) as duplicate_keys",
    "coalesce(sum(n - 1) filter (where n > 1), 0) as excess_rows",
    "coalesce(max(n) filter (where n > 1), 0) as max_duplicates",
    "coalesce(round(avg(n) filter (where n > 1), 2), 0.0D) as avg_duplicates",
    "coalesce(sum(n) filter (where has_null), 0) as null_key_rows",
    "count_if(n > 1 and has_null) as null_duplicate_keys",
)


def group_sizes(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Size of each key group and whether part of its key is missing."""
    return groups.select("n", null_key(keys).alias("has_null"))


def duplicate_stats(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Total rows, duplicate keys, excess rows, largest and mean group, null keys.

    Totals come from the same groups, so one shuffle serves all of them.
    """
    return group_sizes(groups, keys).agg(*[F.expr(e) for e in _STATS])


def duplicate_samples(groups: DataFrame, keys: list[str], limit: int = 10) -> DataFrame:
    """The most repeated keys; equal counts are ordered by key."""
    return (
        groups.filter(F.col("n") > 1)
        .orderBy(F.col("n").desc(), *[F.col(k).asc_nulls_first() for k in keys])
        .limit(limit)
        .withColumnRenamed("n", "duplicate_count")
    )


def duplicate_percentage() -> Column:
    return F.when(F.col("total_rows") > 0, F.col("excess_rows") / F.col("total_rows") * 100).otherwise(
        F.lit(0.0)
    )


def _graded(share: Column, size: Column, shares, sizes) -> Column:
    out = F.lit("LOW")
    for name, s, z in reversed(list(zip(("CRITICAL", "HIGH", "MEDIUM"), shares, sizes))):
        out = F.when((share > s) | (size > z), name).otherwise(out)
    return F.when(F.col("duplicate_keys") == 0, "NONE").otherwise(out)


def severity(policy: str = "count") -> Column:
    """Severity from duplicate statistics.

    ``count``       number of duplicate keys and the largest group
    ``ratio``       excess share, and all rows over duplicate keys
    ``documented``  excess share, and mean rows per duplicate key
    """
    keys = F.col("duplicate_keys")
    if policy == "count":
        return _graded(keys, F.col("max_duplicates"), (1000, 100, 10), (100, 50, 10))
    per_key = F.when(
        keys > 0, (F.col("total_rows") if policy == "ratio" else F.col("excess_rows") + keys) / keys
    )
    return _graded(duplicate_percentage(), per_key, (10, 5, 1), (100, 50, 10))


def check_duplicates(
    df: DataFrame,
    keys: list[str],
    date_column: str | None = None,
    start=None,
    end=None,
    policy: str = "ratio",
    digest: tuple[str, ...] = (),
) -> DataFrame:
    """One-row duplicate report of a table, optionally inside a day range."""
    groups = key_groups(df, keys, date_column, start, end, digest)
    return duplicate_stats(groups, keys).select(
        "*", duplicate_percentage().alias("duplicate_pct"), severity(policy).alias("severity")
    )


def check_tables(targets: list[Target], policy: str = "count") -> DataFrame:
    """Duplicate reports of several tables, one row each.

    The sizes of all tables' groups go through one aggregation; a table whose
    keys are stored and that is judged as a whole is not read. A size of zero
    is added per table, so that a table without rows still has its report.
    """
    sizes = []
    for t in targets:
        if t.df is None or not t.key_columns:
            continue
        name = F.lit(t.table_name).alias("table_name")
        if t.sizes is not None and t.start is None and t.end is None:
            sizes.append(t.sizes.select(name, "n", "has_null"))
            continue
        groups = key_groups(t.df, t.key_columns, t.date_column, t.start, t.end)
        sizes.append(group_sizes(groups, t.key_columns).select(name, "n", "has_null"))
    spark = SparkSession.active()
    named = [(t.table_name, 0, False) for t in targets if t.df is not None and t.key_columns]
    sizes.append(literal_frame(spark, named, "table_name string, n bigint, has_null boolean"))
    stats = union_all(sizes).groupBy("table_name").agg(*[F.expr(e) for e in _STATS])
    return stats.select("*", duplicate_percentage().alias("duplicate_pct"), severity(policy).alias("severity"))
