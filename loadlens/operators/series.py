"""Daily series of a table: completeness, gaps, missing dates, volume anomalies.

``daily_series`` is the one scan. Every other operator reads its result,
which has one row per table and calendar day, so windows over it stay small
however large the table is.

    table_name  table
    d           day, null for rows whose date does not parse
    n           rows
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions import dates
from loadlens.functions.text import percent
from loadlens.session import literal_frame

# Anomaly thresholds and the order severities are listed in.
SEVERELY_LOW_SHARE = 0.10
LOW_SHARE = 0.50
IQR_MULTIPLIER = 1.5
SEVERITIES = ("SEVERELY_LOW", "OUTLIER_LOW", "LOW", "OUTLIER_HIGH")


@dataclass
class Target:
    """A table to audit: data, date column, key columns, requested day range."""

    table_name: str
    df: DataFrame | None
    date_column: str | None = None
    key_columns: list[str] = field(default_factory=list)
    start: object = None
    end: object = None
    #: What a stored summary holds, to be used in place of a scan: the daily series, and keys with ``n`` and ``has_null``.
    series: DataFrame | None = None
    sizes: DataFrame | None = None


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _range_columns(target: Target) -> list[Column]:
    named = (("requested_start", target.start), ("requested_end", target.end))
    return [F.lit(None if v is None else dates.to_day(v)).cast("date").alias(name) for name, v in named]


def daily_series(
    df: DataFrame, date_column: str, table_name: str = "", start=None, end=None, extra: Sequence[Column] = ()
) -> DataFrame:
    """Rows per day of one table. A range given here is pushed to the scan."""
    if start is not None and end is not None:
        df = df.filter(dates.date_between(df, date_column, start, end))
    return (
        df.groupBy(dates.as_date(df, date_column).alias("d"))
        .agg(F.count("*").alias("n"))
        .select(F.lit(table_name).alias("table_name"), "d", "n", *extra)
    )


def row_total(target: Target) -> DataFrame:
    """All rows of a table as one entry without a day, shaped like its daily series."""
    counted = target.df.agg(F.count("*").alias("n"))
    day = F.lit(None).cast("date").alias("d")
    return counted.select(F.lit(target.table_name).alias("table_name"), day, "n", *_range_columns(target))


def daily_series_of(
    targets: list[Target], push_range: bool = False, with_range: bool = False, undated: bool = False
) -> DataFrame:
    """The daily series of several tables, one scan each.

    ``with_range`` adds each table's requested first and last day as columns;
    ``undated`` then also adds tables without a date column as row totals.
    """
    frames = []
    for t in targets:
        if t.df is None:
            continue
        if not t.date_column:
            if undated:
                frames.append(row_total(t))
            continue
        bounds = (t.start, t.end) if push_range else (None, None)
        if t.series is not None:
            known = t.series if None in bounds else days(t.series, *bounds)
            frames.append(known.select(F.lit(t.table_name).alias("table_name"), "d", "n", *(_range_columns(t) if with_range else ())))
            continue
        frames.append(daily_series(t.df, t.date_column, t.table_name, *bounds, extra=_range_columns(t) if with_range else ()))
    return union_all(frames)


def days(series: DataFrame, start=None, end=None) -> DataFrame:
    """Days that have a date, inside the range if both bounds are given."""
    found = series.filter(F.col("d").isNotNull())
    if start is not None and end is not None:
        found = found.filter(F.col("d").between(F.lit(dates.to_day(start)), F.lit(dates.to_day(end))))
    return found


def date_extent(series: DataFrame) -> DataFrame:
    """First and last parsed day per table."""
    return series.groupBy("table_name").agg(F.min("d").alias("min_date"), F.max("d").alias("max_date"))


def range_summary(series: DataFrame, start=None, end=None) -> DataFrame:
    """First and last day, number of days and rows inside the range."""
    return (
        days(series, start, end)
        .groupBy("table_name")
        .agg(
            F.min("d").alias("min_date"),
            F.max("d").alias("max_date"),
            F.count("*").alias("unique_dates"),
            F.sum("n").alias("total_rows"),
        )
    )


def unparseable_rows(series: DataFrame) -> DataFrame:
    """Rows per table whose date is missing or does not parse."""
    return series.groupBy("table_name").agg(
        F.coalesce(F.sum(F.when(F.col("d").isNull(), F.col("n"))), F.lit(0)).alias("unparseable_date_rows")
    )


def date_gaps(series: DataFrame, start=None, end=None) -> DataFrame:
    """Consecutive present days more than one day apart."""
    by_day = Window.partitionBy("table_name").orderBy("d")
    before = F.lag("d").over(by_day)
    return (
        days(series, start, end)
        .select("table_name", before.alias("prev_date"), F.col("d").alias("next_date"))
        .withColumn("missing_days", (F.datediff("next_date", "prev_date") - 1).cast("bigint"))
        .filter(F.col("missing_days") > 0)
    )


def first_of_each(df: DataFrame, group: str, order: list, limit: int) -> DataFrame:
    """The first rows of each group; ``truncated`` tells whether the group has more.

    One row more than asked for is ranked, so that no group is gathered whole.
    """
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    more = F.max("rank").over(Window.partitionBy(group)) > limit
    return ranked.filter(F.col("rank") <= limit + 1).withColumn("truncated", more).filter(F.col("rank") <= limit).drop("rank")


def listed_gaps(series: DataFrame, start=None, end=None, limit: int | None = None) -> DataFrame:
    """The gaps of each table; the first ``limit`` with a flag ``truncated`` if a limit is asked for."""
    gaps = date_gaps(series, start, end)
    return gaps if limit is None else first_of_each(gaps, "table_name", ["prev_date"], limit)


def missing_from_gaps(series: DataFrame, start=None, end=None, longest: int | None = None) -> DataFrame:
    """Days inside gaps; gaps of more than ``longest`` days are left out only if asked for."""
    gaps = date_gaps(series, start, end)
    if longest is not None:
        gaps = gaps.filter(F.col("missing_days") <= longest)
    inside = F.sequence(F.date_add("prev_date", 1), F.date_sub("next_date", 1))
    return gaps.select("table_name", F.explode(inside).alias("missing_date"))


def with_tables(series: DataFrame, tables: Sequence[str]) -> DataFrame:
    """The series with an entry of no rows for each named table, so that one without rows is still there."""
    if not tables:
        return series
    named = literal_frame(series.sparkSession, [(t, None, 0) for t in tables], "table_name string, d date, n bigint")
    return series.select("table_name", "d", "n").unionByName(named)


def missing_days(series: DataFrame, start=None, end=None, tables: Sequence[str] = ()) -> DataFrame:
    """Calendar days without rows: the requested range, else first to last day.

    A table's present days are gathered once (no more than the calendar has)
    and taken out of the expected ones. A table without any row is in no
    series; named in ``tables`` it misses the whole range.
    """
    series = with_tables(series, tables)
    present = F.col("d")
    if start is not None and end is not None:
        lo, hi = F.lit(dates.to_day(start)), F.lit(dates.to_day(end))
        present = F.when(present.between(lo, hi), present)
    else:
        lo, hi = F.col("lo"), F.col("hi")
    return (
        series.groupBy("table_name")
        .agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.collect_list(present).alias("present"))
        .select("table_name", F.explode(F.array_except(F.sequence(lo, hi), "present")).alias("missing_date"))
    )


def date_distribution(series: DataFrame, start, end) -> DataFrame:
    """Rows per day inside the expected range; other days are ignored."""
    return days(series, start, end).select("table_name", "d", F.col("n").alias("row_count"))


def completeness(series: DataFrame, start=None, end=None, tables: Sequence[str] = ()) -> DataFrame:
    """Completeness per table, also for tables with nothing in the range.

    One pass over the whole series; the range only decides which days count.
    Tables without any row have their entry if they are named in ``tables``.
    """
    series = with_tables(series, tables)
    has_range = start is not None and end is not None
    lo = F.lit(dates.to_day(start)) if has_range else F.lit(None).cast("date")
    hi = F.lit(dates.to_day(end)) if has_range else F.lit(None).cast("date")
    inside = F.col("d").isNotNull() & (F.col("d").between(lo, hi) if has_range else F.lit(True))
    flagged = series.withColumn("inside", inside)
    step = Window.partitionBy("table_name", "inside").orderBy("d")
    gap = F.when(F.col("inside"), F.datediff("d", F.lag("d").over(step)) - 1)
    counted = flagged.withColumn("gap", gap)
    total = F.coalesce(F.sum(F.when(F.col("inside"), F.col("n"))), F.lit(0))
    out = counted.groupBy("table_name").agg(
        F.min("d").alias("actual_start"),
        F.max("d").alias("actual_end"),
        F.count(F.when(F.col("inside"), 1)).alias("unique_dates"),
        total.alias("total_rows"),
        F.count(F.when(F.col("gap") > 0, 1)).alias("gap_count"),
        F.coalesce(F.sum(F.when(F.col("gap") > 0, F.col("gap"))), F.lit(0)).alias("interior_missing"),
        F.coalesce(F.sum(F.when(F.col("d").isNull(), F.col("n"))), F.lit(0)).alias("unparseable_date_rows"),
    )
    first = lo if has_range else F.col("actual_start")
    last = hi if has_range else F.col("actual_end")
    return (
        out.withColumn("expected_dates", dates.expected_days(first, last))
        .withColumn("missing_dates", F.col("expected_dates") - F.col("unique_dates"))
        .withColumn(
            "avg_rows_per_day",
            F.when(F.col("unique_dates") > 0, F.col("total_rows") / F.col("unique_dates")).otherwise(F.lit(0.0)),
        )
    )


def severity(n: Column, avg: Column, q1: Column, q3: Column) -> Column:
    """Volume class of one day; the first rule that fits wins."""
    iqr = q3 - q1
    return (
        F.when(n < avg * SEVERELY_LOW_SHARE, "SEVERELY_LOW")
        .when(n < q1 - iqr * IQR_MULTIPLIER, "OUTLIER_LOW")
        .when(n < avg * LOW_SHARE, "LOW")
        .when(n > q3 + iqr * IQR_MULTIPLIER, "OUTLIER_HIGH")
        .otherwise("NORMAL")
    )


def severity_rank(name: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), name)


def series_statistics(series: DataFrame, start=None, end=None) -> DataFrame:
    """Mean, sample deviation and exact quartiles of the daily row counts."""
    quartiles = F.percentile("n", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        days(series, start, end)
        .groupBy("table_name")
        .agg(F.avg("n").alias("avg_count"), F.stddev("n").alias("std_dev"), quartiles.alias("q"))
        .select(
            "table_name",
            "avg_count",
            "std_dev",
            F.col("q")[0].alias("q1"),
            F.col("q")[1].alias("median"),
            F.col("q")[2].alias("q3"),
        )
    )


def classify_days(series: DataFrame, start=None, end=None) -> DataFrame:
    """Every day with its severity, share of the average and expected count.

    The statistics are window aggregates over the table's days, so days and
    statistics come from one pass and nothing is joined.
    """
    table = Window.partitionBy("table_name")
    quartiles = F.percentile("n", F.array(F.lit(0.25), F.lit(0.75))).over(table)
    return (
        days(series, start, end)
        .select("*", F.avg("n").over(table).alias("avg_count"), quartiles.alias("q"))
        .select(
            "table_name",
            "d",
            F.col("n").alias("row_count"),
            "avg_count",
            severity(F.col("n"), F.col("avg_count"), F.col("q")[0], F.col("q")[1]).alias("severity"),
            percent(F.col("n"), F.col("avg_count"), 1).alias("pct_of_avg"),
            F.floor("avg_count").alias("expected_count"),
        )
    )


def volume_anomalies(series: DataFrame, start=None, end=None, limit: int | None = None) -> DataFrame:
    """Days that are not normal; with a limit the worst ones per table and a flag ``truncated``."""
    odd = classify_days(series, start, end).filter(F.col("severity") != "NORMAL")
    if limit is None:
        return odd
    return first_of_each(odd, "table_name", [severity_rank(F.col("severity")), "d"], limit)


def severity_counts(classified: DataFrame) -> DataFrame:
    """Days per table and severity, and whether that severity fails the table."""
    return (
        classified.groupBy("table_name", "severity")
        .agg(F.count("*").alias("days"))
        .withColumn("fails_table", F.col("severity").isin("SEVERELY_LOW", "OUTLIER_LOW"))
    )


def _count_severity(*names: str) -> Column:
    return F.count(F.when(F.col("severity").isin(*names), 1))


def anomaly_grade(classified: DataFrame, policy: str = "kinds") -> DataFrame:
    """Grade per table: by the kinds of anomalies, or by their number (``legacy``)."""
    counts = classified.groupBy("table_name").agg(
        _count_severity("SEVERELY_LOW").alias("severely_low"),
        _count_severity("OUTLIER_LOW", "OUTLIER_HIGH").alias("outliers"),
        _count_severity(*SEVERITIES).alias("anomalies"),
    )
    if policy == "legacy":
        grade = (
            F.when(F.col("severely_low") > 10, "CRITICAL")
            .when(F.col("severely_low") > 5, "HIGH")
            .when(F.col("anomalies") > 10, "MEDIUM")
            .otherwise("LOW")
        )
    else:
        grade = (
            F.when(F.col("severely_low") > 0, "CRITICAL").when(F.col("outliers") > 0, "HIGH").otherwise("MEDIUM")
        )
    return counts.select(
        "table_name", "anomalies", F.when(F.col("anomalies") > 0, grade).alias("anomaly_severity")
    )


def invalid_dates(df: DataFrame, column: str, keep: list[str], limit: int | None = None) -> DataFrame:
    """Cells that none of the file date spellings fits; with a limit the first ones in row order.

    A null cell is a row too short to have one and is not listed.
    """
    value = F.trim(F.col(column))
    bad = df.filter(F.col(column).isNotNull() & dates.parse_file_date(value).isNull()).select(
        *keep, value.alias("value")
    )
    return bad if limit is None else bad.orderBy(*keep).limit(limit)


def partial_load_probe(df: DataFrame, date_column: str, month: str) -> DataFrame:
    """Rows and first/last day found for one month after a failed load."""
    day = dates.as_date(df, date_column)
    return df.filter(dates.in_month_spelling(df, date_column, month)).agg(
        F.count("*").alias("row_count"), F.min(day).alias("min_date"), F.max(day).alias("max_date")
    )
