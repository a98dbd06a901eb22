"""Table validation: completeness, anomalies and duplicates as one row per table."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadlens.functions import dates
from loadlens.functions.text import percent
from loadlens.operators import duplicates
from loadlens.operators.series import (
    SEVERITIES,
    Target,
    daily_series_of,
    severity,
    severity_rank,
)
from loadlens.session import literal_frame

_TARGET_SCHEMA = (
    "table_name string, date_column string, requested_start date, requested_end date, "
    "has_keys boolean, present boolean, column_count bigint"
)

_DUPLICATE_SCHEMA = (
    "table_name string, duplicate_keys bigint, excess_rows bigint, max_duplicates bigint, "
    "avg_duplicates double, duplicate_severity string"
)
_COUNTS = (
    "row_count", "total_rows", "unique_dates", "gap_count", *[s.lower() for s in SEVERITIES],
    "unparseable_date_rows", "duplicate_keys", "excess_rows", "max_duplicates",
)


def target_frame(spark: SparkSession, targets: list[Target]) -> DataFrame:
    """What is known about the targets before any data is read."""
    rows = [
        (
            t.table_name,
            t.date_column,
            None if t.start is None else dates.to_day(t.start),
            None if t.end is None else dates.to_day(t.end),
            bool(t.key_columns),
            t.df is not None,
            0 if t.df is None else len(t.df.columns),
        )
        for t in targets
    ]
    return literal_frame(spark, rows, _TARGET_SCHEMA)


def _count(test: Column) -> Column:
    return F.count(F.when(test, 1))


def _cut(entries: Column, limit: int | None) -> Column:
    return entries if limit is None else F.slice(entries, 1, limit)


def _listed(entry: Column, limit: int | None) -> Column:
    """Struct list of a table, ordered and cut for display. At most one entry per day."""
    return _cut(F.array_sort(F.collect_list(entry)), limit)


def series_audit(series: DataFrame, listed: int | None = None) -> DataFrame:
    """Completeness and anomalies per table from its daily series with requested range.

    The table is scanned once, into the series. Gaps, averages and quartiles
    are windows over its days and everything else is one aggregation of them.
    """
    d, n = F.col("d"), F.col("n")
    ranged = F.col("requested_start").isNotNull() & F.col("requested_end").isNotNull()
    in_range = F.when(ranged, d.between(F.col("requested_start"), F.col("requested_end"))).otherwise(F.lit(True))
    side = Window.partitionBy("table_name", "inside")
    quartiles = F.percentile("n", F.array(F.lit(0.25), F.lit(0.75)))
    inside, gap, kind = F.col("inside"), F.col("gap"), F.col("severity")
    marked = (
        series.select("*", (d.isNotNull() & in_range).alias("inside"))
        .select(
            "*",
            F.lag("d").over(side.orderBy("d")).alias("prev"),
            F.avg("n").over(side).alias("avg_count"),
            quartiles.over(side).alias("q"),
        )
        .select(
            "*",
            F.when(inside, severity(n, F.col("avg_count"), F.col("q")[0], F.col("q")[1])).alias("severity"),
            F.when(inside, F.greatest(F.datediff("d", "prev") - 1, F.lit(0))).alias("gap"),
        )
    )
    gap_entry = F.struct(F.col("prev").alias("start_date"), d.alias("end_date"), gap.alias("missing_days"))
    anomaly_entry = F.struct(
        severity_rank(kind).alias("rank"),
        d.alias("date"),
        n.alias("row_count"),
        F.floor("avg_count").alias("expected_count"),
        kind.alias("severity"),
        percent(n, F.col("avg_count"), 1).alias("percent_of_average"),
    )
    between = F.sequence(F.date_add("prev", 1), F.date_sub("d", 1))
    return marked.groupBy("table_name").agg(
        F.sum("n").alias("row_count"),
        F.min("d").alias("actual_start"),
        F.max("d").alias("actual_end"),
        F.min(F.when(inside, d)).alias("first_inside"),
        F.max(F.when(inside, d)).alias("last_inside"),
        F.sum(F.when(inside, n)).alias("total_rows"),
        _count(inside).alias("unique_dates"),
        _count(gap > 0).alias("gap_count"),
        F.sum(F.when(d.isNull(), n)).alias("unparseable_date_rows"),
        *[_count(kind == s).alias(s.lower()) for s in SEVERITIES],
        _listed(F.when(gap > 0, gap_entry), listed).alias("gaps"),
        _listed(F.when(kind.isin(*SEVERITIES), anomaly_entry), listed).alias("anomalous_dates"),
        F.flatten(F.array_sort(F.collect_list(F.when(gap > 0, between)))).alias("inner_missing"),
    )


def _missing_list(first: Column, last: Column, listed: int | None) -> Column:
    """First missing days: before the first present day, inside gaps, after the last."""
    nothing = F.array().cast("array<date>")
    stretch = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(nothing)
    lead = stretch(first, F.date_sub("first_inside", 1))
    tail = stretch(F.date_add("last_inside", 1), last)
    some = F.concat(lead, F.col("inner_missing"), tail)
    return _cut(F.coalesce(F.when(F.col("unique_dates") > 0, some).otherwise(stretch(first, last)), nothing), listed)


def _reason(count: Column, text: str) -> Column:
    return F.when(count > 0, F.concat(count.cast("string"), F.lit(text)))


def duplicate_audit(targets: list[Target], policy: str = "count") -> DataFrame | None:
    """Duplicate statistics of the targets that declare keys."""
    keyed = [t for t in targets if t.df is not None and t.key_columns]
    if not keyed:
        return None
    return duplicates.check_tables(keyed, policy).select(
        "table_name",
        "duplicate_keys",
        "excess_rows",
        "max_duplicates",
        "avg_duplicates",
        F.col("severity").alias("duplicate_severity"),
    )


def validate_tables(
    spark: SparkSession,
    targets: list[Target],
    policy: str = "count",
    push_range: bool = False,
    listed: int | None = None,
) -> DataFrame:
    """One validation row per target with a date column.

    Two scans per table: its daily series, and its keys. ``push_range`` reads
    only the requested days, at the price of the whole-table extent. Counts
    are exact and lists whole; ``listed`` cuts the lists for display and adds ``truncated``.
    """
    return audit_tables(spark, [t for t in targets if t.date_column], policy, push_range, listed)


def audit_tables(
    spark: SparkSession,
    targets: list[Target],
    policy: str = "count",
    push_range: bool = False,
    listed: int | None = None,
) -> DataFrame:
    """Validation rows of all targets that exist; those without a date column have only a row count."""
    found = [t for t in targets if t.df is not None]
    if not found:
        raise ValueError("none of the tables exists")
    series = daily_series_of(found, push_range, with_range=True, undated=True)
    frame = target_frame(spark, found).select("table_name", "requested_start", "requested_end")
    audit = series_audit(series, listed)
    repeated = duplicate_audit([t for t in found if t.date_column], policy)
    if repeated is None:
        repeated = literal_frame(spark, [], _DUPLICATE_SCHEMA)
    # Tables without any row have no series; their counts are zero and their range is all missing.
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    first, last = F.coalesce("requested_start", "actual_start"), F.coalesce("requested_end", "actual_end")
    total, days = F.col("total_rows"), F.col("unique_dates")
    counted = (
        frame.join(audit, "table_name", "left")
        .join(repeated, "table_name", "left")
        .select(
            "table_name", "requested_start", "requested_end", "actual_start", "actual_end",
            "first_inside", "last_inside", "inner_missing", "avg_duplicates",
            *[number(c) for c in _COUNTS],
            dates.expected_days(first, last).alias("expected_dates"),
            F.coalesce("gaps", F.array()).alias("gaps"),
            F.coalesce("anomalous_dates", F.array()).alias("anomalous_dates"),
            F.coalesce("duplicate_severity", F.lit("NONE")).alias("duplicate_severity"),
        )
    )
    missing = F.col("expected_dates") - days
    reasons = F.array_compact(
        F.array(
            _reason(missing, " missing dates"),
            _reason(F.col("gap_count"), " gaps between dates"),
            _reason(F.col("severely_low"), " dates under a tenth of the average rows"),
            _reason(F.col("outlier_low"), " dates with outlying few rows"),
            F.when(total > 0, _reason(F.col("duplicate_keys"), " duplicated keys")),
        )
    )
    hidden = ("first_inside", "last_inside", "inner_missing")
    anomalies = sum((F.col(s.lower()) for s in SEVERITIES[1:]), F.col(SEVERITIES[0].lower()))
    cut = [] if listed is None else [(F.greatest(missing, F.col("gap_count"), anomalies) > listed).alias("truncated")]
    return counted.select(
        *[c for c in counted.columns if c not in hidden],
        missing.alias("missing_dates"),
        anomalies.alias("anomaly_count"),
        F.when(days > 0, total / days).otherwise(F.lit(0.0)).alias("avg_rows_per_day"),
        _missing_list(first, last, listed).alias("missing_date_list"),
        reasons.alias("failure_reasons"),
        (F.size(reasons) == 0).alias("valid"),
        *cut,
    )


def validate_month(spark: SparkSession, targets: list[Target], month: str, **options) -> DataFrame:
    """Validation of every target for one month."""
    first, last = dates.month_range(month)
    dated = [replace(t, start=first, end=last) for t in targets]
    return validate_tables(spark, dated, **options)


def quick_validate(
    spark: SparkSession, df: DataFrame, date_column: str, start=None, end=None, table_name: str = "table"
) -> DataFrame:
    """Validation of one table without key checks."""
    return validate_tables(spark, [Target(table_name, df, date_column, [], start, end)])


def validation_rollup(results: DataFrame) -> DataFrame:
    """Totals over all validated tables."""
    return results.agg(
        F.count("*").alias("tables"),
        F.count(F.when(~F.col("valid"), 1)).alias("tables_with_issues"),
        F.sum("total_rows").alias("total_rows"),
        F.sum("missing_dates").alias("total_missing_dates"),
        F.sum("gap_count").alias("total_gaps"),
        F.sum("anomaly_count").alias("total_anomalies"),
        F.sum("duplicate_keys").alias("total_duplicate_keys"),
    )


def tables_with_issues(results: DataFrame) -> DataFrame:
    """Failure reasons, one row each, of the tables that failed."""
    return results.filter(~F.col("valid")).select("table_name", F.explode("failure_reasons").alias("reason"))
