"""Period delete: impact, preview, keep-set rewrite, recovery.

Tables are external Spark catalog tables. A delete never edits files in place.
In a table partitioned by month, partitions of whole months are dropped and
months that go in part are rewritten to a new folder; in any other table the
rows that stay are written to a new folder and the table is pointed at it. The
files of before stay where they are and are the recovery point.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loadlens.contracts import Contract
from loadlens.functions import dates
from loadlens.operators.series import union_all
from loadlens.session import scratch

RESULT_SCHEMA = (
    "table_name string, period_start date, period_end date, status string, total_rows_before bigint, "
    "rows_affected bigint, deletion_pct double, recovery string, error_message string"
)


@dataclass
class Deletion:
    """One period of one catalog table."""

    table_name: str
    date_column: str
    start: dt.date
    end: dt.date
    by_spelling: str | None = None

    @staticmethod
    def of_month(table_name: str, date_column: str, month: str, by_spelling: bool = False) -> "Deletion":
        first, last = dates.month_range(month)
        return Deletion(table_name, date_column, first, last, month if by_spelling else None)


def deletions_of(contracts: list[Contract], months: list[str], table_filter: str | None = None) -> list[Deletion]:
    """Every month of every contracted table with a date column; tables filtered by a shell-style name."""
    return [
        Deletion.of_month(c.table_name, c.date_column, month)
        for c in contracts
        if c.date_column and (not table_filter or fnmatch.fnmatch(c.table_name.lower(), table_filter.lower()))
        for month in months
    ]


def in_period(df: DataFrame, target: Deletion, raw: bool = False) -> Column:
    """Rows of the period; rows without a usable date are never in it."""
    if target.by_spelling:
        test = dates.in_month_spelling(df, target.date_column, target.by_spelling)
    elif raw:
        test = dates.raw_between(target.date_column, f"{target.start:%Y%m%d}", f"{target.end:%Y%m%d}")
    else:
        test = dates.date_between(df, target.date_column, target.start, target.end)
    return F.coalesce(test, F.lit(False))


def delete_impact(df: DataFrame, target: Deletion) -> DataFrame:
    """Total rows, rows in the period and their share, in one pass."""
    hit = in_period(df, target)
    return df.agg(F.count("*").alias("total_rows"), F.count(F.when(hit, 1)).alias("rows_to_delete")).select(
        F.lit(target.table_name).alias("table_name"),
        "total_rows",
        "rows_to_delete",
        F.when(F.col("total_rows") > 0, F.col("rows_to_delete") / F.col("total_rows") * 100)
        .otherwise(F.lit(0.0))
        .alias("deletion_pct"),
    )


def impact_of(frames: dict[str, DataFrame], targets: list[Deletion]) -> DataFrame:
    """Impact of several periods over several tables; one pass per table."""
    out = []
    for name, df in frames.items():
        mine = [t for t in targets if t.table_name == name]
        if not mine:
            continue
        hits = [F.count(F.when(in_period(df, t), 1)).alias(f"hit{i}") for i, t in enumerate(mine)]
        rows = F.array(
            *[
                F.struct(
                    F.lit(t.start).alias("period_start"),
                    F.lit(t.end).alias("period_end"),
                    F.col(f"hit{i}").alias("rows_to_delete"),
                )
                for i, t in enumerate(mine)
            ]
        )
        out.append(
            df.agg(F.count("*").alias("total_rows"), *hits).select(
                F.lit(name).alias("table_name"), "total_rows", F.inline(rows)
            )
        )
    return union_all(out)


def delete_preview(df: DataFrame, target: Deletion, rows: int = 10, order: list[str] | None = None) -> DataFrame:
    """A few rows of the period; the first ones if an order is given."""
    found = df.filter(in_period(df, target))
    return (found.orderBy(*order) if order else found).limit(rows)


def keep_rows(df: DataFrame, targets: list[Deletion]) -> DataFrame:
    """What stays after deleting all given periods."""
    gone = F.lit(False)
    for t in targets:
        gone = gone | in_period(df, t)
    return df.filter(~gone)


def _record(target: Deletion, status: str, total: int, rows: int, recovery=None, error=None) -> tuple:
    share = rows / total * 100 if total else 0.0
    return (target.table_name, target.start, target.end, status, total, rows, share, recovery, error)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _months_touched(target: Deletion) -> list[str]:
    months, cursor = [], target.start.replace(day=1)
    while cursor <= target.end:
        months.append(f"{cursor:%Y-%m}")
        cursor = (cursor + dt.timedelta(days=32)).replace(day=1)
    return months


def _partition_location(spark: SparkSession, table: str, column: str, month: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({column}='{month}')")
    return rows.filter("col_name = 'Location'").collect()[0]["data_type"]


def _months_before(spark: SparkSession, target: Deletion, column: str) -> str:
    """Where the partitions of the period's months are, as JSON."""
    table = target.table_name
    listed = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    touched = [m for m in _months_touched(target) if m in listed]
    before = {m: _partition_location(spark, table, column, m) for m in touched}
    return json.dumps({"partition": column, "locations": before})


def _delete_from_months(spark: SparkSession, df: DataFrame, target: Deletion, column: str, touched: list[str]) -> None:
    """Delete from some months of a table partitioned by month.

    Partitions of whole months are dropped unread. Of a month that goes only in
    part, the rows that stay are written to a new folder and its partition is
    pointed there. Other months are not touched.
    """
    table = target.table_name
    first_last = {m: dates.month_range(m) for m in touched}
    parts = [m for m in touched if first_last[m][0] < target.start or first_last[m][1] > target.end]
    kept = {}
    if parts:
        folder, seen = scratch(spark, table.replace(".", "_")), Observation()
        counts = [F.count_if(F.col(column).cast("string") == m).alias(f"n{i}") for i, m in enumerate(parts)]
        rows = df.filter(F.col(column).cast("string").isin(*parts))
        keep_rows(rows, [target]).observe(seen, *counts).write.partitionBy(column).parquet(folder)
        kept = {m: f"{folder}/{column}={m}" for i, m in enumerate(parts) if seen.get[f"n{i}"]}
    for month in touched:
        spec = f"PARTITION ({column}='{month}')"
        if month in kept:
            spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{kept[month]}'")
        else:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec}")
    spark.catalog.refreshTable(table)


def _rewrite(spark: SparkSession, df: DataFrame, targets: list[Deletion], partitions: list[str]) -> tuple[str, int]:
    """Write the rows that stay to a new folder; return it with their number."""
    folder = scratch(spark, targets[0].table_name.replace(".", "_"))
    seen = Observation()
    kept = keep_rows(df, targets).observe(seen, F.count(F.lit(1)).alias("kept"))
    writer = kept.write
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(folder)
    return folder, seen.get["kept"]


def point_table_at(spark: SparkSession, table: str, folder: str) -> None:
    """Swap the folder a table reads; partitions are listed again."""
    partitions = _partition_columns(spark, table)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    if partitions:
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
            spec = ", ".join(f"{k}='{v}'" for k, v in (p.split("=", 1) for p in row[0].split("/")))
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)


def delete_period(
    spark: SparkSession, target: Deletion, dry_run: bool = True, month_partition: str | None = None
) -> tuple:
    """Delete one period of one table and describe what happened.

    ``month_partition`` names a ``YYYY-MM`` partition column derived from the
    date column; only the partitions of the period's months are then changed.
    """
    if not spark.catalog.tableExists(target.table_name):
        return _record(target, "failed", 0, 0, error=f"table {target.table_name} not found")
    df = spark.table(target.table_name)
    if target.date_column.lower() not in [c.lower() for c in df.columns]:
        return _record(target, "failed", 0, 0, error=f"column {target.date_column} not found")
    impact = delete_impact(df, target).collect()[0]
    total, hits = impact["total_rows"], impact["rows_to_delete"]
    if hits == 0:
        return _record(target, "skipped", total, 0, error="no matching rows")
    if dry_run:
        return _record(target, "dry_run", total, hits)
    if month_partition and not target.by_spelling:
        recovery = _months_before(spark, target, month_partition)
        try:
            _delete_from_months(spark, df, target, month_partition, list(json.loads(recovery)["locations"]))
            if total - spark.table(target.table_name).count() != hits:
                raise ValueError("rows outside their month's partition")
        except Exception as error:  # noqa: BLE001 - undone and recorded
            return _undone(spark, target, total, recovery, error)
        return _record(target, "success", total, hits, recovery)
    before = _location(spark, target.table_name)
    folder, kept = _rewrite(spark, df, [target], _partition_columns(spark, target.table_name))
    if total - kept != hits:
        return _record(target, "failed", total, 0, before, "table changed during the delete")
    try:
        point_table_at(spark, target.table_name, folder)
    except Exception as error:  # noqa: BLE001 - undone and recorded
        return _undone(spark, target, total, before, error)
    return _record(target, "success", total, hits, before)


def _undone(spark: SparkSession, target: Deletion, total: int, recovery: str, error: Exception) -> tuple:
    """Put a table back after a failed delete. The record always has the recovery text, should that fail too."""
    text = str(error).splitlines()[0] if str(error) else type(error).__name__
    try:
        restore(spark, target.table_name, recovery)
    except Exception as second:  # noqa: BLE001 - recorded
        text += f"; not restored: {str(second).splitlines()[0]}"
    return _record(target, "failed", total, 0, recovery, text)


def restore(spark: SparkSession, table: str, recovery: str) -> None:
    """Undo a delete: point the table, or its changed partitions, back at the files of before."""
    if not recovery.startswith("{"):
        point_table_at(spark, table, recovery)
        return
    saved = json.loads(recovery)
    for month, location in saved["locations"].items():
        spec = f"PARTITION ({saved['partition']}='{month}')"
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec}")
        spark.sql(f"ALTER TABLE {table} ADD {spec} LOCATION '{location}'")
    spark.catalog.refreshTable(table)


def delete_periods(
    spark: SparkSession, targets: list[Deletion], dry_run: bool = True, month_partition: str | None = None
) -> DataFrame:
    """Delete several periods; a table that fails does not stop the others.

    All periods of a table are counted in one scan and go in one rewrite. A row
    of several periods counts for the first of them, as if they went one after
    another; a dry run counts each on its own. In a table partitioned by month
    nothing is rewritten for whole months, so its periods go one by one.
    """
    rows: dict[int, tuple] = {}
    tables: dict[str, list[int]] = {}
    for k, target in enumerate(targets):
        tables.setdefault(target.table_name, []).append(k)
    for places in tables.values():
        some = [targets[k] for k in places]
        together = len(some) > 1 and not month_partition
        for group in [places] if together else [[k] for k in places]:
            own = [targets[k] for k in group]
            try:
                done = _delete_together(spark, own, dry_run) if together else [delete_period(spark, own[0], dry_run, month_partition)]
            except Exception as error:  # noqa: BLE001 - recorded per target
                done = [_record(t, "failed", 0, 0, error=str(error).splitlines()[0]) for t in own]
            rows.update(zip(group, done, strict=True))
    return spark.createDataFrame([rows[k] for k in range(len(targets))], RESULT_SCHEMA)


def _delete_together(spark: SparkSession, targets: list[Deletion], dry_run: bool) -> list[tuple]:
    """Delete several periods of one table with one scan and one rewrite; each record recovers the table as it was before all."""
    table = targets[0].table_name
    if not spark.catalog.tableExists(table):
        return [_record(t, "failed", 0, 0, error=f"table {table} not found") for t in targets]
    df = spark.table(table)
    known = [c.lower() for c in df.columns]
    good = [t for t in targets if t.date_column.lower() in known]
    counts, earlier = [], F.lit(False)
    for k, t in enumerate(good):
        inside = in_period(df, t)
        counts.append(F.count_if(inside if dry_run else inside & ~earlier).alias(f"n{k}"))
        earlier = earlier | inside
    found = df.agg(F.count(F.lit(1)).alias("total"), *counts).first()
    hits = {id(t): found[f"n{k}"] for k, t in enumerate(good)}
    doomed = [t for t in good if hits[id(t)]]
    before, error = None, None
    if doomed and not dry_run:
        before = _location(spark, table)
        folder, kept = _rewrite(spark, df, doomed, _partition_columns(spark, table))
        if found["total"] - kept != sum(hits.values()):
            error = "table changed during the delete"
        else:
            try:
                point_table_at(spark, table, folder)
            except Exception as failure:  # noqa: BLE001 - undone and recorded
                return [_undone(spark, t, found["total"], before, failure) for t in targets]
    records, total = [], found["total"]
    for t in targets:
        if id(t) not in hits:
            records.append(_record(t, "failed", 0, 0, error=f"column {t.date_column} not found"))
        elif not hits[id(t)]:
            records.append(_record(t, "skipped", total, 0, error="no matching rows"))
        elif dry_run:
            records.append(_record(t, "dry_run", total, hits[id(t)]))
        elif error:
            records.append(_record(t, "failed", total, 0, before, error))
        else:
            records.append(_record(t, "success", total, hits[id(t)], before))
            total -= hits[id(t)]
    return records


def external_table(spark: SparkSession, df: DataFrame, name: str, partition_by: str | None = None) -> str:
    """Write a table to the shared folder and register it; returns its folder."""
    folder = scratch(spark, name)
    writer = df.write.format("parquet").option("path", folder).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(name)
    return folder
