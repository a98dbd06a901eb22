"""Summaries kept up to date from changed files."""

import shutil

import pytest
from conftest import rows
from pyspark.sql import functions as F

from loadlens.operators import duplicates
from loadlens.operators.series import Target, daily_series
from loadlens.plans import audit
from loadlens.plans.stored import StoredKeys, StoredSeries

KEYS = ["shop", "at"]


def month(spark, k, n, shift=0):
    """Rows of month k; shops repeat, some are null, some dates too."""
    i = F.col("id")
    day = F.date_add(F.make_date(F.lit(2024), F.lit(k), F.lit(1)), (i % 25).cast("int"))
    at = (F.unix_timestamp(day.cast("timestamp")) * 1_000_000 + i % 2).cast("bigint")
    return spark.range(n).select(
        F.when(i % 17 == 0, None).otherwise(i % 5 + shift).alias("shop"), F.timestamp_micros(at).alias("at"),
        F.when(i % 31 != 0, day).alias("day"), F.lit(f"2024-{k:02d}").alias("period"),
    )


@pytest.fixture
def store(spark, tmp_path):
    path = str(tmp_path / "sales")

    def table():
        return spark.read.option("basePath", path).parquet(path)

    def add(k, n, shift=0):
        month(spark, k, n, shift).repartition(3).write.mode("append").partitionBy("period").parquet(path)

    def take_away(k):
        shutil.move(f"{path}/period=2024-{k:02d}", f"{tmp_path}/kept-{k}")

    return path, table, add, take_away


def test_series_reads_new_files_only(spark, store, tmp_path):
    _, table, add, take_away = store
    kept = StoredSeries(spark, str(tmp_path / "series"), "day", "sales")
    with pytest.raises(ValueError, match="not been made"):
        kept.series()
    add(1, 300)
    add(2, 200)
    first = kept.refresh(table())
    assert (first.files_added, first.rows_read) == (6, 500)
    assert kept.refresh(table()).rows_read == 0
    add(3, 70)
    month(spark, 3, 0).coalesce(1).write.mode("append").parquet(f"{store[0]}/period=2024-03")
    again = kept.refresh(table())
    assert again.rows_read == 70 and again.version == 2
    assert kept.refresh(table()).version == 2
    take_away(1)
    assert (kept.refresh(table()).rows_read, kept.refresh(table()).files_removed) == (0, 0)
    assert rows(kept.series()) == rows(daily_series(table(), "day", "sales"))
    kept.drop_old()
    assert rows(kept.series()) == rows(daily_series(table(), "day", "sales"))


def test_only_new_files_are_opened(spark, store, tmp_path):
    from loadlens.plans.stored import _rows_of, files_of

    _, table, add, _ = store
    add(1, 300)
    old = {r["file"] for r in files_of(table()).collect()}
    add(2, 300)
    new = [r["file"] for r in files_of(table()).collect() if r["file"] not in old]
    df = _rows_of(table(), new).select("shop", "_file")
    assert len(df.collect()) == 300 and len(new) == 3
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 3


def statistics(groups):
    return rows(duplicates.duplicate_stats(groups, KEYS))


def test_keys_after_three_loads_and_a_delete(spark, store, tmp_path):
    _, table, add, take_away = store
    kept = StoredKeys(spark, str(tmp_path / "keys"), KEYS, buckets=4)
    full = lambda: duplicates.key_groups(table(), KEYS)
    for k, n in ((1, 300), (2, 200), (3, 150)):
        add(k, n)
        assert kept.refresh(table()).rows_read == n
        assert statistics(kept.groups()) == statistics(full())
    add(2, 40, shift=3)
    take_away(1)
    # The files taken away are gone from where they were, so all is counted anew.
    assert kept.refresh(table()).rows_read == 390
    assert rows(kept.groups()) == rows(full())


def test_deleted_files_that_still_lie_there_are_subtracted(spark, store, tmp_path):
    _, table, add, _ = store
    for k in (1, 2, 3):
        add(k, 100)
    kept = StoredKeys(spark, str(tmp_path / "keys"), KEYS, buckets=4)
    kept.refresh(table())
    # A delete of whole months drops their partitions and leaves the files as recovery point.
    left = spark.read.option("basePath", store[0]).parquet(*[f"{store[0]}/period=2024-0{k}" for k in (1, 3)])
    done = kept.refresh(left)
    assert (done.rows_read, done.files_removed, done.files_added) == (100, 3, 0)
    assert rows(kept.groups()) == rows(duplicates.key_groups(left, KEYS))
    kept.drop_old()
    assert StoredKeys(spark, str(tmp_path / "keys"), KEYS, buckets=4).groups().count() == kept.groups().count()


def test_stored_side_is_not_shuffled(spark, store, tmp_path):
    _, table, add, _ = store
    add(1, 300)
    kept = StoredKeys(spark, str(tmp_path / "keys"), KEYS, buckets=4)
    kept.refresh(table())
    add(2, 50)
    change = kept._counts(table().filter("period = '2024-02'"), table(), 1)
    plan = kept.merged(change)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    before_scan = plan[: plan.index("Bucketed: true")]
    # Between the join and the stored scan there is no exchange.
    assert "Exchange" not in before_scan[before_scan.index("SortMergeJoin") :]


def test_audits_from_summaries_are_those_of_the_table(spark, store, tmp_path):
    _, table, add, _ = store
    for k, n in ((1, 300), (2, 260), (3, 12)):
        add(k, n)
    days = StoredSeries(spark, str(tmp_path / "series"), "day", "sales")
    keys = StoredKeys(spark, str(tmp_path / "keys"), KEYS, buckets=4)
    days.refresh(table()), keys.refresh(table())
    plain = Target("sales", table(), "day", KEYS)
    known = Target("sales", table(), "day", KEYS, series=days.series(), sizes=keys.sizes())
    whole = audit.validate_tables(spark, [known])
    assert rows(whole) == rows(audit.validate_tables(spark, [plain]))
    assert "sales" not in "".join(f for f in whole.inputFiles())
    assert rows(audit.validate_month(spark, [known], "2024-03")) == rows(audit.validate_month(spark, [plain], "2024-03"))
