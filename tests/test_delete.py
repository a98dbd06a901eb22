import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from loadlens.plans import delete as op


@pytest.fixture
def made(spark):
    """A catalog table of 90 days from 2024-01-01, two rows with no date."""
    names = []

    def make(partitioned=False):
        name = f"t_{uuid.uuid4().hex[:8]}"
        day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
        df = spark.range(92).select("id", F.when(F.col("id") < 90, day).alias("d"))
        if partitioned:
            df = df.withColumn("period", F.date_format("d", "yyyy-MM"))
        op.external_table(spark, df, name, "period" if partitioned else None)
        names.append(name)
        return name

    yield make
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


@pytest.mark.parametrize("partitioned", [False, True])
def test_month_goes_and_comes_back(spark, made, partitioned):
    name = made(partitioned)
    target = op.Deletion.of_month(name, "d", "2024-02")
    done = op.delete_period(spark, target, dry_run=False, month_partition="period" if partitioned else None)
    assert done[3] == "success" and done[5] == 29 and done[4] == 92
    left = spark.table(name)
    assert left.count() == 63 and left.filter("d is null").count() == 2
    assert left.filter("month(d) = 2").count() == 0
    op.restore(spark, name, done[7])
    assert spark.table(name).count() == 92


def test_part_of_a_month_in_a_partitioned_table(spark, made):
    name = made(True)
    import datetime as dt

    target = op.Deletion(name, "d", dt.date(2024, 1, 20), dt.date(2024, 2, 29))
    done = op.delete_period(spark, target, dry_run=False, month_partition="period")
    assert done[3] == "success" and done[5] == 41
    assert spark.table(name).count() == 51
    assert "2024-02" not in [r[0] for r in spark.table(name).select("period").distinct().collect()]
    again = op.delete_period(
        spark, op.Deletion(name, "d", dt.date(2024, 1, 10), dt.date(2024, 1, 31)), dry_run=False, month_partition="period"
    )
    assert again[3] == "success" and again[5] == 10 and spark.table(name).count() == 41
    op.restore(spark, name, again[7])
    assert spark.table(name).count() == 51
    op.restore(spark, name, done[7])
    assert spark.table(name).count() == 92 and spark.table(name).filter("d is null").count() == 2


def test_untouched_months_keep_their_files(spark, made):
    name = made(True)
    import datetime as dt

    files = lambda m: sorted(spark.table(name).filter(F.col("period") == m).select("_metadata.file_path").distinct().collect())
    march = files("2024-03")
    op.delete_period(
        spark, op.Deletion(name, "d", dt.date(2024, 1, 20), dt.date(2024, 2, 10)), dry_run=False, month_partition="period"
    )
    assert files("2024-03") == march and spark.table(name).count() == 70
    assert spark.table(name).filter("period = '2024-02'").count() == 19


def test_rows_outside_their_month_stop_the_delete(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    df = spark.sql("select date'2024-01-05' as d, '2024-01' as period union all select date'2024-01-06', '2024-02'")
    op.external_table(spark, df, name, "period")
    got = op.delete_period(spark, op.Deletion.of_month(name, "d", "2024-01"), dry_run=False, month_partition="period")
    assert got[3] == "failed" and spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")


def test_dry_run_changes_nothing(spark, made):
    name = made()
    got = op.delete_periods(
        spark,
        [op.Deletion.of_month(name, "d", m) for m in ("2024-01", "1999-01")]
        + [op.Deletion.of_month(name, "nope", "2024-01"), op.Deletion.of_month("gone", "d", "2024-01")],
    )
    assert rows(got, "status", "rows_affected") == [("dry_run", 31), ("failed", 0), ("failed", 0), ("skipped", 0)]
    assert spark.table(name).count() == 92


def test_kept_and_deleted_make_the_total(spark, made):
    df = spark.table(made())
    target = op.Deletion.of_month("t", "d", "2024-03")
    impact = op.delete_impact(df, target).collect()[0]
    assert op.keep_rows(df, [target]).count() + impact["rows_to_delete"] == impact["total_rows"] == 92


def test_raw_compare_misses_iso_text(spark):
    df = spark.createDataFrame([("20240105",), ("2024-01-05",)], "d string")
    target = op.Deletion.of_month("t", "d", "2024-01")
    assert df.filter(op.in_period(df, target)).count() == 2
    assert df.filter(op.in_period(df, target, raw=True)).count() == 1


def test_deletions_over_contracts():
    from loadlens.contracts import Contract

    contracts = [Contract("a_{month}.tsv", "SALES", date_column="d"), Contract("b.tsv", "NO_DATE"), Contract("c.tsv", "STOCK", date_column="d")]
    got = [(t.table_name, t.start.month, t.end.day) for t in op.deletions_of(contracts, ["2024-01", "2024-02"])]
    assert got == [("SALES", 1, 31), ("SALES", 2, 29), ("STOCK", 1, 31), ("STOCK", 2, 29)]
    assert {t.table_name for t in op.deletions_of(contracts, ["2024-01"], "sal*")} == {"SALES"}


@pytest.mark.parametrize("partitioned", [False, True])
def test_everything_with_a_date_can_go(spark, made, partitioned):
    import datetime as dt

    name = made(partitioned)
    target = op.Deletion(name, "d", dt.date(2023, 12, 15), dt.date(2024, 12, 15))
    done = op.delete_period(spark, target, dry_run=False, month_partition="period" if partitioned else None)
    assert done[3] == "success" and done[5] == 90
    assert spark.table(name).count() == 2
    op.restore(spark, name, done[7])
    assert spark.table(name).count() == 92


def test_many_periods_go_in_one_rewrite(spark, made, monkeypatch):
    import datetime as dt

    name, written = made(), []
    plain = op._rewrite
    monkeypatch.setattr(op, "_rewrite", lambda *a: written.append(a[2]) or plain(*a))
    # The second period overlaps the first, whose rows it no longer finds.
    targets = [op.Deletion.of_month(name, "d", "2024-01"), op.Deletion(name, "d", dt.date(2024, 1, 20), dt.date(2024, 2, 10)),
               op.Deletion.of_month(name, "d", "1999-01"), op.Deletion.of_month("gone", "d", "2024-01"), op.Deletion.of_month(name, "nope", "2024-01")]
    got = op.delete_periods(spark, targets, dry_run=False).collect()
    assert [(r["status"], r["total_rows_before"], r["rows_affected"]) for r in got] == [
        ("success", 92, 31), ("success", 61, 10), ("skipped", 51, 0), ("failed", 0, 0), ("failed", 0, 0)
    ]
    assert len(written) == 1 and spark.table(name).count() == 51
    op.restore(spark, name, got[1]["recovery"])
    assert spark.table(name).count() == 92
