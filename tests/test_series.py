import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from loadlens.operators import series as op
from loadlens.operators.series import Target
from loadlens.plans import audit, report


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture
def counted(spark):
    """A series from {day: rows}."""

    def make(counts, name="t"):
        data = [(name, None if d is None else day(d), n) for d, n in counts.items()]
        return spark.createDataFrame(data, "table_name string, d date, n bigint")

    return make


def test_gaps_and_missing_days(counted):
    s = counted({"2024-01-01": 1, "2024-01-02": 1, "2024-01-05": 1, "2024-03-01": 2, None: 4})
    assert rows(op.date_gaps(s).drop("table_name")) == [
        (day("2024-01-02"), day("2024-01-05"), 2),
        (day("2024-01-05"), day("2024-03-01"), 55),
    ]
    assert rows(op.missing_from_gaps(s, longest=31).drop("table_name")) == [(day("2024-01-03"),), (day("2024-01-04"),)]
    assert op.missing_from_gaps(s).count() == 57
    assert op.missing_days(s).count() == 57
    edges = op.missing_days(s, "2023-12-30", "2024-01-06").select(F.dayofmonth("missing_date")).collect()
    assert sorted(r[0] for r in edges) == [3, 4, 6, 30, 31]


def test_present_and_missing_make_the_calendar(counted):
    s = counted({"2024-01-01": 1, "2024-01-04": 1, "2024-02-01": 1})
    spine = op.days(s).count() + op.missing_days(s).count()
    assert spine == (day("2024-02-01") - day("2024-01-01")).days + 1


def test_completeness_without_rows_in_range(counted):
    s = counted({"2024-01-01": 3, None: 2})
    got = op.completeness(s, "2024-05-01", "2024-05-31").collect()[0]
    assert (got["total_rows"], got["unique_dates"], got["expected_dates"], got["missing_dates"]) == (0, 0, 31, 31)
    assert got["actual_start"] == day("2024-01-01") and got["unparseable_date_rows"] == 2
    assert got["avg_rows_per_day"] == 0.0


def test_severity_order(counted):
    counts = {f"2024-01-{i:02d}": 100 for i in range(1, 29)}
    counts |= {"2024-02-01": 5, "2024-02-02": 40, "2024-02-03": 60, "2024-02-04": 300}
    got = dict(rows(op.classify_days(counted(counts)).filter("severity != 'NORMAL'").select(F.date_format("d", "dd"), "severity")))
    assert got == {"01": "SEVERELY_LOW", "02": "OUTLIER_LOW", "03": "OUTLIER_LOW", "04": "OUTLIER_HIGH"}
    grade = op.anomaly_grade(op.classify_days(counted(counts))).collect()[0]
    assert (grade["anomalies"], grade["anomaly_severity"]) == (4, "CRITICAL")
    legacy = op.anomaly_grade(op.classify_days(counted(counts)), "legacy").collect()[0]
    assert legacy["anomaly_severity"] == "LOW"
    first = op.volume_anomalies(counted(counts), limit=1).collect()
    assert [r["severity"] for r in first] == ["SEVERELY_LOW"]


def test_low_needs_a_wide_spread(counted):
    counts = {f"2024-01-{i:02d}": 100 + 40 * (i % 5) for i in range(1, 26)} | {"2024-02-01": 60}
    got = rows(op.classify_days(counted(counts)).filter("severity != 'NORMAL'").select("severity"))
    assert got == [("LOW",)]


def test_series_sum_is_the_rows_with_a_date(spark):
    df = spark.createDataFrame([("2024-01-01",), ("20240101",), ("oops",), (None,)], "c string")
    s = op.daily_series(df, "c", "t")
    assert rows(s.select("d", "n")) == [(None, 2), (day("2024-01-01"), 2)]
    assert op.unparseable_rows(s).collect()[0]["unparseable_date_rows"] == 2


def orders(spark, days, keys=1):
    data = [(day(d), k) for d in days for k in range(keys)]
    return spark.createDataFrame(data, "d date, k bigint")


def test_validation_reads_each_table_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    orders(spark, ["2024-01-01", "2024-01-03"], 3).write.parquet(path)
    t = Target("t", spark.read.parquet(path), "d", ["d", "k"])
    plan = audit.validate_tables(spark, [t])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2


def test_validation_of_a_range(spark):
    df = orders(spark, ["2024-01-02", "2024-01-03", "2024-01-06", "2024-02-01"], 2)
    t = Target("t", df, "d", ["d", "k"], "2024-01-01", "2024-01-07")
    got = audit.validate_tables(spark, [t]).collect()[0]
    assert (got["total_rows"], got["unique_dates"], got["expected_dates"]) == (6, 3, 7)
    assert (got["missing_dates"], got["gap_count"], got["duplicate_keys"]) == (4, 1, 0)
    assert [d.day for d in got["missing_date_list"]] == [1, 4, 5, 7]
    assert got["actual_end"] == day("2024-02-01")
    assert got["failure_reasons"] == ["4 missing dates", "1 gaps between dates"] and not got["valid"]


def test_validation_of_an_empty_range_and_table(spark):
    df = orders(spark, ["2024-01-02"])
    empty = df.filter("k > 5")
    targets = [Target("a", df, "d", ["k"], "2025-01-01", "2025-01-03"), Target("b", empty, "d", ["k"])]
    got = {r["table_name"]: r for r in audit.validate_tables(spark, targets).collect()}
    assert (got["a"]["total_rows"], got["a"]["expected_dates"], got["a"]["missing_dates"]) == (0, 3, 3)
    assert len(got["a"]["missing_date_list"]) == 3
    assert got["b"]["total_rows"] == 0 and got["b"]["valid"]


def test_clean_table_passes(spark):
    df = orders(spark, [f"2024-01-{i:02d}" for i in range(1, 32)], 3)
    got = report.table_report(spark, [Target("t", df, "d", ["d", "k"])]).collect()[0]
    assert got["validation_status"] == "PASSED" and got["validation_issues"] == []
    assert got["duplicate_severity"] == "NONE" and got["row_count"] == 93


def test_mild_anomalies_alone_stay_passed(spark):
    days = [f"2024-01-{i:02d}" for i in range(1, 31)]
    df = orders(spark, days, 2).unionByName(orders(spark, ["2024-01-31"], 9))
    got = report.table_report(spark, [Target("t", df, "d")]).collect()[0]
    assert got["validation_status"] == "PASSED" and got["anomaly_severity"] == "HIGH"
    assert got["validation_issues"] == ["1 anomalous dates (HIGH)"]


def test_one_broken_table_does_not_stop_the_report(spark):
    good = orders(spark, ["2024-01-01", "2024-01-02"])
    broken = good.withColumn("d", F.raise_error(F.lit("disk gone")).cast("date"))
    got = report.isolated_report(spark, [Target("g", good, "d"), Target("x", broken, "d"), Target("m", None, "d")])
    assert rows(got, "table_name", "status") == [("g", "SUCCESS"), ("m", "TABLE_NOT_FOUND"), ("x", "ERROR")]
    assert "disk gone" in got.filter("status = 'ERROR'").collect()[0]["error_message"]


def test_empty_table_with_a_range_misses_all_of_it(spark):
    empty = orders(spark, ["2024-01-02"]).filter("k > 5")
    got = audit.validate_tables(spark, [Target("b", empty, "d", ["k"], "2024-01-01", "2024-01-03")]).collect()[0]
    assert (got["expected_dates"], got["missing_dates"], len(got["missing_date_list"])) == (3, 3, 3)
    assert not got["valid"]
