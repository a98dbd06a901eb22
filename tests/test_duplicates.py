import pytest
from pyspark.sql import functions as F

from conftest import rows
from loadlens.operators import duplicates as op

STATS = "total_rows bigint, duplicate_keys bigint, excess_rows bigint, max_duplicates bigint"


@pytest.mark.parametrize(
    "keys,excess,total,severity",
    [
        (0, 0, 1000, "NONE"),
        (10, 20, 20000, "LOW"),
        (50, 100, 20000, "LOW"),
        (100, 200, 25000, "LOW"),
        (1000, 2000, 133334, "MEDIUM"),
        (500, 1000, 50000, "MEDIUM"),
        (5000, 10000, 166667, "HIGH"),
        (50000, 100000, 909091, "CRITICAL"),
    ],
)
def test_documented_severity(spark, keys, excess, total, severity):
    df = spark.createDataFrame([(total, keys, excess, 3)], STATS)
    assert df.select(op.severity("documented")).collect()[0][0] == severity


@pytest.mark.parametrize(
    "keys,largest,severity",
    [(0, 0, "NONE"), (1, 2, "LOW"), (11, 2, "MEDIUM"), (1, 11, "MEDIUM"), (101, 2, "HIGH"), (1, 51, "HIGH"),
     (1001, 2, "CRITICAL"), (1, 101, "CRITICAL")],
)
def test_count_severity(spark, keys, largest, severity):
    df = spark.createDataFrame([(10**6, keys, keys, largest)], STATS)
    assert df.select(op.severity("count")).collect()[0][0] == severity


def test_ratio_severity_uses_all_rows(spark):
    df = spark.createDataFrame([(1000, 1, 1, 2)], STATS)
    assert df.select(op.severity("ratio")).collect()[0][0] == "CRITICAL"


def test_one_duplicate_key(spark, write_file):
    data = [("20240301", "A001", "F001"), ("20240301", "A001", "F001"), ("20240302", "A001", "F001")]
    df = spark.createDataFrame(data, "recordDate string, assetId string, fundId string")
    got = op.check_duplicates(df, ["recordDate", "assetId", "fundId"], "recordDate").collect()[0]
    assert (got["duplicate_keys"], got["excess_rows"], got["max_duplicates"]) == (1, 1, 2)


def test_spellings_of_one_day_are_one_key(spark):
    df = spark.createDataFrame([("20240301", 1), ("Mar  1 2024", 1), ("2024-03-02", 1)], "d string, k int")
    assert op.check_duplicates(df, ["d", "k"], "d").collect()[0]["duplicate_keys"] == 1
    assert op.check_duplicates(df, ["d", "k"]).collect()[0]["duplicate_keys"] == 0


def test_excess_is_rows_minus_keys(spark):
    df = spark.range(1000).select((F.col("id") % 300).alias("k"), F.when(F.col("id") % 7 == 0, None).otherwise(1).alias("j"))
    groups = op.key_groups(df, ["k", "j"])
    got = op.duplicate_stats(groups, ["k", "j"]).collect()[0]
    assert got["excess_rows"] == 1000 - groups.count() and got["total_rows"] == 1000
    assert got["null_key_rows"] == df.filter("j is null").count()


def test_samples_are_stable(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("k"))
    groups = op.key_groups(df.union(spark.range(1).select(F.lit(7).cast("bigint"))), ["k"])
    got = [tuple(r) for r in op.duplicate_samples(groups, ["k"], 3).collect()]
    assert got == [(7, 11), (0, 10), (1, 10)]


def test_hot_key_is_counted_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    groups = op.key_groups(df, ["k"])
    assert rows(groups.filter("k = 0")) == [(0, 10000)]
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_digest_keys_equal_plain_keys(spark):
    df = spark.createDataFrame([("a" * 500,), ("a" * 500,), ("b",), (None,), (None,)], "t string")
    plain = op.duplicate_stats(op.key_groups(df, ["t"]), ["t"]).collect()
    assert op.duplicate_stats(op.key_groups(df, ["t"], digest=("t",)), ["t"]).collect() == plain


def test_table_without_rows_has_a_report(spark):
    df = spark.range(10).select(F.lit(1).alias("k"))
    got = op.check_tables([op.Target("full", df, None, ["k"]), op.Target("empty", df.filter("k > 1"), None, ["k"])])
    assert rows(got, "table_name", "total_rows", "excess_rows", "severity") == [("empty", 0, 0, "NONE"), ("full", 10, 9, "LOW")]
