"""Sketches added up against the exact profile."""

from conftest import rows
from pyspark.sql import functions as F

from loadlens.operators import sketches
from loadlens.plans.stored import StoredSketches


def test_united_sketches_are_near_the_exact_profile(spark):
    i = F.col("id")
    df = spark.range(60_000).select(
        (i % 7).alias("part"), (i * 7919 % 45_000).alias("many"), (i % 3).cast("string").alias("few"),
        F.when(i % 5 != 0, F.sqrt(i.cast("double"))).alias("part nulls"), F.lit(None).cast("string").alias("none"),
        F.when(i % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(1.0)).alias("nan"), F.to_binary(F.hex(i % 11)).alias("bytes"),
    )
    made = sketches.column_sketches(df, F.col("part"))
    assert made.count() == 49
    got = {x["column_name"]: x for x in sketches.profile_of(sketches.united(made)).collect()}
    want = {"many": 45_000, "few": 3, "part nulls": 48_000, "none": 0, "bytes": 11, "part": 7}
    for c, n in want.items():
        assert abs(got[c]["distinct_estimate"] - n) <= n * sketches.DISTINCT_BOUND, c
        assert got[c]["row_count"] == 60_000
    assert (got["none"]["null_count"], got["part nulls"]["null_count"], got["none"]["quantile_estimates"]) == (60_000, 12_000, None)
    assert abs(got["many"]["quantile_estimates"][1] / 45_000 - 0.5) <= sketches.RANK_BOUND
    assert (got["many"]["low_number"], got["many"]["high_number"], got["nan"]["high_number"]) == (0.0, 44_999.0, 1.0)
    some = {x["column_name"]: x for x in sketches.profile_of(sketches.united(made.filter("part < 2"))).collect()}
    assert some["part"]["distinct_estimate"] == 2 and some["part"]["high_number"] == 1.0
    assert rows(sketches.united(made, "part").select("part").distinct()) == [(k,) for k in range(7)]


def test_stored_sketches_read_new_files_only(spark, tmp_path):
    path = str(tmp_path / "t")

    def add(month, n):
        day = F.make_date(F.lit(2024), F.lit(month), F.lit(1)) + (F.col("id") % 20).cast("int")
        spark.range(n).select("id", day.alias("day")).write.mode("append").parquet(path)
        return spark.read.parquet(path)

    kept = StoredSketches(spark, str(tmp_path / "s"), "day")
    assert kept.refresh(add(1, 100)).rows_read == 100
    assert kept.refresh(add(2, 50)).rows_read == 50
    profile = {x["column_name"]: x for x in kept.profile("2024-02", "2024-02").collect()}
    assert (profile["id"]["row_count"], profile["id"]["distinct_estimate"], profile["day"]["low"]) == (50, 50, "2024-02-01")
    assert {(x["month"], x["row_count"]) for x in kept.profile(by_month=True).collect()} == {("2024-01", 100), ("2024-02", 50)}
    assert kept.profile().filter("column_name = 'id'").first()["distinct_estimate"] in range(98, 103)
