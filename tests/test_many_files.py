"""Many files through the gate and into the table at once."""

import gzip

import pytest
from conftest import rows
from pyspark.sql import functions as F

from loadlens.contracts import Contract
from loadlens.plans import load
from loadlens.session import scratch

SALES = Contract(
    "sales_{date_range}.csv", "sales", ("day", "shop", "amount"), "day", ("day", "shop"), delimiter=",", quote_char='"',
    types={"day": "date", "amount": "double"},
)
NAME = "sales_20240101-20240103.csv"
BODY = '2024-01-01,a,1.5\n2024-01-02,"b, c",2\n2024-01-03,d,\n'


def jobs_of(spark, work):
    """What the work returns and the jobs it ran, all of which have no group."""
    count = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = count()
    return work(), count() - before


def test_jobs_do_not_depend_on_the_number_of_files(spark, write_file):
    # From 33 paths on Spark lists them in a job of its own, whatever their number.
    some = [write_file(f"some/{k}/{NAME}", BODY) for k in range(33)]
    many = [write_file(f"many/{k}/{NAME}", BODY) for k in range(120)]
    target = scratch(spark, "sales")
    _, few_jobs = jobs_of(spark, lambda: load.load_files(spark, SALES, some, target).collect())
    got, many_jobs = jobs_of(spark, lambda: load.load_files(spark, SALES, many, target))
    # Adaptive execution may save a job or two of either.
    assert few_jobs <= 12 and many_jobs <= 12
    assert rows(got.groupBy("status").agg(F.count("*"), F.sum("rows_loaded"))) == [("success", 120, 360)]
    assert spark.read.parquet(target).count() == 459


@pytest.mark.parametrize("on_error", ["abort", "quarantine"])
def test_bad_files_stop_no_other(spark, write_file, tmp_path, on_error):
    good = write_file(f"f/good one/{NAME}", BODY)
    bad_cell = write_file(f"f/cell/{NAME}", BODY.replace(",2\n", ",two\n"))
    quote = write_file(f"f/quote/{NAME}", BODY + '2024-01-03,"open,1\n')
    gap = write_file(f"f/gap/{NAME}", BODY.replace("2024-01-02", "2024-01-01"))
    wide = write_file(f"f/wide/{NAME}", BODY.replace(",1.5", ",x,y,1.5"))
    empty = write_file(f"f/empty/{NAME}", "")
    broken = str(tmp_path / "f" / f"{NAME}.gz")
    with open(broken, "wb") as f:
        f.write(gzip.compress(BODY.encode() * 5000)[:-20])
    missing = str(tmp_path / "f" / "none.csv")
    packed = write_file(f"f/packed/{NAME}.gz", BODY)
    paths = [good, bad_cell, quote, gap, wide, empty, broken, missing, packed]
    target = scratch(spark, "sales")
    got = {r["source"]: r for r in load.load_files(spark, SALES, paths, target, on_error=on_error).collect()}
    status = [got[p]["status"] for p in paths]
    cell = "failed" if on_error == "abort" else "success"
    assert status == ["success", cell, "failed", "qc_failed", "qc_failed", "qc_failed", "failed", "failed", "success"]
    assert "closed" in got[quote]["error"] and "exist" in got[missing]["error"] and got[broken]["error"]
    loaded = [got[p]["rows_loaded"] for p in (good, bad_cell, packed)]
    # One row of the bad file has an amount that is no number.
    assert loaded == ([3, 0, 3] if on_error == "abort" else [3, 2, 3])
    assert got[bad_cell]["rows_rejected"] == (0 if on_error == "abort" else 1)
    assert spark.read.parquet(target).count() == sum(loaded)


def test_folders_are_paths_too(spark, write_file, tmp_path):
    for k in range(4):
        write_file(f"g/{k % 2}/{k}/{NAME}", BODY if k else BODY.replace(",2\n", ",two\n"))
    target = scratch(spark, "sales")
    got = load.load_files(spark, SALES, [str(tmp_path / "g" / "0"), str(tmp_path / "g" / "1") + "/"], target)
    assert [(r["status"], r["rows_loaded"]) for r in got.collect()] == [("failed", 0), ("success", 6)]
    only = load.load_files(spark, SALES, [str(tmp_path / "g" / "1")], target, validate_only=True).collect()
    assert [r["status"] for r in only] == ["qc_passed"]
    assert load.load_files(spark, SALES, [], target).count() == 0
