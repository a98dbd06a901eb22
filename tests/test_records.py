"""Quoted records over line ends, cut in many tasks."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from loadlens.contracts import Contract
from loadlens.operators import structure
from loadlens.plans import load
from loadlens.session import scratch
from loadlens.sources import delimited
from loadlens.sources.lines import read_lines
from loadlens.sources.records import quoted_records

COLUMNS = ("day", "note", "n")
NOTES = Contract("n_{month}.csv", "notes", COLUMNS, "day", delimiter=",", quote_char='"', types={"n": "bigint"}, multiline=True)


@pytest.fixture
def tiny_splits(spark):
    """Splits far smaller than many of the cells."""
    for key, value in (("maxPartitionBytes", "150"), ("openCostInBytes", "1")):
        spark.conf.set(f"spark.sql.files.{key}", value)
    yield
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{key}")


def body(seed, count):
    r = random.Random(seed)
    out = []
    for k in range(count):
        cell = "".join(r.choice('ab ,\n"') for _ in range(r.choice([0, 3, 10, 700 if k % 9 == 0 else 5])))
        note = '"' + cell.replace('"', '""') + '"' if k % 3 else "plain"
        out.append(f"2024-01-{k % 28 + 1:02d},{note},{k}\n")
    return "".join(out)


def test_records_are_those_of_the_multi_line_reader(spark, write_file, tmp_path, tiny_splits):
    for k in range(4):
        write_file(f"r/{k}/n_2024-01.csv", body(k, 60)[: -1 if k == 2 else None])
    folder = str(tmp_path / "r")
    lines = read_lines(spark, folder)
    assert lines.rdd.getNumPartitions() > 20
    records = quoted_records(lines)
    cut = records.select(delimited.fields(F.col("value"), ",", '"').alias("c"))
    got = cut.select(*[F.col("c")[k].alias(c) for k, c in enumerate(COLUMNS)])
    options = delimited.scan_options(",", '"', False, None, False, True)
    want = spark.read.schema(delimited.string_schema(COLUMNS)).options(**options).option("recursiveFileLookup", "true").csv(folder)
    want = want.select(*[F.coalesce(c, F.lit("")).alias(c) for c in COLUMNS])
    assert rows(got) == rows(want) and got.count() == 240


def test_line_numbers_and_order(spark, write_file, tiny_splits):
    path = write_file("o/n_2024-01.csv", body(7, 80))
    got = quoted_records(read_lines(spark, path)).orderBy("block", "seq").select("line_no", "value").collect()
    assert "".join(r["value"] + "\n" for r in got) == body(7, 80)
    at = 1
    for r in got:
        assert r["line_no"] == at
        at += r["value"].count("\n") + 1


def test_one_cell_over_many_splits_and_quotes_left_open(spark, write_file, tiny_splits):
    long = '1,"' + "line\n" * 900 + '",2\n'
    path = write_file("l/a.csv", "0,a,1\n" + long + "3,b,4\n" + '5,"never closed\nx\ny\n')
    got = [r["value"] for r in quoted_records(read_lines(spark, path)).orderBy("line_no").collect()]
    assert got == ["0,a,1", long[:-1], "3,b,4", '5,"never closed\nx\ny']
    assert quoted_records(read_lines(spark, write_file("l/e.csv", ""))).count() == 0


def test_scan_is_not_repeated(spark, write_file):
    df = quoted_records(read_lines(spark, write_file("p/a.csv", body(1, 30))))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan[plan.index("== Final Plan") : plan.index("== Initial Plan")].count("FileScan text") <= 3


def test_loads_and_checks_take_such_files(spark, write_file, tiny_splits):
    whole = write_file("m/n_2024-01.csv", "".join(f'2024-01-{k:02d},"a\nb ""{k}""",{k}\n' for k in range(1, 32)))
    wide = write_file("w/n_2024-01.csv", '2024-01-01,"a\n,b",1,2\n' + "2024-01-02,x,1\n")
    got = {r["file"].split("/")[-2]: r for r in load.file_quality(spark, NOTES, [whole, wide]).collect()}
    assert (got["m"]["passed"], got["m"]["actual_columns"], got["m"]["total_rows"]) == (True, 3, 31)
    assert (got["w"]["schema_match"], got["w"]["actual_columns"], got["w"]["total_rows"]) == (False, 4, 2)
    target = scratch(spark, "notes")
    assert load.load_contract(spark, NOTES, whole, target).rows_loaded == 31
    assert spark.read.parquet(target).filter("n = 7").first()["note"] == 'a\nb "7"'
    # The first record sets the width.
    ragged = structure.ragged_rows(quoted_records(read_lines(spark, wide)), ",", quote='"')
    assert ragged.count() == 1
