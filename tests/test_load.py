import datetime as dt

import pytest

from conftest import rows
from loadlens.contracts import Contract, load_contracts
from loadlens.operators import history, profile
from loadlens.plans import load as op
from loadlens.session import scratch
from loadlens.sources import delimited, inventory
from loadlens.sources.lines import read_lines
from loadlens.streaming.ingest import ingest_new_files

TEST = Contract(
    "test_{date_range}.tsv", "TEST_TABLE", ("recordDate", "assetId", "fundId", "value"), "recordDate",
    ("recordDate", "assetId", "fundId"), types={"value": "double"},
)
BODY = "20240101\tA001\tF001\t100.50\n20240102\tA001\tF001\t101.25\n20240103\tA002\tF001\t200.00\n"


def test_contract_defaults():
    entry = {"file_pattern": "sales_{month}.csv", "table_name": "S", "duplicate_key_columns": "id"}
    c = load_contracts('{"files": [' + __import__("json").dumps(entry) + "]}")[0]
    assert (c.format, c.separator, c.duplicate_key_columns) == ("CSV", ",", ("id",))
    assert Contract("a_{month}.tsv", "A").separator == "\t"
    assert Contract("a_{month}.tsv", "A", delimiter=",").separator == ","


def test_matching_and_periods(spark):
    names = ["in/test_20240101-20240131.tsv", "in/test_20240101-20240131.tsv.gz", "in/test_2024-01.tsv", "in/xtest_20240101-20240131.tsv"]
    files = spark.createDataFrame([(n, 1) for n in names], "path string, length bigint")
    got = inventory.match_contracts(files, [TEST, Contract("test_{month}.tsv", "M")])
    assert rows(got, "path", "table_name", "period") == sorted(
        [(names[0], "TEST_TABLE", "20240101-20240131"), (names[1], "TEST_TABLE", "20240101-20240131"), (names[2], "M", "2024-01")]
    )
    month = inventory.month_files(files, [TEST, Contract("test_{month}.tsv", "M")], "2024-01")
    assert rows(month, "path") == sorted((n,) for n in names[:3])
    spans = rows(inventory.with_period(files), "path", "period_start", "period_end")
    assert {s[1:] for s in spans} == {(dt.date(2024, 1, 1), dt.date(2024, 1, 31))}


@pytest.mark.parametrize(
    "folder,month", [("012024", "2024-01"), ("2024-01", "2024-01"), ("period=2024-01", "2024-01"), ("jan", None)]
)
def test_month_folders(spark, folder, month):
    df = spark.createDataFrame([(f"/base/{folder}/f.tsv",)], "path string")
    assert df.select(inventory.period_of_path(df.path)).collect()[0][0] == month


def test_file_quality_passes(spark, write_file):
    path = write_file("test_20240101-20240103.tsv", BODY)
    got = op.file_quality(spark, TEST, path).collect()[0]
    assert (got["total_rows"], got["unique_dates"], got["missing_dates"], got["invalid_dates"]) == (3, 3, 0, 0)
    assert got["schema_match"] and got["passed"]


def test_file_quality_counts_header_and_gaps(spark, write_file):
    body = "recordDate\tassetId\tfundId\tvalue\n" + BODY.replace("20240102", "2024-01-09") + "\tA\tF\t1\n" + "\n"
    path = write_file("test_20240101-20240104.tsv", body)
    got = op.file_quality(spark, TEST, path).collect()[0]
    # The header's date cell and the empty one are invalid, 2024-01-09 is outside, the blank line has no cell.
    assert (got["total_rows"], got["unique_dates"], got["missing_dates"], got["invalid_dates"]) == (6, 2, 2, 2)
    assert [d.day for d in got["missing_date_list"]] == [2, 4] and not got["passed"]
    bad = rows(op.invalid_file_dates(spark, TEST, path), "line_no", "value")
    assert bad == [(1, "recordDate"), (5, "")]


def test_file_without_a_period_fails_its_check(spark, write_file):
    assert not op.file_quality(spark, TEST, write_file("nameless.tsv", BODY)).collect()[0]["passed"]


def test_wrong_width_fails_its_check(spark, write_file):
    path = write_file("test_20240101-20240103.tsv", BODY.replace("\tF001", ""))
    got = op.file_quality(spark, TEST, path).collect()[0]
    assert (got["actual_columns"], got["schema_match"], got["passed"]) == (3, False, False)


def test_dialect(spark, write_file):
    body = '"a,b",NULL,null,\\N\n"say ""hi""",,x\n1,2,3,4,5\nback\\slash,"",é,z\n'
    path = write_file("d.csv", body)
    got = [tuple(r) for r in delimited.scan_delimited(spark, path, ["a", "b", "c", "d"], ",").collect()]
    assert got == [
        ("a,b", None, None, None), ('say "hi"', None, "x", None), ("1", "2", "3", "4"), ("back\\slash", None, "é", "z"),
    ]


def test_invalid_bytes_are_replaced(spark, write_file):
    path = write_file("l.tsv", "käse\t1\n".encode("latin-1"))
    assert delimited.scan_delimited(spark, path, ["a", "b"]).collect()[0]["a"] == "k�se"
    ok = delimited.scan_delimited(spark, path, ["a", "b"], encoding="ISO-8859-1").collect()[0]["a"]
    assert ok == "käse"


def test_abort_and_quarantine(spark, write_file):
    path = write_file("test_20240101-20240103.tsv", BODY.replace("101.25", "1O1"))
    strict = op.load_contract(spark, TEST, path, scratch(spark, "t"))
    assert (strict.status, strict.rows_loaded) == ("failed", 0)
    target, rejects = scratch(spark, "t"), scratch(spark, "r")
    kind = op.load_contract(spark, TEST, path, target, on_error="quarantine", quarantine=rejects)
    assert (kind.status, kind.rows_loaded, kind.rows_rejected) == ("success", 2, 1)
    bad = spark.read.parquet(rejects).collect()[0]
    assert bad["value"] == "1O1" and bad["_rejected_columns"] == ["value"]
    assert spark.read.parquet(target).count() == 2


def test_files_load_one_by_one(spark, write_file):
    good = write_file("test_20240101-20240103.tsv", BODY)
    gap = write_file("test_20240101-20240105.tsv", BODY)
    missing = good.replace("0103", "0199")
    target = scratch(spark, "t")
    got = op.load_files(spark, TEST, [good, gap, missing], target)
    assert rows(got, "status", "rows_loaded") == [("failed", 0), ("qc_failed", 0), ("success", 3)]
    assert rows(op.load_files(spark, TEST, [gap], target, validate_only=True), "status") == [("qc_failed",)]
    assert rows(op.load_files(spark, TEST, [gap], target, skip_qc=True), "status") == [("success",)]
    assert rows(op.load_files(spark, TEST, [gap], target, validate_after=True), "status") == [("loaded_with_issues",)]
    assert spark.read.parquet(target).count() == 9


def test_audit_trail_feeds_the_history(spark, tmp_path):
    path = str(tmp_path / "audit")
    results = [op.LoadResult("T", "a.tsv", "success", 600, 0, 3.0), op.LoadResult("T", "b.tsv", "failed", 0, 0, 1.0, "out of memory")]
    op.append_audit(spark, results, path)
    trail = spark.read.parquet(path)
    assert history.load_throughput(trail).collect()[0]["rows_per_second"] == 200.0
    failed = history.load_errors(trail)
    assert failed.count() == 1
    assert rows(history.error_classes(failed), "error_class", "errors") == [("memory", 1)]


def test_ingest_takes_only_new_files(spark, write_file, tmp_path):
    write_file("land/2024-01/a.tsv", BODY)
    args = (spark, TEST, str(tmp_path / "land"), str(tmp_path / "table"), str(tmp_path / "state"))
    assert ingest_new_files(*args) == 3
    assert ingest_new_files(*args) == 0
    write_file("land/022024/b.tsv", BODY)
    assert ingest_new_files(*args) == 3
    got = spark.read.parquet(str(tmp_path / "table")).groupBy("period").count()
    assert [(str(p), n) for p, n in rows(got)] == [("2024-01", 3), ("2024-02", 3)]


def test_proposals(spark, write_file, tmp_path):
    write_file("p/fact_sales_20240101-20240131.tsv", "RECORDDATE\tASSETID\tv\n20240101\tA\t1\n")
    write_file("p/fact_sales_20240201-20240229.tsv", "RECORDDATE\tASSETID\tv\n20240201\tA\t1\n")
    write_file("p/test_x_2024-01.csv", "1,2,3\n4,5,6\n")
    got = {r["file_pattern"]: r for r in profile.propose_contracts(read_lines(spark, str(tmp_path / "p"))).collect()}
    assert set(got) == {"fact_sales_{date_range}.tsv", "test_x_{month}.csv"}
    sales = got["fact_sales_{date_range}.tsv"]
    assert sales["expected_columns"] == ["RECORDDATE", "ASSETID", "v"] and sales["table_name"] == "_SALES"
    assert sales["duplicate_key_columns"] == ["RECORDDATE", "ASSETID"] and sales["delimiter"] == "\t"
    assert got["test_x_{month}.csv"]["expected_columns"] == ["COLUMN_1", "COLUMN_2", "COLUMN_3"]


def test_strict_load_fails_without_ansi_too(spark, write_file):
    path = write_file("test_20240101-20240103.tsv", BODY.replace("101.25", "1O1"))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        got = op.load_contract(spark, TEST, path, scratch(spark, "t"))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert got.status == "failed" and "1O1" in got.error


def test_ragged_rows_can_be_rejected(spark, write_file):
    path = write_file("test_20240101-20240103.tsv", BODY + "20240104\tA003\n" + "20240105\tA\tF\t1.0\textra\n")
    padded = op.load_contract(spark, TEST, path, scratch(spark, "t"), on_error="quarantine")
    assert (padded.rows_loaded, padded.rows_rejected) == (5, 0)
    rejects = scratch(spark, "r")
    strict = op.load_contract(
        spark, TEST, path, scratch(spark, "t"), on_error="quarantine", quarantine=rejects, reject_ragged=True
    )
    assert (strict.rows_loaded, strict.rows_rejected) == (3, 2)
    assert spark.read.parquet(rejects).count() == 2


def test_named_tables_are_listed(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS other")
    for name in ("default.sales_x", "other.sales_x", "default.alone"):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (a int) USING parquet")
    assert rows(profile.catalog_inventory(spark, "SALES_X"), "database", "is_match") == [("default", True), ("other", True)]
    assert profile.catalog_inventory(spark, "nowhere", limit=2).count() == 2


def test_a_bad_month_does_not_stop_the_others(spark, write_file, tmp_path):
    for folder, body in (("2024-01", BODY), ("022024", BODY.replace("100.50", "x")), ("2024-03", BODY), ("notes", BODY)):
        write_file(f"m/{folder}/a.tsv", body)
    target = scratch(spark, "t")
    got = op.load_each_month(spark, TEST, str(tmp_path / "m"), target)
    assert rows(op.load_totals(got), "status", "loads", "rows_loaded") == [("failed", 1, 0), ("success", 2, 6)]
    whole, _ = op.load_months(spark, TEST, str(tmp_path / "m"), scratch(spark, "t"))
    assert whole.status == "failed"
    some, counts = op.load_months(spark, TEST, str(tmp_path / "m"), scratch(spark, "t"), months=["2024-01", "2024-03"])
    assert some.rows_loaded == 6 and rows(counts) == [("2024-01", 3), ("2024-03", 3)]


def test_types_come_from_the_table(spark):
    table = spark.createDataFrame([], "RECORDDATE date, VALUE decimal(10,2), other int")
    assert TEST.typed_like(table).types == {"recordDate": "date", "value": "decimal(10,2)"}


def test_stream_fails_on_a_bad_value(spark, write_file, tmp_path):
    write_file("bad/2024-01/a.tsv", BODY.replace("100.50", "x"))
    args = (spark, TEST, str(tmp_path / "bad"), str(tmp_path / "table"))
    with pytest.raises(Exception, match="not a double: x"):
        ingest_new_files(*args, str(tmp_path / "s1"))
    assert ingest_new_files(*args, str(tmp_path / "s2"), strict=False) == 3


@pytest.mark.parametrize("options", [{}, {"partition_by": "period"}, {"spread": True}, {"on_error": "quarantine"}])
def test_empty_files_load_nothing(spark, write_file, options):
    path = write_file("2024-01/empty.tsv", "")
    got = op.load_contract(spark, TEST, path, scratch(spark, "t"), **options)
    assert (got.status, got.rows_loaded, got.rows_rejected) == ("success", 0, 0)
