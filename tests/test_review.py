"""Cases found in review: lines and fields, files kept apart, whole lists, deletes that are undone."""

import glob
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from loadlens.contracts import Contract
from loadlens.functions.text import field_count, fields
from loadlens.operators import duplicates, series, structure
from loadlens.operators.series import Target
from loadlens.plans import audit, delete, load
from loadlens.session import scratch
from loadlens.sources import delimited, inventory, sinks
from loadlens.sources.lines import read_lines
from loadlens.streaming.volume import daily_volume

DAYS = Contract("t_{date_range}.csv", "t", ("id", "note", "d"), "d", delimiter=",")


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "v string").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "line, want",
    [
        ('1,"a,b",c', ["1", "a,b", "c"]),
        ('"say ""hi""",,x', ['say "hi"', "", "x"]),
        ('a\u0001b,"c\u0001,\u0001ad",e', ["a\u0001b", "c\u0001,\u0001ad", "e"]),
        ('"",x,""', ["", "x", ""]),
        ("", [""]),
    ],
)
def test_quoted_fields(spark, line, want):
    assert one(spark, line, lambda v: fields(v, ",", '"')) == want
    assert one(spark, line, lambda v: field_count(v, ",", '"')) == len(want)


def test_line_of_many_quoted_fields(spark):
    line = ",".join(['"a,b"'] * 20_000)
    assert len(one(spark, line, lambda v: fields(v, ",", '"'))) == 20_000
    assert one(spark, line, lambda v: field_count(v, ",", '"')) == 20_000


def test_scan_and_check_agree_on_lines(spark, write_file):
    body = b"1\ta\rb\t2024-01-01\r\n\n\x00a\tx\t2024-01-02\n"
    path = write_file("l/t_20240101-20240102.tsv", body)
    c = Contract("t_{date_range}.tsv", "t", ("id", "note", "d"), "d", quote_char=None)
    got = [tuple(r) for r in load.read_contract(spark, c, path).collect()]
    assert got == [("1", "a\rb", "2024-01-01"), (None, None, None), ("\x00a", "x", "2024-01-02")]
    assert load.file_quality(spark, c, path).first()["total_rows"] == len(got)


def test_quoted_line_feed(spark, write_file):
    path = write_file("q/t_20240101-20240101.csv", '1,"a\nb",2024-01-01\n')
    with pytest.raises(Exception, match="not closed"):
        load.read_contract(spark, DAYS, path).collect()
    spanning = Contract("t_{date_range}.csv", "t", ("id", "note", "d"), "d", delimiter=",", multiline=True)
    assert rows(load.read_contract(spark, spanning, path)) == [("1", "a\nb", "2024-01-01")]
    check = load.file_quality(spark, spanning, path).first()
    assert (check["total_rows"], check["passed"]) == (1, True)


@pytest.mark.parametrize("header", ["id,note,d\r\n", "ID,NOTE,D\n", "some,thing,else\n"])
def test_header_goes_by_position(spark, write_file, header):
    c = Contract("t_{date_range}.csv", "t", ("id", "note", "d"), "d", delimiter=",", header=True)
    path = write_file("h/t_20240101-20240102.csv", header + "1,x,2024-01-01\n2,y,2024-01-02\r\n")
    check = load.file_quality(spark, c, path).first()
    assert (check["total_rows"], check["invalid_dates"], check["passed"]) == (2, 0, True)
    assert load.invalid_file_dates(spark, c, path).count() == 0
    assert rows(load.read_contract(spark, c, path), "d") == [("2024-01-01",), ("2024-01-02",)]


@pytest.mark.parametrize("kind", ["double", "float", "decimal(10,2)", "int"])
def test_java_suffixes_are_no_numbers(spark, kind):
    df = spark.createDataFrame([("12d",), ("1f",), ("7",)], "v string")
    assert rows(df.filter(F.size(delimited.bad_cells(df, {"v": kind})) > 0)) == [("12d",), ("1f",)]


def test_widths_with_quotes(spark, write_file):
    lines = read_lines(spark, write_file("w/a.csv", 'h,i\n1,"x,y"\n1,2,3\n'))
    assert rows(structure.ragged_rows(lines, ",", quote='"'), "line_no") == [(3,)]
    assert rows(structure.ragged_rows(lines, ","), "line_no") == [(2,), (3,)]


def test_writers_keep_files_apart(spark, write_file, tmp_path):
    for k in range(5):
        write_file(f"m/{k}/f.csv", f"h\nrow{k}\nend{k}\n")
    source = str(tmp_path / "m")
    want = sorted(["h", f"row{k}", f"end{k}"] for k in range(5))

    def written(folder):
        return sorted([x.value for x in spark.read.text(d).collect()] for d in glob.glob(f"{folder}/source=*"))

    sinks.compressed_copy(spark, source, str(tmp_path / "gz"))
    sinks.write_sample(read_lines(spark, source), str(tmp_path / "sample"), 2)
    sinks.split_files(spark, source, str(tmp_path / "split"), 100)
    assert written(tmp_path / "gz") == want == written(tmp_path / "split")
    assert written(tmp_path / "sample") == sorted(x[:2] for x in want)
    structure.write_clean(read_lines(spark, source), str(tmp_path / "clean"), ",").collect()
    assert written(tmp_path / "clean/keep=true") == want


def test_empty_files_are_listed(spark, write_file, tmp_path):
    write_file("e/a.csv", "x\n")
    write_file("e/b.csv", "")
    assert rows(inventory.file_inventory(spark, str(tmp_path / "e")), "length") == [(0,), (2,)]


def test_empty_tables_miss_their_range(spark):
    s = series.daily_series(spark.createDataFrame([], "d date"), "d", "t")
    assert series.missing_days(s, "2024-01-01", "2024-01-03", tables=["t"]).count() == 3
    done = series.completeness(s, "2024-01-01", "2024-01-03", tables=["t"]).first()
    assert (done["total_rows"], done["missing_dates"]) == (0, 3)


def test_lists_are_whole_unless_cut(spark):
    odd = spark.sql("SELECT 't' AS table_name, date_add(DATE'2020-01-01', CAST(2 * id AS INT)) AS d, 5 AS n FROM range(300)")
    odd = odd.withColumn("d", F.col("d").cast("date")).withColumn("n", F.col("n").cast("bigint"))
    assert series.listed_gaps(odd).count() == 299
    first = series.listed_gaps(odd, limit=10)
    assert first.count() == 10 and first.filter("truncated").count() == 10
    assert series.listed_gaps(odd, limit=299).filter("truncated").count() == 0
    far = odd.filter("d IN (DATE'2020-01-01', DATE'2020-05-30')")
    assert series.missing_from_gaps(far).count() == 149
    t = Target("t", odd.select("d"), "d")
    assert len(audit.validate_tables(spark, [t]).first()["missing_date_list"]) == 299
    cut = audit.validate_tables(spark, [t], listed=5).first()
    assert (len(cut["gaps"]), cut["truncated"]) == (5, True)


def test_no_table_with_keys(spark):
    assert duplicates.check_tables([Target("t", spark.range(3).toDF("k"))]).count() == 0


def test_streamed_days_are_those_of_utc(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        at = spark.sql("SELECT timestamp_seconds(1704153600 + 3600) AS at")
        assert str(daily_volume(at, "at").first()["d"]) == "2024-01-02"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_a_delete_that_fails_is_undone(spark, monkeypatch):
    df = spark.sql(
        "SELECT id, date_add(DATE'2024-01-01', CAST(id AS INT)) AS d, "
        "date_format(date_add(DATE'2024-01-01', CAST(id AS INT)), 'yyyy-MM') AS month FROM range(120)"
    )
    delete.external_table(spark, df, "undone", "month")
    real, calls = type(spark).sql, []

    def failing(self, text, *args, **kwargs):
        if text.startswith("ALTER TABLE undone DROP"):
            calls.append(text)
            if len(calls) == 2:
                raise RuntimeError("the catalog is gone")
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", failing)
    import datetime as dt

    whole = delete.Deletion("undone", "d", dt.date(2024, 1, 1), dt.date(2024, 3, 31))
    done = delete.delete_periods(spark, [whole], dry_run=False, month_partition="month").first()
    monkeypatch.undo()
    assert done["status"] == "failed" and "catalog is gone" in str(done)
    assert spark.table("undone").count() == 120
    spark.sql("DROP TABLE undone")


def test_table_is_judged_after_the_load(spark, write_file):
    c = Contract("t_{date_range}.tsv", "t", ("id", "d"), "d", quote_char=None, types={"d": "date"})
    a = write_file("v/t_20240101-20240102.tsv", "1\t2024-01-01\n2\t2024-01-02\n")
    b = write_file("v/t_20240103-20240105.tsv", "1\t2024-01-03\n2\t2024-01-05\n")
    got = load.load_files(spark, c, [a, b], scratch(spark, "judged"), validate_after=True)
    assert rows(got, "status") == [("loaded_with_issues",), ("success",)]
    assert os.path.exists(a)
