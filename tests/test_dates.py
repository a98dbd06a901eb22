import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadlens.functions import dates

# The reference parser: these formats in this order, after collapsing white space.
FORMATS = (
    "%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%m-%d-%Y", "%d/%m/%Y", "%d-%m-%Y", "%Y%m%d", "%b %d %Y", "%b %d, %Y",
    "%B %d %Y", "%B %d, %Y", "%d %b %Y", "%d %B %Y", "%Y-%m-%d %H:%M:%S", "%Y/%m/%d %H:%M:%S",
    "%m/%d/%Y %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ",
)
JUNK = [
    "", " ", "n/a", "2024", "2024-13-01", "2024-02-30", "20241301", "13/13/2024", "Foo 1 2024", "2024-3", "31-31-2024",
    "2024-01-01 25:00:00", "2024-01-01 10:61:00", "1/2/24", "2024/01-02", "Sept 1 2024", "Apr 31 2024", "32 May 2024",
    "0000-01-01", "2024-01-01x", "x2024-01-01", "12/25/2024 01:02", "2024-01-01T01:02:03ZZ", "99999999",
]
SPECIAL = [
    "Sep  1 2022", "sep 1 2022", "SEPTEMBER 1, 2022", " 2024-1-5 ", "1/2/2024", "13/2/2024", "2-13-2024", "13-2-2024",
    "May 5 2020", "5 may 2020", "2024-01-01  10:00:00", "2/29/2024", "2/29/2023", "29/2/2024",
]


def python_parse(text):
    clean = " ".join(text.split())
    for fmt in FORMATS:
        try:
            return dt.datetime.strptime(clean, fmt).date()
        except ValueError:
            continue
    return None


def test_parse_date_matches_ordered_formats(spark):
    days = [dt.datetime(2024, 4, 1), dt.datetime(1999, 12, 31, 23, 59, 59), dt.datetime(2020, 2, 29, 1, 2, 3)]
    cells = [d.strftime(f) for d in days for f in FORMATS] + SPECIAL + JUNK
    got = spark.createDataFrame([(c,) for c in cells], "c string").select("c", dates.parse_date(F.col("c"))).collect()
    assert {c: d for c, d in got} == {c: python_parse(c) for c in cells}


def test_parse_file_date(spark):
    cells = ["2024-01-05", "20240105", "01/05/2024", "1/5/2024", " 2024-01-05\t", "2024/01/05", "05-01-2024", "", None]
    got = spark.createDataFrame([(c,) for c in cells], "c string").select(dates.parse_file_date(F.col("c"))).collect()
    day = dt.date(2024, 1, 5)
    assert [r[0] for r in got] == [day, day, day, day, day, None, None, None, None]


def test_render_keeps_what_does_not_parse(spark):
    got = spark.createDataFrame([("Apr  1 2024",), ("20240401",), ("soon",)], "c string").select(
        dates.render_date(F.col("c"))
    )
    assert [r[0] for r in got.collect()] == ["2024-04-01", "2024-04-01", "soon"]


@pytest.mark.parametrize("month,last", [("2024-02", 29), ("2023-02", 28), ("2024-12", 31)])
def test_month_range(month, last):
    first, end = dates.month_range(month)
    assert first.day == 1 and end.day == last


def test_range_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select timestamp_ntz'2024-01-05 10:00:00' as ts, 1 as x").write.parquet(path)
    df = spark.read.parquet(path)
    found = df.filter(dates.date_between(df, "ts", "2024-01-01", "2024-01-05"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert found.count() == 1


def test_month_by_spelling(spark):
    cells = ["2023-08-01", "20230801", "01-08-2023", "08/01/2023", "2023-09-01", "08/2023", "Aug 1 2023", None]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = [r[0] for r in df.filter(dates.in_month_spelling(df, "c", "2023-08")).collect()]
    assert got == cells[:4]


def test_integer_days_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(20240105,), (20240131,), (20240199,), (20240201,), (5,)], "d int").write.parquet(path)
    df = spark.read.parquet(path)
    found = df.filter(dates.date_between(df, "d", "2024-01-01", "2024-01-31"))
    assert "GreaterThanOrEqual(d,20240101)" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r[0] for r in found.collect()) == [20240105, 20240131]


def test_damaged_dates_parse_like_the_ordered_formats(spark):
    import random
    import re

    pick = random.Random(11)
    cells = set()
    for _ in range(3000):
        year, month, day = pick.choice([1, 99, 1900, 2000, 2024, 9999]), pick.randint(1, 12), pick.randint(1, 28)
        text = list(dt.datetime(year, month, day, 1, 2, 3).strftime(pick.choice(FORMATS)))
        for _ in range(pick.randint(0, 3)):
            place = pick.randrange(len(text)) if text else 0
            kind = pick.random()
            if kind < 0.4 and text:
                text[place] = pick.choice("0123456789-/ ,:TZJan")
            elif kind < 0.7 and text:
                del text[place]
            else:
                text.insert(place, pick.choice("0123456789-/ ,:TZ"))
        cells.add("".join(text))
    # Left out on purpose: fewer than eight bare digits, and a blank in place of a day's leading zero.
    loose = re.compile(r"^\s*\d{6,7}\s*$|[-/0-9] \d(?!\d)")
    cells = sorted(c for c in cells if not loose.search(c))
    got = spark.createDataFrame([(c,) for c in cells], "c string").select("c", dates.parse_date(F.col("c"))).collect()
    assert {c: d for c, d in got} == {c: python_parse(c) for c in cells}
