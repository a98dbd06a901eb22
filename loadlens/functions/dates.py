"""Date parsing, rendering and period predicates as column expressions.

A value's shape (one regular expression each) decides which spelling it is;
the digits are then re-punctuated to ``yyyy-M-d`` and read by ``try_cast``,
which rejects impossible days without raising. No formatter object and no
exception is involved, so junk values cost no more than good ones.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions.text import strip

# English month names accepted in dates, in full or by three letters.
MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)

_CLOCK = r"(?:[01]?\d|2[0-3]):[0-5]?\d:(?:[0-5]?\d|6[01])"
_YEAR = r"(?!0000)\d{4}"
_MONTH_NAME = "(?i:" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS) + ")"


def _day(year: str, month: str, day: str, value: Column, pattern: str) -> Column:
    return F.regexp_replace(value, pattern, f"{year}-{month}-{day}").try_cast("date")


def _named_day(value: Column, pattern: str, month: int, day: int, year: int) -> Column:
    """A day whose month is a name: the place of its first letters gives the number.

    Text the pattern does not fit is left as it is and then fails the cast.
    """
    names = F.lit(" ".join(m[:3] for m in MONTHS))

    def read(text: Column) -> Column:
        number = ((F.position(F.lower(F.substring(text, 6, 3)), names) + 3) / 4).cast("int")
        return F.concat_ws(
            "-", F.left(text, F.lit(4)), number.cast("string"), F.substring_index(text, "-", -1)
        ).try_cast("date")

    return F.transform(F.array(F.regexp_replace(value, pattern, f"${year}-${month}-${day}")), read)[0]


def _plain_iso(v: Column) -> Column:
    """Exactly ``dddd-dd-dd``: the cast itself reads it, nothing is rewritten."""
    return v.rlike(rf"^{_YEAR}-[0-9]{{2}}-[0-9]{{2}}$")


def _written_date(v: Column) -> Column:
    """The spellings people write, and those with a time of day."""
    parts = rf"^(\d{{1,2}})([-/])(\d{{1,2}})\2({_YEAR})$"
    iso = rf"^({_YEAR})-(\d{{1,2}})-(\d{{1,2}})(?:[ T]{_CLOCK}|T{_CLOCK}Z)?$"
    slashed = rf"^({_YEAR})/(\d{{1,2}})/(\d{{1,2}})(?: {_CLOCK})?$"
    stamped = rf"^(\d{{1,2}})/(\d{{1,2}})/({_YEAR}) {_CLOCK}$"
    month_first = rf"^({_MONTH_NAME}) (\d{{1,2}}),? ({_YEAR})$"
    day_first = rf"^(\d{{1,2}}) ({_MONTH_NAME}) ({_YEAR})$"
    return F.when(v.rlike("^[A-Za-z]"), _named_day(v, month_first, month=1, day=2, year=3)).otherwise(
        F.when(
            v.rlike(parts),
            F.coalesce(_day("$4", "$1", "$3", v, parts), _day("$4", "$3", "$1", v, parts)),
        )
        .when(v.rlike(iso), _day("$1", "$2", "$3", v, iso))
        .when(v.rlike(slashed), _day("$1", "$2", "$3", v, slashed))
        .when(v.rlike(day_first), _named_day(v, day_first, month=2, day=1, year=3))
        .when(v.rlike(stamped), _day("$3", "$1", "$2", v, stamped))
    )


def parse_date(value: Column) -> Column:
    """Text to DATE over all accepted spellings; anything else is null.

    Month-first wins over day-first where both are possible. The two spellings
    machines write stay in generated code. The others sit in a one-element
    ``transform``: its body is evaluated only for cells that need it, binds
    the cleaned text once, and keeps the generated method small enough to be
    compiled.
    """
    t = strip(value)
    digits = F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2))
    clean = F.array(F.regexp_replace(t, r"\s+", " "))
    return (
        F.when(_plain_iso(t), t.try_cast("date"))
        .when(t.rlike(rf"^{_YEAR}[0-9]{{4}}$"), digits.try_cast("date"))
        .otherwise(F.transform(clean, _written_date)[0])
    )


def parse_file_date(value: Column) -> Column:
    """The three spellings accepted in files: ISO, eight digits, m/d/Y."""
    v = strip(value)
    iso = rf"^{_YEAR}-[0-9]{{1,2}}-[0-9]{{1,2}}$"
    digits = rf"^({_YEAR})([0-9]{{2}})([0-9]{{2}})$"
    us = rf"^(\d{{1,2}})/(\d{{1,2}})/({_YEAR})$"
    return (
        F.when(v.rlike(iso), v.try_cast("date"))
        .when(v.rlike(digits), _day("$1", "$2", "$3", v, digits))
        .when(v.rlike(us), _day("$3", "$1", "$2", v, us))
    )


def _is_typed(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def column_type(df: DataFrame, name: str) -> T.DataType:
    """Type of a column looked up without regard to case."""
    for field in df.schema.fields:
        if field.name.lower() == name.lower():
            return field.dataType
    raise KeyError(name)


def as_date(df: DataFrame, name: str) -> Column:
    """A column as DATE: typed columns are cast, everything else is parsed."""
    if _is_typed(column_type(df, name)):
        return F.col(name).cast("date")
    return parse_date(F.col(name).cast("string"))


def render_date(value: Column, parsed: Column | None = None) -> Column:
    """``yyyy-MM-dd`` where the value parses, the value itself otherwise."""
    text = value.cast("string")
    day = parse_date(text) if parsed is None else parsed
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), text)


def to_day(value: str | dt.date) -> dt.date:
    """Driver-side day from a date or a ``YYYY-MM-DD`` / ``YYYYMMDD`` string."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    text = value.strip()
    if len(text) == 8 and text.isdigit():
        text = f"{text[:4]}-{text[4:6]}-{text[6:]}"
    return dt.date.fromisoformat(text)


def date_between(df: DataFrame, name: str, start, end) -> Column:
    """Closed day range on a column, written so that typed columns push down.

    Without both bounds there is no restriction.
    """
    if start is None or end is None:
        return F.lit(True)
    lo, hi = to_day(start), to_day(end)
    dtype = column_type(df, name)
    col = F.col(name)
    if isinstance(dtype, T.DateType):
        return col.between(F.lit(lo), F.lit(hi))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        kind = dtype.simpleString()
        after = hi + dt.timedelta(days=1)
        return (col >= F.lit(f"{lo} 00:00:00").cast(kind)) & (
            col < F.lit(f"{after} 00:00:00").cast(kind)
        )
    parsed = as_date(df, name)
    if isinstance(dtype, T.IntegralType):
        # Only eight digits are a date, and those sort like their days: the bounds reach the files.
        return col.between(F.lit(int(f"{lo:%Y%m%d}")), F.lit(int(f"{hi:%Y%m%d}"))) & parsed.isNotNull()
    return parsed.between(F.lit(lo), F.lit(hi))


def raw_between(name: str, start, end) -> Column:
    """Range on the stored value itself, with no date parsing."""
    return F.col(name).between(F.lit(start), F.lit(end))


def month_range(month: str) -> tuple[dt.date, dt.date]:
    """First and last day of ``YYYY-MM``."""
    year, number = (int(x) for x in month.split("-"))
    return dt.date(year, number, 1), dt.date(year, number, calendar.monthrange(year, number)[1])


def month_start(month: Column) -> Column:
    return F.concat(month, F.lit("-01")).try_cast("date")


def month_end(month: Column) -> Column:
    return F.last_day(month_start(month))


def expected_days(start: Column, end: Column) -> Column:
    """Days in a closed range; zero if a bound is missing."""
    return F.coalesce(F.datediff(end, start) + 1, F.lit(0)).cast("bigint")


def in_month_spelling(df: DataFrame, name: str, month: str) -> Column:
    """Rows of one month, by spelling for text columns and by range otherwise."""
    dtype = column_type(df, name)
    if _is_typed(dtype):
        return date_between(df, name, *month_range(month))
    year, number = month.split("-")
    text = F.col(name).cast("string")
    return (
        text.startswith(f"{year}-{number}-")
        | text.startswith(f"{year}{number}")
        | text.endswith(f"-{number}-{year}")
        | (text.startswith(f"{number}/") & text.endswith(f"/{year}") & (F.length(text) > 7))
    )
