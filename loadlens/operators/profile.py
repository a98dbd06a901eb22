"""Column profiles, type guesses, schema checks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadlens.contracts import Contract
from loadlens.functions import dates
from loadlens.functions.text import LOAD_NULLS, MISMATCH_NULLS, NUMBER, fields, is_digits, is_null_token, strip
from loadlens.operators.sniff import by_delimiter, detect_format, names_first
from loadlens.sources import inventory
from loadlens.sources.lines import first_lines

# Date spellings counted per column.
DATE_PATTERNS = {
    "YYYY-MM-DD": r"^\d{4}-\d{2}-\d{2}$",
    "YYYYMMDD": r"^\d{8}$",
    "MM/DD/YYYY": r"^\d{2}/\d{2}/\d{4}$",
    "DD-MON-YYYY": r"^\d{2}-[A-Za-z]{3}-\d{4}$",
    "Mon DD YYYY": r"^[A-Za-z]{3}\s+\d{1,2}\s+\d{4}$",
}

# Column names proposed as keys, dates first.
KEY_DATE_NAMES = ("RECORDDATE", "RECORDDATEID", "DATE", "TRADE_DATE")
KEY_ID_NAMES = ("ASSETID", "ASSET_ID", "FUNDID", "FUND_ID", "SECURITY_ID")
MAX_KEY_COLUMNS = 3
LONG_VALUE = 64


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, the way a delimited file would hold it."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def cells(df: DataFrame, columns: list[str] | None = None, ids: list[str] | None = None) -> DataFrame:
    """Long form ``(ids..., column_name, value)`` with values as text."""
    columns, ids = columns or [c for c in df.columns if c not in (ids or [])], ids or []
    text = df.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return text.unpivot(ids, columns, "column_name", "value")


def schema_width(lines: DataFrame, contract: Contract) -> DataFrame:
    """First row's field count against the contract, per file."""
    expected = len(contract.expected_columns)
    actual = F.size(fields(F.col("first_line"), contract.separator, contract.quote_char)).cast("bigint")
    return first_lines(lines).select(
        "file",
        actual.alias("actual_columns"),
        F.lit(expected).cast("bigint").alias("expected_columns"),
        (actual == expected).alias("schema_match"),
    )


def null_counts(df: DataFrame, tokens=LOAD_NULLS, any_case: bool = False) -> DataFrame:
    """Null cells per column in one global aggregation."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[
            F.count(F.when(is_null_token(F.col(f"`{c}`").cast("string"), tokens, any_case), 1)).alias(c)
            for c in df.columns
        ],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_count"), F.col("_rows").alias("row_count"))
            for c in df.columns
        ]
    )
    return counts.select(F.inline(pairs))


def _guess_one(value: Column) -> Column:
    """Type of one value, digit tests first: ISO dates come out FLOAT."""
    bare = F.replace(F.replace(value, F.lit("."), F.lit("")), F.lit("-"), F.lit(""))
    return (
        F.when(is_digits(value), "INTEGER")
        .when(is_digits(bare), "FLOAT")
        .when(dates.parse_file_date(value).isNotNull(), "DATE")
        .otherwise("VARCHAR")
    )


def guess_types_first_value(df: DataFrame, order: list[str], tokens=LOAD_NULLS) -> DataFrame:
    """Type of the first non-null value of each column, in a stated order.

    A global aggregation with one minimum per column: rows are neither
    multiplied nor sorted.
    """
    position, firsts = F.struct(*order), []
    for c in df.columns:
        value = F.col(f"`{c}`").cast("string")
        firsts.append(F.min_by(value, F.when(~is_null_token(value, tokens), position)).alias(c))
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("first_value")) for c in df.columns]
    )
    value = F.col("first_value")
    return (
        df.agg(*firsts)
        .select(F.inline(pairs))
        .select("column_name", F.when(value.isNull(), "UNKNOWN").otherwise(_guess_one(value)).alias("type"))
    )


def is_sampled_date(value: Column) -> Column:
    """Date by spelling: ISO, eight digits in range, or m/d/Y."""
    year, month, day = (F.substring(value, p, n).cast("int") for p, n in ((1, 4), (5, 2), (7, 2)))
    in_range = year.between(1900, 2100) & month.between(1, 12) & day.between(1, 31)
    return (
        value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
        | value.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$")
        | F.when(value.rlike(r"^[0-9]{8}$"), in_range).otherwise(F.lit(False))
    )


def guess_types(df: DataFrame, tokens=LOAD_NULLS) -> DataFrame:
    """Type that fits every non-null value of a column; independent of order."""
    v = F.when(~is_null_token(F.col("value"), tokens), F.col("value"))
    return (
        cells(df)
        .select("column_name", v.alias("value"))
        .groupBy("column_name")
        .agg(
            F.count("value").alias("values"),
            F.bool_and(is_sampled_date(F.col("value"))).alias("dates"),
            F.bool_and(F.col("value").rlike(r"^-?[0-9]+$")).alias("integers"),
            F.bool_and(F.col("value").rlike(r"^-?[0-9]+\.?[0-9]*$")).alias("numbers"),
        )
        .select(
            "column_name",
            F.when(F.col("values") == 0, "UNKNOWN")
            .when(F.col("dates"), "DATE")
            .when(F.col("integers"), "INTEGER")
            .when(F.col("numbers"), "FLOAT")
            .otherwise("VARCHAR")
            .alias("type"),
        )
    )


def value_class(value: Column) -> Column:
    """Class of one cell: NULL, FLOAT, INTEGER, a date spelling, a code, or STRING."""
    return (
        F.when(is_null_token(value, MISMATCH_NULLS, any_case=True), "NULL")
        .when(strip(value).rlike(NUMBER), F.when(F.contains(value, F.lit(".")), "FLOAT").otherwise("INTEGER"))
        .when(value.rlike(r"^[0-9]{8}$"), "DATE(YYYYMMDD)")
        .when(value.rlike(r"^.{4}-.{2}-.{2}$"), "DATE(YYYY-MM-DD)")
        .when(F.contains(value, F.lit(" - ")), "CODE/CATEGORY")
        .otherwise("STRING")
    )


def value_classes(df: DataFrame) -> DataFrame:
    """Cells per column and class."""
    return (
        cells(df)
        .groupBy("column_name", value_class(F.col("value")).alias("value_class"))
        .agg(F.count("*").alias("cells"))
    )


def _histogram(df: DataFrame) -> DataFrame:
    return cells(df).groupBy("column_name", "value").agg(F.count("*").alias("n"))


def _digest_histogram(df: DataFrame) -> DataFrame:
    """Rows per distinct value; long values are told apart by length and SHA-256.

    Whole documents then never enter the shuffle.
    """
    value, chars = F.col("value"), F.char_length("value").cast("bigint")
    key = F.when(chars > LONG_VALUE, F.sha2(value, 256)).otherwise(value)
    return cells(df).groupBy("column_name", chars.alias("chars"), key.alias("value")).agg(F.count("*").alias("n"))


def column_profile(df: DataFrame, tokens=LOAD_NULLS, any_case: bool = False, exact: bool = True) -> DataFrame:
    """Rows, nulls, null share, distinct values and widest value per column.

    The exact form counts equal values inside each task before anything is
    shuffled, so a value that fills a third of a column costs one row per
    task. ``exact=False`` keeps one sketch per column instead and never
    shuffles values.
    """
    value = F.col("value")
    if exact:
        source = _digest_histogram(df)
    else:
        source = cells(df).withColumns(
            {"n": F.lit(1).cast("bigint"), "chars": F.char_length(value).cast("bigint")}
        )
    distinct = F.count("value") if exact else F.approx_count_distinct("value")
    return (
        source.groupBy("column_name")
        .agg(
            F.sum("n").alias("row_count"),
            F.sum(F.when(is_null_token(value, tokens, any_case), F.col("n")).otherwise(F.lit(0))).alias("null_count"),
            distinct.alias("distinct_count"),
            F.max("chars").alias("max_width"),
        )
        .withColumn("null_pct", F.round(F.col("null_count") * 100 / F.col("row_count"), 1))
    )


def sample_values(df: DataFrame, count: int = 5) -> DataFrame:
    """Most frequent values per column; the limit applies before the shuffle."""
    order = Window.partitionBy("column_name").orderBy(F.col("n").desc(), F.col("value"))
    return (
        _histogram(df)
        .filter(F.col("value").isNotNull())
        .withColumn("rank", F.row_number().over(order).cast("bigint"))
        .filter(F.col("rank") <= count)
    )


def date_format_profile(df: DataFrame) -> DataFrame:
    """Matches of each date spelling per column, and whether spellings are mixed."""
    v = strip(F.col("value"))
    kind = None
    for name, pattern in DATE_PATTERNS.items():
        kind = F.when(v.rlike(pattern), name) if kind is None else kind.when(v.rlike(pattern), name)
    counts = (
        cells(df)
        .select("column_name", kind.alias("spelling"))
        .filter(F.col("spelling").isNotNull())
        .groupBy("column_name", "spelling")
        .agg(F.count("*").alias("cells"))
    )
    per_column = Window.partitionBy("column_name")
    return counts.withColumn("mixed", F.count("*").over(per_column) > 1)


def column_names(lines: DataFrame, delimiter: str, quote: str | None = '"') -> DataFrame:
    """Names per file from a header row, or ``COLUMN_n`` where there is none."""
    line = F.col("first_line")
    parts = fields(strip(line), delimiter, quote)
    generic = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(F.lit("COLUMN_"), i.cast("string")))
    named = F.when(names_first(line, delimiter, quote), parts).otherwise(generic)
    return first_lines(lines).select("file", F.posexplode(named).alias("pos", "column_name")).select(
        "file", (F.col("pos") + 1).cast("bigint").alias("position"), "column_name"
    )


def proposed_keys(columns: list[str]) -> list[str]:
    """Known date and identifier names among the columns, three at most."""
    date = [c for c in columns if c.upper() in KEY_DATE_NAMES][:1]
    ids = [c for c in columns if c.upper() in KEY_ID_NAMES]
    return (date + ids)[:MAX_KEY_COLUMNS]


def key_candidates(df: DataFrame, candidates: list[list[str]]) -> DataFrame:
    """Measured uniqueness of each candidate key: distinct keys over rows."""
    out = None
    for keys in candidates:
        one = (
            df.groupBy(*keys)
            .agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count("*").alias("distinct_keys"))
            .select(
                F.lit(",".join(keys)).alias("key_columns"),
                F.lit(len(keys)).cast("bigint").alias("key_size"),
                "row_count",
                "distinct_keys",
                F.round(F.try_divide(F.col("distinct_keys"), F.col("row_count")), 6).alias("uniqueness"),
                (F.col("distinct_keys") == F.col("row_count")).alias("is_unique"),
            )
        )
        out = one if out is None else out.unionByName(one)
    return out


def best_key(candidates: DataFrame) -> DataFrame:
    """The smallest unique candidate."""
    return candidates.filter("is_unique").orderBy("key_size", "key_columns").limit(1)


def file_pattern(name: Column) -> Column:
    """File name with its period replaced by a placeholder; the name itself if it has none."""
    suffix = F.regexp_extract(name, r"((?:\.[^.]*)?\.gz|\.[^.]*)$", 1)
    stem = F.left(name, F.length(name) - F.length(suffix))
    as_range = F.regexp_replace(stem, r"\d{8}-\d{8}", "{date_range}")
    as_month = F.regexp_replace(stem, r"\d{4}-\d{2}", "{month}")
    as_digits = F.regexp_replace(stem, r"\d{6}", "{month}")
    pattern = (
        F.when(stem.rlike(r"\d{8}-\d{8}"), as_range)
        .when(stem.rlike(r"\d{4}-\d{2}"), as_month)
        .when(stem.rlike(r"\d{6}"), as_digits)
        .otherwise(stem)
    )
    return F.concat(pattern, suffix)


def table_name_of(name: Column) -> Column:
    """Table name from a file name: no extension, no period, no usual prefix."""
    stem = F.regexp_replace(name, r"(?:\.(?:tsv|csv|txt)\.[^.]*|\.[^.]*)$", "")
    for period in (r"_?\d{8}-\d{8}", r"_?\d{4}-\d{2}", r"_?\d{6}"):
        stem = F.regexp_replace(stem, period, "")
    return F.upper(F.regexp_replace(stem, r"(?i)^(?:fact|dim|test_|custom_)", ""))


def propose_contracts(lines: DataFrame, date_column: str | None = None, sample_lines: int | None = None) -> DataFrame:
    """One contract proposal per file pattern, from names, formats and header rows."""
    name = inventory.base_name(F.col("file"))
    formats = detect_format(lines, sample_lines=sample_lines)
    line = strip(F.col("first_line"))

    def names(delimiter: str) -> Column:
        parts = fields(line, delimiter, '"')
        generic = F.transform(
            F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(F.lit("COLUMN_"), i.cast("string"))
        )
        return F.when(names_first(line, delimiter, '"'), parts).otherwise(generic)

    described = (
        formats.join(first_lines(lines), "file")
        .withColumn("file_pattern", file_pattern(name))
        .withColumn("table_name", table_name_of(name))
        .withColumn("expected_columns", by_delimiter(F.col("delimiter"), names))
    )
    keys = F.slice(
        F.concat(
            F.slice(F.filter("expected_columns", lambda c: F.upper(c).isin(*KEY_DATE_NAMES)), 1, 1),
            F.filter("expected_columns", lambda c: F.upper(c).isin(*KEY_ID_NAMES)),
        ),
        1,
        MAX_KEY_COLUMNS,
    )
    proposal = F.struct(
        "file", "table_name", "expected_columns", F.col("format").alias("file_format"), "delimiter",
        "quote_char", keys.alias("duplicate_key_columns"),
    )
    return (
        described.groupBy("file_pattern")
        .agg(F.min_by(proposal, "file").alias("p"))
        .select("file_pattern", "p.*", F.lit(date_column).cast("string").alias("date_column"))
        .drop("file")
    )


def schema_drift(headers: DataFrame, contract: Contract) -> DataFrame:
    """Columns missing from or extra to a contract, one row per file and violation.

    ``headers`` has ``file, column_name``.
    """
    expected = F.array(*[F.lit(c.upper()) for c in contract.expected_columns])
    required = {contract.date_column, *contract.duplicate_key_columns} - {None}
    have = headers.groupBy("file").agg(F.collect_set(F.upper("column_name")).alias("have"))
    kind = lambda k: lambda c: F.struct(F.lit(k).alias("violation"), c.alias("column_name"))
    needed = F.array(*[F.lit(c.upper()) for c in sorted(required)]).cast("array<string>")
    found = F.concat(
        F.transform(F.array_except(expected, "have"), kind("missing")),
        F.transform(F.array_except("have", expected), kind("extra")),
        F.transform(F.array_except(needed, "have"), kind("required_missing")),
    )
    return have.select("file", F.inline(found))


def schema_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Table, column, type and ordinal, with the table's row count."""
    out = None
    for name, df in tables.items():
        columns = F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    F.lit(i).cast("bigint").alias("ordinal"),
                )
                for i, f in enumerate(df.schema.fields, 1)
            ]
        )
        one = df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.inline(columns)
        )
        out = one if out is None else out.unionByName(one)
    return out


def catalog_inventory(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    """Tables of that name in every database, or all tables if none has it, the first ones if a limit is asked for."""
    found = []
    for database in spark.catalog.listDatabases():
        for table in spark.catalog.listTables(database.name):
            found.append((database.name, table.name, table.name.upper() == name.upper()))
    hits = [row for row in found if row[2]] or sorted(found)[:limit]
    return spark.createDataFrame(hits, "database string, table_name string, is_match boolean")


def match_columns(contract_columns: DataFrame, table_columns: DataFrame) -> DataFrame:
    """Contract columns with the table column of the same name in any case."""
    left = contract_columns.withColumn("key", F.upper("column_name"))
    right = table_columns.select(
        F.col("table_name"), F.upper("column_name").alias("key"), F.col("column_name").alias("table_column")
    )
    return left.join(right, ["table_name", "key"], "left").select(
        "table_name", "column_name", "table_column", F.col("table_column").isNotNull().alias("found")
    )


def width_against_table(lines: DataFrame, table: DataFrame, delimiter: str = "\t") -> DataFrame:
    """First line's width against a table's, with extra or missing columns."""
    columns = len(table.columns)
    actual = F.size(F.split(F.col("first_line"), re.escape(delimiter), -1)).cast("bigint")
    return first_lines(lines).select(
        "file",
        actual.alias("file_columns"),
        F.lit(columns).cast("bigint").alias("table_columns"),
        F.greatest(actual - columns, F.lit(0)).alias("extra_columns"),
        F.greatest(F.lit(columns) - actual, F.lit(0)).alias("missing_columns"),
    )
