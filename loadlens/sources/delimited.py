"""Delimited scan with the fixed load dialect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions.text import LOAD_NULLS, fields, is_number, null_if, occurrences
from loadlens.sources.lines import read_lines
from loadlens.sources.records import quoted_records

DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
RAGGED = "_ragged_line"
SOURCE = "_source_file"
OPEN_QUOTE = "_open_quote"

# Types whose text must read as a number; Spark's own cast would also take a Java suffix such as 12d.
_NUMERIC = ("tinyint", "smallint", "int", "integer", "bigint", "float", "real", "double", "decimal")


def string_schema(columns, ragged: bool = False) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in columns]
    if ragged:
        fields.append(T.StructField(RAGGED, T.StringType()))
    return T.StructType(fields)


def scan_options(
    delimiter: str, quote: str | None, header: bool, encoding: str | None, ragged: bool, multiline: bool = False
) -> dict:
    """Reader options: short rows padded, long rows cut, doubled quotes, no escapes.

    Lines end in line feeds only, unless records may span lines.
    """
    options = {
        "sep": delimiter,
        "quote": quote or "\u0000",
        "escape": quote or "\u0000",
        "header": str(header).lower(),
        "mode": "PERMISSIVE",
        "enforceSchema": "true",
    }
    if multiline:
        options["multiLine"] = "true"
    else:
        options["lineSep"] = "\n"
    if encoding:
        options["encoding"] = encoding
    if ragged:
        options["columnNameOfCorruptRecord"] = RAGGED
    return options


def without_cr(value: Column) -> Column:
    """A line, or the last cell of one, without the carriage return that ends it."""
    return F.when(value.endswith("\r"), F.left(value, F.char_length(value) - 1)).otherwise(value)


def _split_scan(
    lines: DataFrame, columns, delimiter: str, quote: str | None, ragged: bool, flag_open: bool
) -> DataFrame:
    """Text columns cut out of raw lines, by the same rules as the file checks.

    Blank lines are rows, every byte is kept, and a line whose quotes do not
    pair up fails the scan, or is flagged: its record goes on in the next line.
    """
    line = without_cr(F.col("value"))
    unpaired = occurrences(line, quote) % 2 != 0 if quote else F.lit(False)
    if quote and not flag_open:
        open_quote = F.raise_error(F.concat(F.lit("a quote is not closed on its line: "), F.left(line, F.lit(200))))
        line = F.when(unpaired, open_quote.cast("string")).otherwise(line)
    lines = lines.select("file", line.alias("value"), unpaired.alias(OPEN_QUOTE))
    cut = lines.select("file", "value", OPEN_QUOTE, fields(F.col("value"), delimiter, quote).alias("_cells"))
    cells = [F.try_element_at("_cells", F.lit(i)).alias(c) for i, c in enumerate(columns, 1)]
    out = [F.when(F.size("_cells") != len(cells), F.col("value")).alias(RAGGED)] if ragged else []
    return cut.select(*cells, *out, F.col("file").alias(SOURCE), OPEN_QUOTE)


def read_records(spark: SparkSession, paths, quote: str, header: bool = False) -> DataFrame:
    """Records that may span lines as a lines DataFrame, without blank ones and without a header."""
    records = quoted_records(read_lines(spark, paths), quote).filter(without_cr(F.col("value")) != "")
    if not header:
        return records
    first = Window.partitionBy("file", "block")
    return records.withColumn("_first", F.min("seq").over(first)).filter("block > 0 OR seq > _first").drop("_first")


def scan_delimited(
    spark: SparkSession,
    paths: str | list[str],
    columns,
    delimiter: str = "\t",
    quote: str | None = '"',
    header: bool = False,
    encoding: str | None = None,
    null_tokens=LOAD_NULLS,
    keep_raw: bool = False,
    flag_ragged: bool = False,
    with_source: bool = False,
    multiline: bool = False,
    flag_open: bool = False,
) -> DataFrame:
    """All columns as text, null tokens applied unless ``keep_raw``.

    Compressed files are read through their extension's codec; a broken
    archive fails the job. ``multiline`` lets a quoted cell hold line feeds;
    records are then cut in parallel and blank ones skipped. Files of single
    lines with a header, or in another encoding, go through the CSV reader,
    which skips blank lines; in another encoding a file with records over
    several lines is one task. ``flag_open`` tells lines with an open quote apart
    instead of failing.
    """
    last = columns[-1]
    spanning = multiline and quote and not encoding
    if (header and not spanning) or encoding:
        options = scan_options(delimiter, quote, header, encoding, flag_ragged, multiline)
        df = (
            spark.read.schema(string_schema(columns, flag_ragged))
            .options(**options)
            .option("recursiveFileLookup", "true")
            .csv(paths)
            .withColumns({SOURCE: F.col("_metadata.file_path"), OPEN_QUOTE: F.lit(False)})
        )
        cell = lambda c: without_cr(F.col(f"`{c}`")) if c == last and not multiline else F.col(f"`{c}`")
    else:
        lines = read_records(spark, paths, quote, header) if spanning else read_lines(spark, paths)
        df = _split_scan(lines, columns, delimiter, quote, flag_ragged, flag_open)
        cell = lambda c: F.col(f"`{c}`")
    out = [(cell(c) if keep_raw else null_if(cell(c), null_tokens)).alias(c) for c in columns]
    if flag_ragged:
        out.append(F.col(RAGGED))
    if with_source:
        out.append(F.col(SOURCE))
    if flag_open:
        out.append(F.col(OPEN_QUOTE))
    return df.select(*out)


def typed(value: Column, dtype: str, strict: bool) -> Column:
    """A text cell in its declared type.

    Bad values come out null, or, if strict, raise and so fail the load
    whatever the session's ANSI setting is.
    """
    kind = dtype.lower()
    if kind in ("string", "varchar"):
        return value
    if kind == "date":
        made = F.try_to_timestamp(value, F.lit(DATE_FORMAT)).cast("date")
    elif kind in ("timestamp", "timestamp_ntz"):
        made = F.try_to_timestamp(value, F.lit(TIMESTAMP_FORMAT)).cast(kind)
    else:
        made = value.try_cast(dtype)
        if kind.split("(")[0] in _NUMERIC:
            made = F.when(is_number(value), made)
    if not strict:
        return made
    message = F.concat(F.lit(f"not a {kind}: "), value)
    return F.when(value.isNull() | made.isNotNull(), made).otherwise(F.raise_error(message).cast(kind))


def apply_types(df: DataFrame, types: dict[str, str], strict: bool = True) -> DataFrame:
    return df.withColumns({c: typed(F.col(c), t, strict) for c, t in types.items() if c in df.columns})


def bad_cells(df: DataFrame, types: dict[str, str]) -> Column:
    """Names of the columns whose text does not fit the declared type."""
    checks = [
        F.when(F.col(c).isNotNull() & typed(F.col(c), t, strict=False).isNull(), F.lit(c))
        for c, t in types.items()
        if c in df.columns
    ]
    empty = F.array().cast("array<string>")
    return F.array_compact(F.array(*checks)) if checks else empty
