"""Delimiter, header and format detection over a lines DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.functions.text import DELIMITERS, fields, is_digits, is_number, occurrences, strip
from loadlens.sources.inventory import base_name, extension
from loadlens.sources.lines import first_lines, head_lines

# What a file's extension says about it.
EXTENSION_FORMATS = {".csv": ("CSV", ","), ".tsv": ("TSV", "\t")}
EXTENSION_CONFIDENCE = 0.9
FALLBACK_CONFIDENCE = 0.3
COMMON_BONUS = 1.2

# Words that mark a header row.
HEADER_KEYWORDS = (
    "id", "name", "date", "time", "count", "amount", "value", "type", "status", "description",
)


def _sample(lines: DataFrame, sample_lines: int | None) -> DataFrame:
    return lines if sample_lines is None else head_lines(lines, sample_lines)


def delimiter_scores(lines: DataFrame, sample_lines: int | None = None) -> DataFrame:
    """Per file and separator: least count, mean, variance and score.

    Only separators found on every line score. One aggregation per file with
    five sets of moments, so no line is duplicated and the shuffle carries one
    row per file and task.
    """
    sums = []
    for i, d in enumerate(DELIMITERS):
        n = occurrences(F.col("value"), d).cast("bigint")
        sums += [
            F.min(n).alias(f"lo{i}"),
            F.sum(n).alias(f"s{i}"),
            F.sum(n * n).alias(f"q{i}"),
        ]
    moments = _sample(lines, sample_lines).groupBy("file").agg(F.count("*").alias("lines"), *sums)
    per_delimiter = F.array(
        *[
            F.struct(
                F.lit(d).alias("delimiter"),
                F.lit(i).alias("rank"),
                F.col(f"lo{i}").alias("min_count"),
                F.col(f"s{i}").alias("total"),
                F.col(f"q{i}").alias("squares"),
                F.lit(COMMON_BONUS if d in (",", "\t") else 1.0).alias("bonus"),
            )
            for i, d in enumerate(DELIMITERS)
        ]
    )
    # Exact integer arithmetic until the last division keeps equal columns at variance 0.
    spread = F.col("lines") * F.col("squares") - F.col("total") * F.col("total")
    return (
        moments.select("file", "lines", F.inline(per_delimiter))
        .filter(F.col("min_count") > 0)
        .withColumn("mean_count", F.col("total") / F.col("lines"))
        .withColumn("variance", spread / (F.col("lines") * F.col("lines")))
        .withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.col("variance")) * F.col("bonus"))
        .drop("total", "squares", "bonus")
    )


def detect_delimiter(lines: DataFrame, sample_lines: int | None = None) -> DataFrame:
    """Best separator per file; ties go to the first in the fixed order."""
    best = F.struct(F.col("score"), (-F.col("rank")).alias("preference"))
    return (
        delimiter_scores(lines, sample_lines)
        .groupBy("file")
        .agg(F.max_by("delimiter", best).alias("delimiter"), F.max("score").alias("score"))
        .select("file", "delimiter", F.least(F.col("score"), F.lit(1.0)).alias("confidence"))
    )


def validate_delimiter(lines: DataFrame, delimiter: str, sample_lines: int | None = None) -> DataFrame:
    """Is the separator on every line, with variance below the mean?"""
    n = occurrences(F.col("value"), delimiter)
    return (
        _sample(lines, sample_lines)
        .groupBy("file")
        .agg(F.min(n).alias("min_count"), F.avg(n).alias("mean_count"), F.var_pop(n).alias("variance"))
        .withColumn("valid", (F.col("min_count") > 0) & (F.col("variance") < F.col("mean_count")))
    )


def has_text_field(line: Column, delimiter: str, quote: str | None = '"') -> Column:
    """Header test A: some field of the line is not a number."""
    stripped = strip(line)
    return F.when(F.length(stripped) == 0, F.lit(False)).otherwise(
        F.exists(fields(stripped, delimiter, quote), lambda f: ~is_number(f))
    )


def looks_like_name(field: Column) -> Column:
    """Does not start with a digit, and is a name rather than a date."""
    return F.when(field.rlike(r"^[0-9]"), F.lit(False)).otherwise(F.lit(True))


def looks_like_sampled_name(field: Column) -> Column:
    """Stricter form: not empty, no leading digit, not a number."""
    return (
        F.when((F.length(field) == 0) | field.rlike(r"^[0-9]"), F.lit(False))
        .when(F.contains(field, F.lit("_")), F.lit(True))
        .when(field.rlike("[A-Za-z]") & (field == F.upper(field)), F.lit(True))
        .otherwise(~is_number(field))
    )


def names_first(line: Column, delimiter: str, quote: str | None = '"', strict: bool = False) -> Column:
    """Header test B: the first five fields all look like names."""
    test = looks_like_sampled_name if strict else looks_like_name
    return F.forall(F.slice(fields(strip(line), delimiter, quote), 1, 5), test)


def mostly_text(line: Column, delimiter: str) -> Column:
    """Header test C: over 70 % of fields not numeric, or more than two keyword hits."""
    cells = fields(strip(line), delimiter)
    bare = lambda f: F.replace(F.replace(strip(f), F.lit("."), F.lit("")), F.lit("-"), F.lit(""))
    texts = F.size(F.filter(cells, lambda f: ~is_digits(bare(f))))
    words = "|".join(HEADER_KEYWORDS)
    hits = F.size(F.filter(cells, lambda f: F.lower(f).rlike(words)))
    return F.when(F.length(strip(line)) == 0, F.lit(False)).otherwise(
        (texts > F.size(cells) * 0.7) | (hits > 2)
    )


def by_delimiter(delimiter: Column, build) -> Column:
    """A line expression built for whichever fixed separator a row has."""
    out = None
    for d in DELIMITERS:
        branch = build(d)
        out = F.when(delimiter == d, branch) if out is None else out.when(delimiter == d, branch)
    return out


def header_tests(lines: DataFrame, delimiter: str, quote: str | None = '"') -> DataFrame:
    """The three header tests on the first line of each file."""
    line = F.col("first_line")
    return first_lines(lines).select(
        "file",
        has_text_field(line, delimiter, quote).alias("any_text"),
        names_first(line, delimiter, quote).alias("names_first"),
        mostly_text(line, delimiter).alias("mostly_text"),
    )


def detect_format(lines: DataFrame, files: DataFrame | None = None, sample_lines: int | None = None) -> DataFrame:
    """Format per file: by extension, else by content, else the fallback.

    ``files`` (with ``path``) adds files that hold no line at all.
    """
    found = first_lines(lines).join(detect_delimiter(lines, sample_lines), "file", "left")
    if files is not None:
        found = files.select(F.col("path").alias("file")).join(found, "file", "left")
    ext = extension(base_name(F.col("file").cast("string")))
    ext_format = ext_delimiter = F.lit(None).cast("string")
    for suffix, (fmt, sep) in EXTENSION_FORMATS.items():
        ext_format = F.when(ext == suffix, fmt).otherwise(ext_format)
        ext_delimiter = F.when(ext == suffix, sep).otherwise(ext_delimiter)
    named, sniffed = ext_format.isNotNull(), F.col("delimiter").isNotNull()
    sep = F.coalesce(ext_delimiter, F.col("delimiter"), F.lit(","))
    fmt = F.coalesce(ext_format, F.when(F.col("delimiter") == "\t", "TSV").otherwise("CSV"))
    return found.select(
        "file",
        fmt.alias("format"),
        sep.alias("delimiter"),
        F.coalesce(
            (named | sniffed) & by_delimiter(sep, lambda d: has_text_field(F.col("first_line"), d)),
            F.lit(False),
        ).alias("has_header"),
        F.when(fmt == "CSV", '"').alias("quote_char"),
        F.when(named, F.lit(EXTENSION_CONFIDENCE))
        .when(sniffed, F.col("confidence"))
        .otherwise(F.lit(FALLBACK_CONFIDENCE))
        .alias("confidence"),
        F.when(named, "extension").when(sniffed, "content").otherwise("fallback").alias("method"),
    )
