"""File listings: inventory, period discovery, contract matching, periods from names.

An inventory is a DataFrame with ``path, length, modification_time``. The
operators below only read those columns, so any table of file names will do.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.contracts import Contract
from loadlens.functions import dates

SORT_KEYS = ("name", "size", "date", "type")
_RANGE = r"(\d{8})-(\d{8})"
_MONTH = r"(\d{4})-(\d{2})"


def file_inventory(
    spark: SparkSession, folder: str, glob: str | None = None, with_empty: bool = True
) -> DataFrame:
    """Every file under a folder, named as the text reader names it; contents are never read.

    A scan skips files of zero bytes. They are added from the list of names
    that Spark's own listing has already put on the driver, with no time of
    change; ``with_empty=False`` asks for files with contents only.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found = reader.load(folder)
    files = found.select(
        F.col("_metadata.file_path").alias("path"),
        "length",
        F.col("modificationTime").alias("modification_time"),
    )
    if not with_empty:
        return files
    # Local files are listed with three slashes and read with one.
    names = spark.createDataFrame([(re.sub("^file:/+", "file:/", n),) for n in found.inputFiles()], "path string")
    empty = names.join(files, "path", "left_anti")
    return files.unionByName(
        empty.select(
            "path", F.lit(0).cast("bigint").alias("length"), F.lit(None).cast("timestamp").alias("modification_time")
        )
    )


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(name: Column) -> Column:
    """Lower-case suffix, looking through ``.gz``."""
    return F.regexp_extract(F.lower(name), r"(\.[^./]+?)(?:\.gz)?$", 1)


def sort_inventory(files: DataFrame, by: str = "name", descending: bool = False) -> DataFrame:
    name = F.lower(base_name(F.col("path")))
    keys = {
        "name": [name],
        "size": [F.col("length")],
        "date": [F.col("modification_time")],
        "type": [F.regexp_extract(name, r"(\.[^.]*)$", 1), name],
    }[by if by in SORT_KEYS else "name"]
    order = [k.desc() if descending else k.asc() for k in keys]
    return files.orderBy(*order, F.col("path").asc())


def filter_inventory(files: DataFrame, text: str) -> DataFrame:
    """Names that contain every term of the text, in any case."""
    name = F.lower(base_name(F.col("path")))
    keep = F.lit(True)
    for term in text.lower().split():
        keep = keep & F.contains(name, F.lit(term))
    return files.filter(keep)


def listing_summary(files: DataFrame, pattern: str | None = None) -> DataFrame:
    """File count, total bytes and newest file of a landing folder."""
    if pattern:
        files = files.filter(F.col("path").rlike(pattern))
    return files.agg(
        F.count("*").alias("file_count"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
        F.max("modification_time").alias("newest"),
        F.max_by("path", F.struct("modification_time", "path")).alias("newest_path"),
    )


def month_files(files: DataFrame, contracts: list[Contract], month: str) -> DataFrame:
    """Files of one month for every contract, over all known extensions."""
    name = base_name(F.col("path"))
    hits = [
        F.when(
            name.rlike(rx),
            F.struct(F.lit(c.table_name).alias("table_name"), F.lit(c.file_pattern).alias("file_pattern")),
        )
        for c in contracts
        if (rx := c.month_file_regex(month))
    ]
    if not hits:
        raise ValueError("no contract has a period in its file pattern")
    first, last = dates.month_range(month)
    return (
        files.withColumn("hit", F.explode(F.array_compact(F.array(*hits))))
        .select("path", "length", "hit.table_name", "hit.file_pattern")
        .withColumn("period_start", F.lit(first))
        .withColumn("period_end", F.lit(last))
    )


def match_contracts(files: DataFrame, contracts: list[Contract], keep_unmatched: bool = False) -> DataFrame:
    """Every (file, contract) pair whose name pattern fits, with the captured period.

    Contracts are configuration held by the driver, so they become an array of
    conditions in one projection: no join and no shuffle, whatever the number
    of files.
    """
    name = base_name(F.col("path"))
    hits = [
        F.when(
            name.rlike(c.regex),
            F.struct(
                F.lit(c.file_pattern).alias("file_pattern"),
                F.lit(c.table_name).alias("table_name"),
                F.lit(c.period_kind).cast("string").alias("period_kind"),
                (
                    F.regexp_extract(name, c.regex, 1) if c.period_kind else F.lit(None).cast("string")
                ).alias("period"),
            ),
        )
        for c in contracts
    ]
    explode = F.explode_outer if keep_unmatched else F.explode
    return files.withColumn("hit", explode(F.array_compact(F.array(*hits)))).select(
        "path",
        "length",
        F.col("hit.file_pattern").alias("file_pattern"),
        F.col("hit.table_name").alias("table_name"),
        F.col("hit.period_kind").alias("period_kind"),
        F.col("hit.period").alias("period"),
        F.col("hit").isNotNull().alias("matched"),
    )


def contract_candidates(files: DataFrame, contracts: list[Contract]) -> DataFrame:
    """The (file, contract) pairs of which the name begins and ends as the pattern does.

    Patterns are indexed by their literal ends. A name is looked up once for
    each pair of lengths that the ends have, by a hash join, so the pairs made
    follow the matches and not files times contracts. Contracts are rows, which
    Spark broadcasts if they prove small.
    """
    rows = [(*c.literal_ends, c.regex, c.file_pattern, c.table_name, c.period_kind) for c in contracts]
    index = files.sparkSession.createDataFrame(
        rows, "head string, tail string, _regex string, file_pattern string, table_name string, period_kind string"
    )
    shapes = sorted({(len(head), len(tail)) for head, tail, *_ in rows})
    stem = F.regexp_replace("_name", r"\.gz$", "")
    ends = [
        F.struct(F.substring(stem, 1, head).alias("head"), (F.substring(stem, -tail, tail) if tail else F.lit("")).alias("tail"))
        for head, tail in shapes
    ]
    named = files.select("path", "length", base_name(F.col("path")).alias("_name"))
    none = F.array().cast("array<struct<head:string,tail:string>>")
    keys = named.withColumn("_end", F.explode(F.array_distinct(F.array(*ends)) if ends else none))
    return keys.select("path", "length", "_name", "_end.head", "_end.tail").join(index, ["head", "tail"]).drop("head", "tail")


def match_many_contracts(files: DataFrame, contracts: list[Contract], keep_unmatched: bool = False) -> DataFrame:
    """The rows of ``match_contracts`` for thousands of contracts: expressions are tried on candidates only.

    With ``keep_unmatched`` the listing is read twice, and rows are told apart by their path.
    """
    hits = (
        contract_candidates(files, contracts)
        .filter(F.expr("_name RLIKE _regex"))
        .select(
            "path", "length", "file_pattern", "table_name", "period_kind",
            F.when(F.col("period_kind").isNotNull(), F.expr("regexp_extract(_name, _regex, 1)")).alias("period"),
            F.lit(True).alias("matched"),
        )
    )
    if not keep_unmatched:
        return hits
    rest = files.join(hits.select("path").distinct(), "path", "left_anti").select(
        "path", "length", *[F.lit(None).cast("string").alias(c) for c in ("file_pattern", "table_name", "period_kind", "period")],
        F.lit(False).alias("matched"),
    )
    return hits.unionByName(rest)


def period_from_name(path: Column) -> tuple[Column, Column]:
    """First and last day from ``YYYYMMDD-YYYYMMDD``, else from ``YYYY-MM``, else null."""
    name = base_name(path)
    compact = lambda i: dates.parse_file_date(F.regexp_extract(name, _RANGE, i))
    month = F.regexp_extract(name, rf"({_MONTH})", 1)
    is_range = name.rlike(_RANGE)
    start = F.when(is_range, compact(1)).otherwise(dates.month_start(month))
    end = F.when(is_range, compact(2)).otherwise(dates.month_end(month))
    return start, end


def with_period(files: DataFrame) -> DataFrame:
    start, end = period_from_name(F.col("path"))
    return files.withColumn("period_start", start).withColumn("period_end", end)


def normal_month(folder: Column) -> Column:
    """``MMYYYY`` or ``YYYY-MM`` folder names as ``YYYY-MM``; null for anything else."""
    return F.when(folder.rlike(r"^\d{4}-\d{2}$"), folder).when(
        folder.rlike(r"^\d{6}$"), F.regexp_replace(folder, r"^(\d{2})(\d{4})$", "$2-$1")
    )


def period_of_path(path: Column) -> Column:
    """Month from the file's folder, with or without a ``key=`` prefix."""
    folder = F.element_at(F.split(path, "/"), -2)
    return normal_month(F.regexp_replace(folder, r"^[^=]*=", ""))


def month_folders(files: DataFrame) -> DataFrame:
    """Months found as folder names, with file count and bytes."""
    return (
        files.withColumn("period", period_of_path(F.col("path")))
        .filter(F.col("period").isNotNull())
        .groupBy("period")
        .agg(F.count("*").alias("file_count"), F.sum("length").alias("total_bytes"))
    )
