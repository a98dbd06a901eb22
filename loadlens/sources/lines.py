"""Raw lines of files, their order, and line numbers.

A *lines* DataFrame has

    file       file identity
    file_size  bytes of the file, null if compressed
    block      start byte of the split the line was read from
    seq        position inside the scan; orders lines within a split
    value      the line without its line feed

Lines of one file are ordered by ``(block, seq)``. Lines split from a text
column also have their ``line_no``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ORDER = ("block", "seq")


def read_lines(
    spark: SparkSession, paths: str | list[str], glob: str | None = None, replace_invalid: bool = False
) -> DataFrame:
    """Lines split on line feeds only, at any folder depth.

    Bytes are untouched, or, with ``replace_invalid``, those that are not UTF-8 are replaced.
    """
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    meta = F.col("_metadata")
    path = meta["file_path"]
    return reader.text(paths).select(
        path.alias("file"),
        F.when(~path.endswith(".gz"), meta["file_size"]).alias("file_size"),
        meta["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        (tolerant(F.col("value")) if replace_invalid else F.col("value")).alias("value"),
    )


def split_lines(df: DataFrame, file: str, text: str) -> DataFrame:
    """Treat each row's text as one file; a final line feed ends the last line."""
    body = F.col(text)
    trimmed = F.when(body.endswith("\n"), F.left(body, F.length(body) - 1)).otherwise(body)
    parts = F.when(F.length(body) > 0, F.split(trimmed, "\n", -1))
    return df.select(
        F.col(file).alias("file"),
        F.octet_length(body).cast("bigint").alias("file_size"),
        F.lit(0).cast("bigint").alias("block"),
        F.posexplode(parts).alias("seq", "value"),
    ).select(
        "file",
        "file_size",
        "block",
        F.col("seq").cast("bigint").alias("seq"),
        (F.col("seq") + 1).cast("bigint").alias("line_no"),
        "value",
    )


def tolerant(value: Column) -> Column:
    """Replace bytes that are not valid UTF-8."""
    return F.make_valid_utf8(value)


def source_name(file: Column) -> Column:
    """A file's path as one folder name, so that files of equal names stay apart."""
    return F.regexp_replace(F.regexp_replace(file, r"^[^/]*:/*", ""), "[/=%]", "_")


def head_lines(lines: DataFrame, count: int) -> DataFrame:
    """First lines of each file, numbered from one as ``line_no``.

    The rank limit is applied before the shuffle, so each task sends at most
    ``count`` lines per file however large the file is.
    """
    order = Window.partitionBy("file").orderBy(*ORDER)
    return lines.withColumn("line_no", F.row_number().over(order)).filter(F.col("line_no") <= count)


def first_lines(lines: DataFrame) -> DataFrame:
    """First line of each file: one row per file.

    It always lies in the split that starts at byte zero.
    """
    start = lines.filter(F.col("block") == 0)
    return start.groupBy("file").agg(F.min_by("value", "seq").alias("first_line"))


def _split_offsets(lines: DataFrame) -> DataFrame:
    splits = lines.groupBy("file", "block").agg(
        F.min("seq").alias("first_seq"), F.count("*").alias("split_lines")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select(
        "file",
        "block",
        "first_seq",
        "split_lines",
        F.coalesce(F.sum("split_lines").over(before), F.lit(0)).alias("lines_before"),
    )


def pin_splits(spark: SparkSession) -> None:
    """Make every scan of the same files cut them alike.

    Spark sizes splits by the cores it sees when a scan starts, which may
    change while executors come and go. A fixed least number of partitions
    takes that out; a setting made by the user is kept.
    """
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(max(spark.sparkContext.defaultParallelism, 1)))


def number_lines(selected: DataFrame, lines: DataFrame) -> DataFrame:
    """Add ``line_no`` (from one, per file) to some rows of a lines DataFrame.

    Only counts per split travel: they are summed in split order to give each
    split its offset, and the selected rows look theirs up. No file is ever
    gathered in one task. Lines of split texts know their number already.
    """
    if "line_no" in selected.columns:
        return selected
    pin_splits(lines.sparkSession)
    inside = F.col("seq") - F.col("first_seq") + 1
    lost = F.raise_error(F.lit("files were split differently by two scans")).cast("bigint")
    return (
        selected.join(_split_offsets(lines), ["file", "block"], "left")
        .withColumn("line_no", F.when(inside.between(1, F.col("split_lines")), F.col("lines_before") + inside).otherwise(lost))
        .drop("first_seq", "lines_before", "split_lines")
    )
