"""Writers: delimited text, compressed copies, samples, chunks, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadlens.sources import inventory, lines as raw


def render_line(df: DataFrame, delimiter: str, null_token: str = "", columns=None):
    """One text line per row; dates and timestamps in the load formats."""
    parts = []
    for field in df.schema.fields:
        if columns and field.name not in columns:
            continue
        col, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        if kind.startswith("timestamp"):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        parts.append(F.coalesce(col.cast("string"), F.lit(null_token)))
    return F.concat_ws(delimiter, *parts)


def write_delimited(
    df: DataFrame,
    path: str,
    delimiter: str = "\t",
    null_token: str = "",
    compression: str | None = None,
    partition_by: str | None = None,
) -> None:
    """Rows as plain text lines, optionally one folder per value of a column."""
    columns = [c for c in df.columns if c != partition_by]
    line = render_line(df.select(*columns), delimiter, null_token)
    keep = [partition_by] if partition_by else []
    out = df.select(*keep, line.alias("value"))
    if partition_by:
        out = out.hint("rebalance", partition_by)
    writer = out.write.option("lineSep", "\n")
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.text(path)


def _by_file(lines: DataFrame) -> DataFrame:
    """``source``, ``value`` of lines, each task's in file order, to be written with a folder per source file."""
    ordered = lines.withColumn("source", raw.source_name(F.col("file"))).sortWithinPartitions("source", *raw.ORDER)
    return ordered.select("source", "value")


def compressed_copy(spark: SparkSession, source: str, target: str, codec: str = "gzip") -> None:
    """Lines unchanged, compressed, one folder per source file; in it one file per split, in the file's order.

    Lines stay in the task that read them.
    """
    _by_file(raw.read_lines(spark, source)).write.option("lineSep", "\n").option("compression", codec).partitionBy(
        "source"
    ).text(target)


def compression_ratio(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Bytes before and after and the share saved."""

    def size(folder: str, name: str) -> DataFrame:
        files = inventory.file_inventory(spark, folder)
        data = files.filter(~inventory.base_name(F.col("path")).rlike(r"^[._]"))
        return data.select(F.lit(name).alias("side"), "length")

    sides = size(source, "source").unionByName(size(target, "target"))
    total = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("length"))), F.lit(0))
    return sides.agg(
        total("source").alias("source_bytes"),
        total("target").alias("target_bytes"),
    ).withColumn(
        "saved_pct",
        F.round(
            F.when(F.col("source_bytes") > 0, 100 - F.col("target_bytes") / F.col("source_bytes") * 100), 1
        ),
    )


def write_sample(lines: DataFrame, path: str, count: int = 1000) -> None:
    """First lines of each file as a small test file, one folder per source file."""
    head = raw.head_lines(lines, count)
    spread = head.repartitionByRange(F.col("file"), F.col("line_no"))
    _by_file(spread).write.option("lineSep", "\n").partitionBy("source").text(path)


def split_files(spark: SparkSession, source: str, target: str, lines_per_file: int) -> None:
    """Copy into chunks of at most so many lines, one folder per source file; a line is never cut."""
    _by_file(raw.read_lines(spark, source)).write.option("lineSep", "\n").option(
        "maxRecordsPerFile", lines_per_file
    ).partitionBy("source").text(target)


def split_files_by_bytes(spark: SparkSession, source: str, target: str, bytes_per_file: int) -> None:
    """Copy into chunks by size: a line goes to the chunk that its first byte falls in, and is never cut.

    A chunk has under ``bytes_per_file`` bytes before its last line. The folders are ``source=.../chunk=...`` with one
    file each. Where a line begins is told by the sizes of its split's lines and of the splits before, so no more
    than a split or a chunk is in one task.
    """
    lines = raw.read_lines(spark, source).withColumn("size", F.octet_length("value").cast("bigint") + 1)
    before = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inside = lines.withColumn("inside", F.coalesce(F.sum("size").over(before), F.lit(0)))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "block").agg(F.sum("size").alias("split_size"))
    splits = splits.select("file", "block", F.coalesce(F.sum("split_size").over(earlier), F.lit(0)).alias("ahead"))
    placed = inside.join(splits, ["file", "block"]).select(
        raw.source_name(F.col("file")).alias("source"), (F.col("ahead") + F.col("inside")).alias("at"), "value"
    )
    chunks = placed.withColumn("chunk", F.expr(f"`at` DIV {int(bytes_per_file)}")).repartition("source", "chunk")
    ordered = chunks.sortWithinPartitions("source", "chunk", "at").select("source", "chunk", "value")
    ordered.write.option("lineSep", "\n").partitionBy("source", "chunk").text(target)


def write_json_report(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_issue_text(issues: DataFrame, path: str) -> None:
    """Issue rows ``(table_name, kind, detail)`` as readable lines, grouped by table."""
    text = F.concat_ws(": ", F.col("table_name"), F.col("kind"), F.col("detail"))
    issues.orderBy("table_name", "kind", "detail").select(text.alias("value")).write.text(path)
