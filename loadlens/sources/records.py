"""Records whose quoted cells hold line feeds, cut in parallel.

Whether a line begins a record depends on every quote before it in its file.
As a quote only toggles between inside and outside, what a split does to that
state is known from its quotes' parity alone: one aggregation gives the parity
of each split, a prefix over a file's splits gives the state each one starts
in, and then every split finds its own records. A record that goes on in the
next splits is put together from the at most two pieces that each split has of
it. No file is one task, whatever its size; a split's lines are sorted once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.text import occurrences
from loadlens.sources.lines import pin_splits


def split_states(lines: DataFrame, quote: str) -> DataFrame:
    """For each split of a file its number of lines, those before it, and whether it starts and ends inside quotes."""
    per_split = lines.groupBy("file", "block").agg(
        F.sum(occurrences(F.col("value"), quote)).alias("quotes"), F.count("*").alias("split_lines")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("quotes").over(before), F.lit(0))
    odd = lambda n: n % 2 == 1
    return per_split.select(
        "file", "block", "split_lines",
        F.coalesce(F.sum("split_lines").over(before), F.lit(0)).alias("lines_before"),
        odd(earlier).alias("starts_open"),
        odd(earlier + F.col("quotes")).alias("ends_open"),
    )


def _text(lines: Column) -> Column:
    """Lines gathered as (order, value) put together in order."""
    return F.array_join(F.transform(F.array_sort(lines), lambda x: x["value"]), "\n")


def quoted_records(lines: DataFrame, quote: str = '"') -> DataFrame:
    """A lines DataFrame with one row per record: ``value`` is the record, ``line_no`` the line it begins on.

    ``block`` and ``seq`` are those of its first line, so records keep their order in the file. A quote that is never
    closed makes the rest of the file one record, as it does for any reader.
    """
    if "line_no" not in lines.columns:
        pin_splits(lines.sparkSession)
    whole_file = Window.partitionBy("file", "block")
    here = whole_file.orderBy("seq")
    earlier = here.rowsBetween(Window.unboundedPreceding, -1)
    quotes = occurrences(F.col("value"), quote)
    passed = F.coalesce(F.sum("_q").over(earlier), F.lit(0)) + F.col("starts_open").cast("int")
    lost = F.raise_error(F.lit("files were split differently by two scans")).cast("bigint")
    counted = F.when(F.count("*").over(whole_file) == F.col("split_lines"), F.col("lines_before")).otherwise(lost)
    marked = (
        lines.select("file", "file_size", "block", "seq", "value", quotes.alias("_q"))
        .join(split_states(lines, quote), ["file", "block"])
        .select("*", (passed % 2 == 0).alias("begins"), (counted + F.row_number().over(here)).alias("line_no"))
        .withColumn("record", F.sum(F.col("begins").cast("int")).over(here))
    )
    pieces = (
        marked.groupBy("file", "block", "record")
        .agg(
            F.min("seq").alias("seq"),
            F.min("line_no").alias("line_no"),
            F.max("file_size").alias("file_size"),
            F.any_value("ends_open").alias("ends_open"),
            _text(F.collect_list(F.struct("seq", "value"))).alias("value"),
        )
        .withColumn("last", F.col("record") == F.max("record").over(whole_file))
    )
    # Record 0 of a split is what it has of a record begun before it.
    partial = (F.col("record") == 0) | (F.col("last") & F.col("ends_open"))
    columns = ["file", "file_size", "block", "seq", "line_no", "value"]
    in_file = Window.partitionBy("file").orderBy("block", "record")
    owner = F.sum((F.col("record") > 0).cast("int")).over(in_file)
    joined = (
        pieces.filter(partial)
        .withColumn("owner", owner)
        .groupBy("file", "owner")
        .agg(
            F.max("file_size").alias("file_size"),
            F.min("block").alias("block"),
            F.min_by("seq", "line_no").alias("seq"),
            F.min("line_no").alias("line_no"),
            _text(F.collect_list(F.struct("line_no", "value"))).alias("value"),
        )
    )
    return pieces.filter(~partial).select(*columns).unionByName(joined.select(*columns))
