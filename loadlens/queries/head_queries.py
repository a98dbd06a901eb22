"""Queries that open every file of a landing folder but read only its first lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.operators import sniff, structure
from loadlens.queries import query, table
from loadlens.queries.file_queries import month_landing
from loadlens.session import scratch
from loadlens.sources import heads, inventory, lines

_NUMBERS = ("o_orderkey", "o_custkey", "o_totalprice")
_SEPARATORS = (",", ";", "|")


def headed_landing(spark, folder) -> str:
    """Orders as one file a month: the separator follows from the month, and every second month has a header line."""
    target = scratch(spark, "orders-headed")
    rows = table(spark, folder, "orders").filter("o_orderdate IS NOT NULL")
    month, period = F.month("o_orderdate"), F.date_format("o_orderdate", "yyyy-MM")
    parted = rows.select(*_NUMBERS, period.alias("period"), month.alias("m")).repartition("period")
    ordered = parted.sortWithinPartitions("period", "o_orderkey", "o_custkey", "o_totalprice")
    place = lambda parts: F.element_at(F.array(*parts), F.pmod("m", F.lit(3)) + 1)
    cells = [F.col(c).cast("string") for c in _NUMBERS]
    body, header = place([F.concat_ws(s, *cells) for s in _SEPARATORS]), place([F.lit(s.join(_NUMBERS)) for s in _SEPARATORS])
    # A month is in one task, sorted, so its first row is where the month differs from the row before.
    numbered = ordered.withColumn("at", F.monotonically_increasing_id())
    least = numbered.groupBy("period").agg(F.min("at").alias("least"))
    lined = numbered.join(least, "period").withColumn("first", (F.col("at") == F.col("least")) & (F.pmod("m", F.lit(2)) == 0))
    out = lined.repartition("period").sortWithinPartitions("period", "at")
    value = F.explode(F.when(F.col("first"), F.array(header, body)).otherwise(F.array(body)))
    out.select("period", value.alias("value")).write.partitionBy("period").text(target)
    return target


_RANKED = """
ranked AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS period, month(o_orderdate) AS m, o_orderkey, o_custkey, o_totalprice,
         row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_orderkey, o_custkey, o_totalprice) AS r
  FROM orders WHERE o_orderdate IS NOT NULL)"""
_SEPARATOR = "CASE m % 3 WHEN 0 THEN ',' WHEN 1 THEN ';' ELSE '|' END"


def _period():
    return inventory.period_of_path(F.col("file")).alias("period")


@query(
    "file_heads",
    f"""WITH {_RANKED} SELECT period, r + (m % 2 = 0)::INT AS line_no, o_orderkey FROM ranked WHERE r + (m % 2 = 0)::INT <= 5
    UNION ALL SELECT DISTINCT period, 1, NULL FROM ranked WHERE m % 2 = 0""",
)
def file_heads(spark, folder):
    """The first five lines of every file, of which the order key is told."""
    head = heads.read_heads(spark, headed_landing(spark, folder), 5)
    key = F.regexp_extract("value", r"^(\d+)[,;|]", 1)
    return head.select(_period(), F.col("line_no").cast("bigint").alias("line_no"), F.when(key != "", key).cast("bigint").alias("o_orderkey"))


@query(
    "file_head_formats",
    f"""WITH {_RANKED} SELECT DISTINCT period, 'CSV' AS format, {_SEPARATOR} AS delimiter, m % 2 = 0 AS has_header, 'content' AS method FROM ranked""",
)
def file_head_formats(spark, folder):
    """Separator and header of every file, from its first 50 lines."""
    found = sniff.detect_format(heads.read_heads(spark, headed_landing(spark, folder), 50), sample_lines=50)
    return found.select(_period(), "format", "delimiter", "has_header", "method")


@query(
    "file_head_columns",
    f"""WITH {_RANKED}, named AS (SELECT DISTINCT period FROM ranked WHERE m % 6 = 0)
    SELECT period, unnest([1, 2, 3]) AS column_no, unnest(['o_orderkey', 'o_custkey', 'o_totalprice']) AS column_name FROM named""",
)
def file_head_columns(spark, folder):
    """Column names of the comma-separated files that have a header."""
    head = heads.read_heads(spark, headed_landing(spark, folder), 1)
    # Months that are even and have commas, by the first line itself.
    named = head.filter(sniff.has_text_field(F.col("value"), ",") & F.contains("value", F.lit(",")))
    cells = F.posexplode(F.split("first_line", ",")).alias("pos", "column_name")
    return lines.first_lines(named).select("file", cells).select(_period(), (F.col("pos") + 1).alias("column_no"), "column_name")


@query(
    "schema_width_heads",
    f"""WITH {_RANKED} SELECT DISTINCT period, 3 AS actual_columns, true AS as_whole_files FROM ranked WHERE m % 3 = 0""",
)
def schema_width_heads(spark, folder):
    """Width of the first line, read from the head and by a full scan."""
    landing = headed_landing(spark, folder)
    width = lambda x: x.select(_period(), structure.width(",").alias("w"))
    head = width(heads.read_heads(spark, landing, 1))
    whole = width(lines.first_lines(lines.read_lines(spark, landing)).withColumnRenamed("first_line", "value"))
    both = head.join(whole.select("period", F.col("w").alias("whole")), "period")
    return both.filter("w > 1 OR whole > 1").select(
        "period", F.col("w").cast("int").alias("actual_columns"), (F.col("w") == F.col("whole")).alias("as_whole_files")
    )


@query(
    "row_estimate",
    """SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS row_count, true AS plain_near, true AS packed_near
    FROM orders GROUP BY 1""",
)
def row_estimate(spark, folder):
    """Rows of each month, and whether estimates from 2 kB of each plain and each packed file come within a fifth (or five)."""
    rows = None
    for name, codec in (("plain", None), ("packed", "gzip")):
        landing = month_landing(spark, folder, codec)
        told = heads.estimated_rows(heads.read_samples(spark, landing, 2048))
        guess = told.groupBy(_period()).agg(F.sum("estimated_rows").alias("guess"))
        if rows is None:
            counted = structure.row_counts(lines.read_lines(spark, landing)).groupBy(_period())
            rows = counted.agg(F.sum("row_count").alias("row_count"))
        off = F.abs(F.col("guess") - F.col("row_count"))
        near = off <= F.greatest(F.col("row_count") / 5, F.lit(5))
        rows = rows.join(guess, "period").withColumn(f"{name}_near", near).drop("guess")
    return rows
