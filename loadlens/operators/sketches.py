"""Column profiles as sketches that can be stored and added up.

A part's sketch of a column has its rows, nulls, least and greatest value, a
HyperLogLog sketch of its different values and, for numbers, a KLL sketch of
their quantiles. All columns of all parts are sketched in one scan, combined
inside the tasks before anything is shuffled. Sketches of any parts can be
united later without the table: per file, per month, or over a range of either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DISTINCT_LOG, QUANTILE_K = 14, 400
# Relative deviation of the distinct count, and error of a quantile's rank, that sketches of these sizes stay within.
DISTINCT_BOUND, RANK_BOUND = 0.04, 0.02

SKETCH = (
    "column_name string, row_count bigint, null_count bigint, low string, high string, low_number double, high_number double, "
    "distinct binary, quantiles binary"
)


def _sketch(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    number = column.cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")
    # Numbers that are no number have no rank and no order.
    number = F.when(F.isnan(number), None).otherwise(number)
    text = F.base64(column) if isinstance(kind, T.BinaryType) else column.cast("string")
    return F.struct(
        F.lit(name).alias("column_name"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(column.isNull()).alias("null_count"),
        F.min(text).alias("low"), F.max(text).alias("high"),
        F.min(number).alias("low_number"), F.max(number).alias("high_number"),
        F.hll_sketch_agg(text, DISTINCT_LOG).alias("distinct"),
        F.kll_sketch_agg_double(number, QUANTILE_K).alias("quantiles"),
    )


def column_sketches(df: DataFrame, *parts: Column, columns: list[str] | None = None) -> DataFrame:
    """One row per part and column; ``parts`` are named columns that tell the parts apart."""
    names = columns or df.columns
    grouped = df.groupBy(*parts).agg(F.array(*[_sketch(df, c) for c in names]).alias("_s"))
    return grouped.select(*[c for c in grouped.columns if c != "_s"], F.inline("_s"))


def united(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches of the same column added up, for each value of ``by``."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("low_number").alias("low_number"), F.max("high_number").alias("high_number"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def profile_of(sketches: DataFrame, shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """What united sketches say of each column: counts, estimated different values, extremes, quantiles of numbers.

    Counts and extremes are exact. Extremes of texts are by bytes; columns without numbers have no quantiles.
    """
    have = F.col("low_number").isNotNull()
    at = lambda s: F.kll_sketch_get_quantile_double("quantiles", F.lit(float(s)))
    return sketches.select(
        *[c for c in sketches.columns if c not in ("distinct", "quantiles")],
        F.hll_sketch_estimate("distinct").alias("distinct_estimate"),
        F.when(have, F.array(*[at(s) for s in shares])).alias("quantile_estimates"),
    )
