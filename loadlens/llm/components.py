"""Connected components of an edge table, by alternating large and small stars.

The edges are rewired until every vertex points at the smallest vertex of its
component. Each round is two aggregations and two joins and is written to the
shared folder, so lineage stays short and a lost executor costs one round.
Nothing is collected but two numbers that tell whether a round changed the
edges. A vertex with very many edges makes one large join partition with one
row on the other side, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``vertex``, ``component`` for every vertex of the edges ``a``, ``b``; the component is its smallest vertex."""
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = written(now, "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lower = large.filter("u > v").distinct()
        roots = lower.groupBy("u").agg(F.min("v").alias("m"))
        small = lower.join(roots, "u")
        now = written(
            small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
            .filter("u > v").distinct(),
            "edges",
        )
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("v").alias("vertex"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(roots).distinct()
