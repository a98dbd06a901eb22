"""Discovery of minimal keys: the smallest sets of columns that no two rows share.

Sets are looked at by size. A set above a key is not minimal and is left out,
and so is one that cannot be a key: its values cannot be more than the product
of its columns' values, which sketches (HyperLogLog) tell. Two rows that share
a set's values share those of each of its columns, so all rows with some of a
column's values hold every such pair that has these. Sets that two of those
rows share are no keys; they are told from a small part of the rows. What is
left is counted over all rows, the sets of a size in one scan through grouping
sets.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations
from math import prod
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.session import literal_frame

# The sketch's size (2^14 places), its relative deviation, and how many of these a set must fall short by to be ruled out.
SKETCH_LOG, DEVIATION, SHORT_BY = 14, 0.0083, 8
# Sketches of one scan, and grouping sets of one: each row is dealt out once for each of those.
SKETCHES_AT_ONCE, SETS_AT_ONCE = 256, 64
# Sets are tried on the rows with one in so many of a column's values, then on more of them; of fewer rows all are counted at once.
PARTS, LEAST_ROWS = (256, 16), 10_000

Columns = tuple[str, ...]


@dataclass
class Lattice:
    """What a discovery found and what it cost."""

    rows: int = 0
    keys: list[Columns] = field(default_factory=list)
    sketched: int = 0
    tried: int = 0
    counted: int = 0
    scans: int = 0


def _chunks(items: list, size: int) -> list[list]:
    return [items[k : k + size] for k in range(0, len(items), size)]


def _hashed(df: DataFrame, columns: Columns) -> Column:
    """A hash of the columns that is the same where grouping takes the values as equal.

    Hashing passes over nulls, so each column's nulls are hashed as a column of their own; both zeros are one value.
    """
    kinds = dict(df.dtypes)
    value = lambda c: F.col(f"`{c}`") + F.lit(0.0) if kinds[c] in ("float", "double") else F.col(f"`{c}`")
    return F.xxhash64(*[x for c in columns for x in (value(c), F.col(f"`{c}`").isNull())])


def _sketched(df: DataFrame, sets: list[Columns]) -> list[int]:
    """Estimated number of different values of each set, nulls being equal, and last the number of rows."""
    made = [F.hll_sketch_estimate(F.hll_sketch_agg(_hashed(df, s), SKETCH_LOG)) for s in sets]
    return list(df.agg(*[m.alias(f"s{k}") for k, m in enumerate(made)], F.count(F.lit(1)).alias("n")).first())


def _unique(df: DataFrame, sets: list[Columns]) -> list[bool]:
    """Whether no two rows share a set's values, nulls being equal."""
    used = [c for c in df.columns if any(c in s for s in sets)]
    at = {c: k for k, c in enumerate(used)}
    plain = df.select(*[F.col(f"`{c}`").alias(f"c{at[c]}") for c in used])
    names = [f"c{k}" for k in range(len(used))]
    grouped = plain.groupingSets([[f"c{at[c]}" for c in s] for s in sets], *names)
    largest = grouped.agg(F.grouping_id().alias("set"), F.count(F.lit(1)).alias("n")).groupBy("set").agg(F.max("n").alias("n"))
    found = {r["set"]: r["n"] for r in largest.collect()}
    # A column's bit is set where it does not take part; the first column has the highest one.
    bits = lambda s: sum(1 << (len(used) - 1 - at[c]) for c in used if c not in s)
    return [found.get(bits(s), 0) <= 1 for s in sets]


def _all_unique(df: DataFrame, sets: list[Columns]) -> list[bool]:
    """As ``_unique``, with hashes dealt out in place of the values: a hash that no two rows have rules out equal values.

    Of a set whose hashes recur the rows with these are grouped by their values.
    """
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("set"), _hashed(df, s).alias("h")) for i, s in enumerate(sets)])).alias("x")
    again = df.select(each).groupBy("x.set", "x.h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = {r["set"]: r["h"] for r in again.groupBy("set").agg(F.min("h").alias("h")).collect()}
    out = [i not in found for i in range(len(sets))]
    if found:
        # One hash that recurs settles nearly every set; where its rows have different values all of the set's rows are counted.
        some = df.filter(reduce(or_, [_hashed(df, sets[i]) == F.lit(h) for i, h in found.items()]))
        unsettled = [i for i, good in zip(found, _unique(some, [sets[i] for i in found]), strict=True) if good]
        for i, good in zip(unsettled, _unique(df, [sets[i] for i in unsettled]) if unsettled else [], strict=True):
            out[i] = good
    return out


def _shared(df: DataFrame, sets: list[Columns], column: str, part: int) -> list[bool]:
    """Whether two rows with one in ``part`` of the column's values share a set's values; each set has the column."""
    some = df.filter(F.pmod(_hashed(df, (column,)), F.lit(part)) == 0)
    return [not good for good in _unique(some, sets)]


def key_lattice(df: DataFrame, columns: list[str] | None = None, most: int = 3) -> Lattice:
    """All minimal keys of up to ``most`` columns.

    A key is ruled out by sketches only if their estimates are more than eight deviations short of the rows, so an error
    of a sketch would have to be that large for a key to be missed. A table of at most one row has every column as key.
    """
    columns = list(columns or df.columns)
    out = Lattice()
    values: dict[str, float] = {}
    least = 1 - SHORT_BY * DEVIATION
    for some in _chunks([(c,) for c in columns], SKETCHES_AT_ONCE):
        *counts, out.rows = _sketched(df, some)
        out.scans += 1
        values.update({c: n for (c,), n in zip(some, counts, strict=True)})
    out.sketched = len(columns)
    for size in range(1, most + 1):
        sets = [s for s in combinations(columns, size) if not any(set(k) <= set(s) for k in out.keys)]
        # Each factor is an estimate from above, as estimates may fall short themselves.
        likely = [s for s in sets if prod(values[c] for c in s) >= least**size * out.rows]
        for part in PARTS if out.rows > LEAST_ROWS else ():
            by: dict[str, list[Columns]] = {}
            for s in likely:
                # Of the column with the most values a part of the values has about as large a part of the rows.
                by.setdefault(max(s, key=lambda c: values[c]), []).append(s)
            for column, own in by.items():
                for some in _chunks(own, SETS_AT_ONCE) if values[column] > 2 * part else ():
                    gone = {s for s, found in zip(some, _shared(df, some, column, part), strict=True) if found}
                    likely = [s for s in likely if s not in gone]
                    out.scans += 1
                    out.tried += len(some)
        for some in _chunks(likely, SETS_AT_ONCE):
            out.keys += [s for s, good in zip(some, _all_unique(df, some), strict=True) if good]
            out.scans += 1
        out.counted += len(likely)
    return out


def minimal_keys(df: DataFrame, columns: list[str] | None = None, most: int = 3) -> DataFrame:
    """The minimal keys as rows of ``key_columns`` (in table order) and their number."""
    found = key_lattice(df, columns, most).keys
    return literal_frame(df.sparkSession, [(",".join(k), len(k)) for k in found], "key_columns string, key_size bigint")
