"""Minimal keys against every set of columns counted one by one."""

import random
from itertools import combinations

import pytest
from conftest import rows

from loadlens.operators import keys
from loadlens.operators.keys import key_lattice, minimal_keys


def keys_by_force(data, columns, most):
    unique = []
    for size in range(1, most + 1):
        for s in combinations(range(len(columns)), size):
            if not any(set(k) <= set(s) for k in unique) and len({tuple(r[i] for i in s) for r in data}) == len(data):
                unique.append(s)
    return sorted(",".join(columns[i] for i in k) for k in unique)


@pytest.mark.parametrize("seed", range(3))
def test_keys_are_those_of_brute_force(spark, seed):
    r = random.Random(seed)
    columns = ["a", "b.c", "d", "e", "f"]
    spread = [r.choice([3, 8, 20, 60, 400]) for _ in columns]
    data = list({tuple(None if r.random() < 0.05 else r.randrange(s) for s in spread) for _ in range(150)})
    df = spark.createDataFrame(data, ", ".join(f"`{c}` long" for c in columns)).coalesce(2)
    got = sorted(x["key_columns"] for x in minimal_keys(df).collect())
    assert got == keys_by_force(data, columns, 3)


def test_few_sets_are_counted(spark):
    i = "id"
    df = spark.range(20_000).selectExpr(f"{i} AS k", f"{i} % 200 AS a", f"{i} DIV 200 AS b", f"{i} % 7 AS c", f"{i} % 11 AS d", "1 AS e")
    found = key_lattice(df)
    assert found.keys == [("k",), ("a", "b")]
    # One scan of sketches and one of counts a size at most; most sets never get to a count.
    assert found.scans <= 6 and found.counted <= 3 and found.rows == 20_000


def test_no_rows_and_one_row(spark):
    assert rows(minimal_keys(spark.createDataFrame([], "a long, b long"))) == [("a", 1), ("b", 1)]
    assert rows(minimal_keys(spark.createDataFrame([(None, 1)], "a long, b long"))) == [("a", 1), ("b", 1)]
    assert minimal_keys(spark.createDataFrame([(1, 2), (1, 2)], "a long, b long")).count() == 0


def test_near_keys_are_told_from_a_part_of_the_rows(spark):
    r = random.Random(5)
    columns = ["a", "b", "c", "d", "e", "f"]
    spread = [6_000, 5_000, 4_000, 300, 50, 7]
    data = [tuple(None if r.random() < 0.01 else r.randrange(s) for s in spread) for _ in range(12_000)]
    df = spark.createDataFrame(data, ", ".join(f"{c} long" for c in columns)).coalesce(2)
    found = key_lattice(df)
    assert sorted(",".join(k) for k in found.keys) == keys_by_force(data, columns, 3)
    # Most sets have nearly as many values as there are rows, so no sketch rules them out; few of them are counted over all rows.
    assert found.sketched == len(columns) and found.tried >= 15 and found.counted <= 20 < len(list(combinations(columns, 3))) + 15


def test_hashes_that_meet_are_settled_by_values(spark, monkeypatch):
    data = [(k, k % 50, k // 50, 0.0 if k else -0.0, None if k % 2 else 1.5) for k in range(1_000)]
    df = spark.createDataFrame(data, "k long, a long, b long, z double, n double").coalesce(2)
    sets = [("k",), ("a", "b"), ("z",), ("a", "n"), ("k", "n")]
    assert keys._all_unique(df, sets) == [True, True, False, False, True]
    assert not any(keys._all_unique(df.filter("k < 2"), [("z",)]))
    real = keys._hashed
    monkeypatch.setattr(keys, "_hashed", lambda df, s: real(df, s) % 8)
    assert keys._all_unique(df, sets) == [True, True, False, False, True]
