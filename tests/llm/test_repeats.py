"""Merged Burrows-Wheeler transforms and the removal of repeated strings against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlens.llm import bwt, queries, repeats

DOCS = "doc_id long, text string"


def test_merged_order_and_common_prefixes():
    r = np.random.default_rng(1)
    for _ in range(60):
        length = int(r.integers(1, 30))
        depth, letters = int(r.integers(1, length + 1)), int(r.integers(2, 5))
        parts = [r.integers(1, 1 + letters, (int(r.integers(1, 9)), length)).astype(np.uint16) for _ in range(int(r.integers(1, 5)))]
        shards = [bwt.Shard(x) for x in parts]
        source, suffix, common = bwt.merge(shards, depth)
        string = lambda i, x: (*parts[i][x // (length + 1)], 0)[x % (length + 1) :]  # noqa: E731, B023
        order = [tuple(map(int, string(i, x)[:depth])) for i, x in zip(source, suffix, strict=True)]
        assert order == sorted(order)
        for a, b, c in zip(order, order[1:], common[1:], strict=False):
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            assert c == n or a == b and len(a) < depth


def removed_by_force(texts, length):
    """Spans removed from each text."""
    bodies = [(t or "").encode() for t in texts]
    seen = {}
    for b in bodies:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for b in bodies:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def planted(r, count, alphabet="abcdé 日"):
    """Texts with copies, common passages cut at any place, periods, and texts near the least length."""
    new = lambda n: "".join(r.choice(alphabet) for _ in range(n))
    pool = [new(r.randint(150, 700)) for _ in range(8)]
    texts = [None, "", "short", "a" * 199, "b" * 200, "c" * 201, "xyz" * 400, "é" * 300, pool[0], pool[0]]
    for _ in range(count):
        t = ""
        for _ in range(r.randint(1, 4)):
            p = r.choice(pool)
            a = r.randint(0, len(p) // 2)
            t += new(r.randint(0, 300)) + (p[a : a + r.randint(30, 500)] if r.random() < 0.7 else "")
        if r.random() < 0.3:
            k = r.randint(0, len(t))
            t = t[:k] + "#" + t[k + 1 :]
        texts.append(t)
    return texts + r.sample(texts, 3)


@pytest.mark.parametrize("hot", [False, True])
def test_query_is_the_contract_s(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", 2 if hot else 100_000)
    texts = planted(random.Random(4), 90)
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS).withColumns({n: F.lit("x") for n in ("h", "key", "digest", "body", "kept")})
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op12_repeated_strings"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = [(i, *x) for (i, _), x in zip(rows, removed_by_force(texts, 200), strict=True)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_strings_are_merged_in_parts_and_groups_of_any_size(monkeypatch):
    """Whole keys in small parts; windows found are those of brute force."""
    monkeypatch.setattr(repeats, "STRINGS_AT_ONCE", 5)
    r = random.Random(8)
    group = 4
    for _ in range(200):
        strings = sorted(
            {(r.randint(0, 1), bytes((n,)) + bytes(r.choices(b"ab", k=n)) + bytes(r.choices(b"ab", k=r.randint(3 - n, 3)))) for n in r.choices(range(4), k=12)}
        )
        weighted = [(k, s, r.choice([1, 1, 1, 2])) for k, s in strings]
        windows = {}
        cut = lambda s, a: (s[1 + s[0] - a : 1 + s[0]], s[1 + s[0] : 1 + s[0] + group - 1 - a])
        have = lambda s: [a for a in range(group) if a <= s[0] and group - 1 - a <= len(s) - 1 - s[0]]
        for k, s, w in weighted:
            for a in have(s):
                windows[k, a, cut(s, a)] = windows.get((k, a, cut(s, a)), 0) + w
        for (k, s, _), got in zip(weighted, repeats.repeated_windows(weighted, group), strict=True):
            found = [a for a in have(s) if windows[k, a, cut(s, a)] > 1]
            assert got == ((min(found), max(found)) if found else None)


def test_long_text_and_empty_table(spark):
    rows = [(1, " " * 300_000), (2, "".join(chr(97 + i * i % 23) for i in range(200)) * 1500)]
    got = {x["doc_id"]: x for x in repeats.without_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    assert [got[k]["n_removed"] for k in (1, 2)] == [300_000, 300_000] and got[1]["kept"] == b""
    assert repeats.without_repeats(spark.createDataFrame([], DOCS)).count() == 0
