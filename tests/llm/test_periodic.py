"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from loadlens.llm import periodic, queries

DOCS = "doc_id long, text string"


def runs_by_force(words):
    longest = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > s and i + q - s >= max(6, 4 * q):
                longest.setdefault((s, i + q - s), q)
            i += i == s
    return sorted((s, q, n) for (s, n), q in longest.items())


def test_transform_sums_are_exact():
    r = np.random.default_rng(1)
    for size in (1, 2, 8, 32):
        blocks = r.integers(0, 1 << 18, (size, 5)).astype(np.uint64)
        windows = r.integers(0, 1 << 18, (2 * size, 5)).astype(np.uint64)
        for prime, root in periodic.PRIMES:
            got = periodic.squared_differences(blocks, windows, prime, root)
            for e in range(size):
                apart = blocks.astype(object) - windows[e : e + size].astype(object)
                assert ((apart**2).sum(axis=0) % prime == got[e]).all()


def test_runs_are_those_of_brute_force():
    r = random.Random(5)
    for _ in range(400):
        k, n = r.choice([1, 2, 2, 3, 6]), r.randint(0, 120)
        w = [r.randrange(k) for _ in range(n)]
        if n > 10 and r.random() < 0.6:
            a = r.randrange(n)
            p = 1 + (n - a) // r.randint(3, 9)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        got = [(s, q, m) for s, m, q in periodic.find_runs(np.array(w, np.int64)).tolist()]
        assert got == runs_by_force(w)


def test_long_periods_and_words_that_never_change():
    r = random.Random(6)
    w = [r.randrange(10**6) for _ in range(60_000)]
    w[1000:50_000] = [w[1000 + i % 7001] for i in range(49_000)]
    w[52_000:59_000] = [3] * 7000
    assert periodic.find_runs(np.array(w)).tolist() == [[1000, 49_000, 7001], [52_000, 7000, 1]]


def test_query_is_the_contract_s(spark, tmp_path):
    r = random.Random(7)
    texts = [None, "", " \n\t", "a", "a " * 9, "x y z " * 5, "é  ñ\u0085\n" * 8, "same words", "same words"]
    texts += [" ".join(r.choice("ab cdé ef".split()) for _ in range(r.randint(1, 90))) for _ in range(300)]
    texts += ["word3 " * 100_000, "to be or not\t" * 30_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "n " * 8), (3, "b b b b b b")]
    spark.createDataFrame(rows, DOCS).withColumns({"id": F.lit(1), "runs": F.lit("x")}).write.parquet(
        str(tmp_path / "documents.parquet")
    )
    got = [tuple(x) for x in queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path)).select(
        F.coalesce("doc_id", F.lit(-1)), "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ).collect()]
    want = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
        own = runs_by_force(w) if len(w) < 1000 else [(0, len(set(w)), len(w))]
        gone = {j for s, q, m in own for j in range(s + q, s + m)}
        best = max(((m, -s, -q) for s, q, m in own), default=None)
        best = (-best[1], best[0], -best[2], 1000 * best[0] // -best[2]) if best else (None,) * 4
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        told = "".join(f"{s},{m},{q}\n" for s, q, m in own)
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want.append((-1 if i is None else i, len(own), *best, sha(told), sha(kept)))
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_empty_table(spark):
    found = periodic.periodic_runs(spark.createDataFrame([], DOCS))
    assert found.columns == ["doc_id", "runs", "collapsed"] and found.count() == 0
