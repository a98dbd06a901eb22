"""Periodic runs of words, found by block convolution.

A run is a stretch of words whose smallest period is q, at least max(6, 4 q)
words long, that no neighbouring word extends. Every run with a period of B to
2 B - 1 words, B a power of two, holds a whole block of B words (blocks start
at multiples of B) whose copy stands q words further on. So at each scale B
every block is held against the 2 B words that follow it: a number-theoretic
transform gives, for each distance, the sum of squared differences of word
numbers, exactly, and a sum of zero is an occurrence. The distance and the
block are a seed, which is extended to both sides. Intervals found with a
multiple of their period as well keep the smallest.

Blocks with a word that does not stand again at any of the distances cannot
match and are left out before the transform. The sums are exact as they are
taken modulo as many primes as it needs for their product to exceed any sum.
Extension compares prefix sums by bisection and then the words themselves.

Documents are worked on many at once, as one line of words in which different
documents share no word number. Null, empty and blank texts have no words and
no runs; a text of any length is one row and stays in one task. Repeated rows
and null ids come back as they are; other columns are ignored, whatever their
names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import keyed, let, ship, unkeyed, words_of

# Primes with 2^25 roots of unity or more, and a primitive root of each.
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))
LEAST_LENGTH, LEAST_EXPONENT = 6, 4
# Words of several documents that are looked through at once, and numbers that are transformed at once.
WORDS_AT_ONCE = 1 << 18
NUMBERS_AT_ONCE = 1 << 18
_HASH_PRIME, _HASH_BASE = 2147483629, 1103515245


def powers(base: int, count: int, prime: int) -> np.ndarray:
    """``base`` to the powers 0 to ``count`` - 1 modulo the prime."""
    out = np.ones(1, np.uint64)
    step = base % prime
    while len(out) < count:
        out = np.concatenate((out, out * np.uint64(step) % np.uint64(prime)))
        step = step * step % prime
    return out[:count]


def transform(a: np.ndarray, prime: int, root: int, back: bool = False) -> np.ndarray:
    """The transform of each column; its rows come in bit-reversed order, which the way back takes."""
    size, many = a.shape
    p = np.uint64(prime)
    turn = pow(root, (prime - 1) // size, prime)
    w = powers(pow(turn, -1, prime) if back else turn, max(size // 2, 1), prime)
    half = 1 if back else size // 2
    while 0 < half < size:
        pair = a.reshape(size // (2 * half), 2, half, many)
        factor = w[:: size // (2 * half)][:half, None]
        x, y = pair[:, 0], pair[:, 1]
        out = np.empty_like(pair)
        if back:
            y = y * factor % p
            out[:, 0], out[:, 1] = (x + y) % p, (x + p - y) % p
        else:
            out[:, 0], out[:, 1] = (x + y) % p, (x + p - y) * factor % p
        a = out.reshape(size, many)
        half = half * 2 if back else half // 2
    return a * np.uint64(pow(size, -1, prime)) % p if back else a


def squared_differences(blocks: np.ndarray, windows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """For each column: sums over i of (block[i] - window[i + e])^2 modulo the prime, e from 0 to the block's length - 1."""
    size = len(blocks)
    p = np.uint64(prime)
    x, y = blocks % p, windows % p
    turned = np.zeros_like(y)
    turned[0], turned[size + 1 :] = x[0], x[:0:-1]
    product = transform(turned, prime, root) * transform(y, prime, root) % p
    cross = transform(product, prime, root, back=True)[:size]
    sums = np.zeros((2 * size + 1, y.shape[1]), np.uint64)
    np.cumsum(y * y % p, axis=0, out=sums[1:])
    own = (x * x % p).sum(axis=0) + (sums[size : 2 * size] - sums[:size])
    return (own + np.uint64(2) * (p - cross)) % p


class _Line:
    """A line of word numbers, with what answers where a word stands again and how far two places agree."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.n = ids, len(ids)
        self.keys = np.sort(ids * self.n + np.arange(self.n)) if self.n else ids
        _, numbers, counts = np.unique(ids, return_inverse=True, return_counts=True)
        # Words that stand once match nothing, so they need no number of their own.
        again = np.flatnonzero(counts > 1)
        number = np.zeros(len(counts), np.uint64)
        number[again] = np.arange(1, len(again) + 1)
        self.values = number[numbers]
        self.most = len(again)
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        weights = (mixed >> np.uint64(33)) % np.uint64(_HASH_PRIME)
        self.power = powers(_HASH_BASE, self.n + 1, _HASH_PRIME)
        self.prefix = np.zeros(self.n + 1, np.uint64)
        np.cumsum(weights * self.power[: self.n] % np.uint64(_HASH_PRIME), out=self.prefix[1:])
        self.prefix %= np.uint64(_HASH_PRIME)

    def again(self, at: np.ndarray, near: int) -> np.ndarray:
        """Whether the word at each place stands again ``near`` to 2 ``near`` - 1 words later."""
        want = self.ids[at] * self.n + np.minimum(at + near, self.n)
        found = np.searchsorted(self.keys, want)
        inside = found < self.n
        key = self.keys[np.where(inside, found, 0)]
        return inside & (at + near < self.n) & (key - self.ids[at] * self.n < at + 2 * near)

    def same(self, i: np.ndarray, d: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Whether ``m`` words from i and from i + d seem equal."""
        p = np.uint64(_HASH_PRIME)
        near = (self.prefix[i + m] + p - self.prefix[i]) % p
        far = (self.prefix[i + d + m] + p - self.prefix[i + d]) % p
        return near * self.power[d] % p == far

    def reach(self, i: np.ndarray, d: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from i on (or before i) equal those d further on."""
        low = np.zeros(len(i), np.int64)
        high = self.n - i - d if forward else i.copy()
        while (open_ := low < high).any():
            mid = np.where(open_, (low + high + 1) // 2, low)
            good = self.same(i if forward else i - mid, d, mid)
            low, high = np.where(good, mid, low), np.where(open_ & ~good, mid - 1, high)
        return low


def _occurrences(line: _Line, size: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks of ``size`` words and distances of ``size`` to 2 ``size`` - 1 at which they stand again.

    ``known`` has the furthest end of the runs found so far over each word. A block that lies with all its copies in a
    run of smaller period only stands again at multiples of that period, so it tells nothing new.
    """
    starts = np.arange(0, line.n - 2 * size + 1, size)
    starts = starts[known[starts] < np.minimum(starts + 3 * size - 1, line.n)]
    for inside in (0, size - 1, size // 2):
        starts = starts[line.again(starts + inside, size)]
    many = max(NUMBERS_AT_ONCE // (2 * size), 1)
    primes, product = [], 1
    while product <= size * line.most**2:
        primes.append(PRIMES[len(primes)])
        product *= primes[-1][0]
    found = []
    padded = np.concatenate((line.values, np.zeros(2 * size, np.uint64)))
    for k in range(0, len(starts), many):
        some = starts[k : k + many]
        whole = some[:, None] + np.arange(size)
        keep = line.again(whole.ravel(), size).reshape(whole.shape).all(axis=1)
        some = some[keep]
        if len(some) == 0:
            continue
        blocks = padded[some + np.arange(size)[:, None]]
        windows = padded[some + np.arange(size, 3 * size)[:, None]]
        zero = np.ones(blocks.shape, bool)
        for prime, root in primes:
            zero &= squared_differences(blocks, windows, prime, root) == 0
        e, column = np.nonzero(zero)
        found.append(np.stack((some[column], e + size)))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at, d = np.concatenate(found, axis=1)
    return at, d


def find_runs(ids: np.ndarray) -> np.ndarray:
    """Rows of start, length and period of every run in a line of word numbers, by start and period."""
    line = _Line(ids.astype(np.int64))
    found = []
    known = np.zeros(line.n, np.int64)
    size = 1
    while LEAST_EXPONENT * size <= line.n:
        at, d = _occurrences(line, size, known)
        # A block whose predecessor has the same distance belongs to its interval.
        key = d * (line.n + 1) + at
        first = ~np.isin(key - size, key)
        at, d = at[first], d[first]
        after, before = line.reach(at, d, True), line.reach(at, d, False)
        start, length = at - before, before + after + d
        long = length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * d)
        for s, n, q in set(zip(start[long].tolist(), length[long].tolist(), d[long].tolist(), strict=True)):
            if not (ids[s : s + n - q] == ids[s + q : s + n]).all():
                raise ArithmeticError("prefix sums of different words agree")
            found.append((s, n, q))
            np.maximum(known[s : s + n], s + n, out=known[s : s + n])
        size *= 2
    smallest: dict[tuple[int, int], int] = {}
    for s, n, q in found:
        smallest[s, n] = min(q, smallest.get((s, n), q))
    rows = sorted((s, q, n) for (s, n), q in smallest.items())
    return np.array([(s, n, q) for s, q, n in rows], np.int64).reshape(-1, 3)


def _collapsed(words: list[bytes], runs: np.ndarray) -> str:
    if len(runs):
        keep = np.ones(len(words), bool)
        for start, length, period in runs.tolist():
            keep[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def _line_of(texts: list[list[bytes]]) -> np.ndarray:
    """Word numbers of several texts in one line; texts share no number."""
    numbers: list[int] = []
    base = 0
    for words in texts:
        own: dict[bytes, int] = {}
        numbers.extend([own.setdefault(w, base + len(own)) for w in words])
        base += len(own)
    return np.array(numbers, np.int64)


def _told(ids: list, texts: list[list[bytes]]) -> pd.DataFrame:
    runs = find_runs(_line_of(texts))
    ends = np.cumsum([len(w) for w in texts])
    owner = np.searchsorted(ends, runs[:, 0], side="right")
    starts = ends - np.array([len(w) for w in texts])
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    rows = []
    for k, words in enumerate(texts):
        own = runs[cuts[k] : cuts[k + 1]] - np.array([starts[k], 0, 0])
        listed = [{"start": s, "length": n, "period": q} for s, n, q in own.tolist()]
        rows.append((ids[k], listed, _collapsed(words, own)))
    return pd.DataFrame(rows, columns=["id", "runs", "collapsed"])


RUN = "struct<start: bigint, length: bigint, period: bigint>"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each document its ``runs`` by start and period, and ``collapsed``, the text without the repeats.

    ``collapsed`` has the words that no run holds after its first period, joined by one blank.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts, words = [], [], 0
            for key, text in zip(batch["id"], batch["text"], strict=True):
                # Bytes are parted at exactly the six white space characters of ASCII.
                ids.append(key)
                texts.append(text.encode("utf-8", "surrogatepass").split() if text is not None else [])
                words += len(texts[-1])
                if words >= WORDS_AT_ONCE:
                    yield _told(ids, texts)
                    ids, texts, words = [], [], 0
            if ids:
                yield _told(ids, texts)

    made = keyed(docs, id_col, text=text_col).mapInPandas(run, f"id string, runs array<{RUN}>, collapsed string")
    return unkeyed(made, docs, id_col)


def digests(found: DataFrame) -> DataFrame:
    """Counts, the greatest run and digests in place of the runs and texts of ``periodic_runs``."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    start, length, period = -best["col2"], best["length"], -best["col3"]
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    rendered = F.array_join(F.transform("runs", line), "")
    kept = [c for c in found.columns if c not in ("runs", "collapsed")]
    return found.select(
        *kept,
        F.size("runs").cast("bigint").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.sha2(rendered, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).withColumn("exponent_milli", F.expr("1000L * length div period"))


def with_planted_period(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents of which every tenth, by the CRC of its id, repeats some of its words to the end.

    With h the CRC-32 of the id in digits and g = floor(h / 10), a text of n words is changed if h is a multiple of 10:
    word i >= a becomes word a + (i - a) mod p, where a = g mod n and p = 1 + floor((n - a) / (3 + g mod 8)). Its words
    are then parted by single blanks. Rows without an id stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("int")
        place = lambda i, s: F.when(i < s["a"], i).otherwise(s["a"] + F.pmod(i - s["a"], s["p"]))
        told = F.struct(words.alias("w"), a.alias("a"), p.alias("p"))
        return let(told, lambda s: F.array_join(F.transform(s["w"], lambda x, i: F.get(s["w"], place(i, s))), " "))

    words = words_of(F.col(text_col))
    changed = let(words, lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.col(text_col)))
    return docs.withColumn(text_col, F.when(F.pmod(h, F.lit(10)) == 0, changed).otherwise(F.col(text_col)))
