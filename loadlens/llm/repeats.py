"""Removal of byte strings that stand more than once in a corpus, by merged Burrows-Wheeler transforms.

A window is ``LENGTH`` bytes of a text. Windows that start in two places, in
one text or two, are repeated, and every byte they cover is removed; all are
judged on the input. The corpus is cut up so that equal windows meet:

1. A window's anchor is its seed (``SEED`` bytes) of least hash, which depends
   on the window's bytes alone. Seeds that anchor in one place only are dropped.
2. The windows of a kept anchor are grouped by their offset to it, ``GROUP``
   offsets a group. All windows of a group contain the same *core* around the
   anchor, so the core's digest is the key that equal windows share, and what
   tells windows apart are the up to ``GROUP - 1`` bytes at either *side*.
3. Under each key the different pairs of sides become strings of left bytes,
   one symbol for the core, and right bytes. Each part of a task's strings is
   a shard with its own Burrows-Wheeler transform; ``bwt.merge`` interleaves the
   shards, and intervals of suffixes with a common prefix of ``GROUP`` symbols
   are windows that stand more than once. Equal strings are one with a weight.
4. The spans found go back to their texts.

Equal texts are folded into one before step 2 and all lose what the text loses. An anchor
that over ``HOT`` texts hold is not gathered: its windows are keyed by their
whole digest and counted, with partial counts in each task.

Null and empty texts have no bytes. Texts are told apart by SHA-256, so ids
may repeat, be null or of any type, and a text of any length is one cell. Other
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.bwt import MOST_SUFFIXES, Shard, intervals, merge
from loadlens.llm.common import ship, written

LENGTH, SEED, GROUP = 200, 64, 16
HOT = 100_000
# Rows of strings that are merged at once, and shards they are cut into.
STRINGS_AT_ONCE, SHARDS = 8192, 4
_BASE = 0x9E3779B97F4A7C15
_PLACE = (1 << 31) - 1


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    step = base
    while len(out) < count:
        out = np.concatenate((out, out * np.array([step], np.uint64)))
        step = step * step % (1 << 64)
    return out[:count]


class _Seeds:
    """Hashes of all seeds of a text; the powers they need are kept from text to text."""

    def __init__(self, seed: int):
        self.seed = seed
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, text: np.ndarray) -> np.ndarray:
        n = len(text)
        if len(self.up) < n:
            count = 1 << (n - 1).bit_length()
            self.up, self.down = _powers(_BASE, count), _powers(pow(_BASE, -1, 1 << 64), count)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        h = (sums[self.seed :] - sums[: -self.seed]) * self.down[: n - self.seed + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` seeds the place of the one with the least hash, the first of equals."""
    ranked = (hashes & ~np.uint64(_PLACE)) | np.arange(len(hashes), dtype=np.uint64)
    padded = np.concatenate((ranked, np.full(-len(ranked) % width, ~np.uint64(0)))).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(hashes) - width + 1
    least = np.minimum(back[:count], ahead[width - 1 : width - 1 + count])
    return (least & np.uint64(_PLACE)).astype(np.int64)


def groups(text: bytes, place: np.ndarray, starts: np.ndarray, length: int, group: int) -> Iterator[tuple[bytes, bytes, int]]:
    """Key, sides and core start of every group that holds one of the windows."""
    # Two anchors can make the same group; its windows count once.
    last = np.unique(place - (place - starts) // group * group)
    n = len(text)
    for x in last.tolist():
        low, high = x - group + 1, x + length
        key = hashlib.blake2b(text[x : low + length], digest_size=12).digest()
        left, right = text[max(low, 0) : x], text[low + length : min(high, n)]
        yield key, bytes((len(left),)) + left + right, x


def repeated_windows(strings: list[tuple[int, bytes, int]], group: int) -> list[tuple[int, int] | None]:
    """For strings of (key number, sides, weight) the least and greatest number of left bytes of a repeated window."""
    length, side = 2 * group - 1, group - 1
    sides = [s[1] for s in strings]
    have_left = np.array([s[0] for s in sides])
    have_right = np.array([len(s) - 1 for s in sides]) - have_left
    padded = b"".join(s[1 : 1 + s[0]].rjust(side, b"\0") + s[1 + s[0] :].ljust(side, b"\0") for s in sides)
    letters = np.frombuffer(padded, np.uint8).reshape(len(strings), 2 * side).astype(np.uint16) + 2
    symbols = np.empty((len(strings), length), np.uint16)
    symbols[:, :side], symbols[:, group:] = letters[:, :side], letters[:, side:]
    # Absent bytes have a symbol of their own; windows that would need one are left out below.
    at = np.arange(side)
    symbols[:, :side][at < (side - have_left)[:, None]] = 1
    symbols[:, group:][at >= have_right[:, None]] = 1
    symbols[:, side] = 258 + np.array([s[0] for s in strings])
    step = min(-(-len(strings) // SHARDS), MOST_SUFFIXES // (length + 1))
    parts = [symbols[k : k + step] for k in range(0, len(strings), step)]
    source, suffix, common = merge([Shard(p) for p in parts], group)
    number = intervals(common, group)
    string, offset = source.astype(np.int64) * step + suffix // (length + 1), suffix % (length + 1)
    left = group - 1 - offset
    real = (left >= 0) & (left <= have_left[string]) & (group - 1 - left <= have_right[string])
    weight = np.array([s[2] for s in strings])
    total = np.bincount(number[real], weight[string[real]], minlength=number[-1] + 1)
    found = real & (total[number] >= 2)
    low, high = np.full(len(strings), group), np.full(len(strings), -1)
    np.minimum.at(low, string[found], left[found])
    np.maximum.at(high, string[found], left[found])
    return [(a, b) if b >= 0 else None for a, b in zip(low.tolist(), high.tolist(), strict=True)]


def _whole(sides: bytes, group: int) -> tuple[int, int] | None:
    """Least and greatest number of left bytes of the windows a string has."""
    left, right = sides[0], len(sides) - 1 - sides[0]
    low = max(0, group - 1 - right)
    return (low, left) if low <= left else None


def _spans(rows: pd.DataFrame, group: int, length: int) -> pd.DataFrame:
    """Spans of repeated windows of the rows of whole keys."""
    weights: dict[tuple[bytes, bytes], int] = {}
    for key, sides, places, many in zip(rows["key"], rows["sides"], rows["places"], rows["many"], strict=True):
        weights[key, sides] = weights.get((key, sides), 0) + len(places) * (2 if many else 1)
    several: dict[bytes, int] = {}
    for key, _ in weights:
        several[key] = several.get(key, 0) + 1
    found: dict[tuple[bytes, bytes], tuple[int, int] | None] = {}
    strings, told = [], []
    number: dict[bytes, int] = {}

    def settle() -> None:
        if strings:
            found.update(zip(told, repeated_windows(strings, group), strict=True))
            strings.clear(), told.clear(), number.clear()

    for (key, sides), weight in sorted(weights.items()):
        if weight > 1:
            found[key, sides] = _whole(sides, group)
        if several[key] > 1:
            if key not in number and (len(strings) >= STRINGS_AT_ONCE or len(number) >= 65_000):
                settle()
            if weight == 1 or found[key, sides] is not None:
                number.setdefault(key, len(number))
                strings.append((number[key], sides, min(weight, 2)))
                told.append((key, sides))
    settle()
    out = []
    for key, sides, text, many, places in zip(*(rows[c] for c in ("key", "sides", "text", "many", "places")), strict=True):
        span = found.get((key, sides))
        if span and not many:
            out.extend((text, x - span[1], x - span[0] + length) for x in places)
    return pd.DataFrame(out, columns=["digest", "start", "end"])


def _merged(batches: Iterator[pd.DataFrame], group: int, length: int) -> Iterator[pd.DataFrame]:
    """Spans of rows that come sorted by key; a key's rows are looked at together."""
    held: list[pd.DataFrame] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += len(batch)
        if count >= 2 * STRINGS_AT_ONCE:
            rows = pd.concat(held, ignore_index=True)
            keys = rows["key"]
            cut = int((keys != keys.iloc[-1]).sum())
            if cut:
                yield _spans(rows.iloc[:cut], group, length)
            held = [rows.iloc[cut:]]
            count = len(rows) - cut
    if held:
        yield _spans(pd.concat(held, ignore_index=True), group, length)


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans joined where they overlap or touch."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _folded(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """``digest``, compressed ``body`` and ``many`` (held by several rows) of every different text of enough bytes."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["body"] = [zlib.compress(_bytes(t), 1) for t in batch["body"]]
            yield batch

    long = docs.filter(F.octet_length(text_col) >= length)
    rows = long.select(_digest(text_col), F.col(text_col).alias("body")).mapInPandas(pack, "digest binary, body binary")
    return rows.groupBy("digest").agg(F.first("body").alias("body"), (F.count("*") > 1).alias("many"))


def _digest(text_col: str):
    return F.unhex(F.left(F.sha2(F.col(text_col), 256), F.lit(32))).alias("digest")


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH, seed: int = SEED, group: int = GROUP) -> DataFrame:
    """For every different text of ``length`` bytes or more: digest, ``body``, ``many`` and the list of repeated spans.

    ``body`` is the text's UTF-8, compressed by zlib. Texts that several rows hold have no list, as all of them goes.
    """
    ship(docs.sparkSession)
    width = length - seed + 1

    def anchored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = _Seeds(seed)
        for batch in batches:
            out = []
            for digest, text in zip(batch["digest"], batch["text"], strict=True):
                hashes = hasher.of(np.frombuffer(_bytes(text), np.uint8))
                own, times = np.unique(hashes[np.unique(anchors(hashes, width))].view(np.int64), return_counts=True)
                out.append(pd.DataFrame({"h": own, "digest": [digest] * len(own), "twice": times > 1}))
            if out:
                yield pd.concat(out, ignore_index=True)

    long = docs.filter(F.octet_length(text_col) >= length).select(_digest(text_col), F.col(text_col).alias("text"))
    all_anchors = written(long.mapInPandas(anchored, "h long, digest binary, twice boolean"), "anchors")
    counted = all_anchors.groupBy("h").agg(F.count("*").alias("n"), F.max("twice").alias("twice"))
    kept = counted.filter((F.col("n") > 1) | F.col("twice")).select("h", (F.col("n") > HOT).alias("hot"))
    shared = written(all_anchors.select("h", "digest").join(kept, "h"), "shared-anchors")

    def windows(batches: Iterator[pd.DataFrame], hot: bool) -> Iterator[pd.DataFrame]:
        hasher = _Seeds(seed)
        size = 1 if hot else group
        for batch in batches:
            out = []
            for digest, body, many, wanted in zip(batch["digest"], batch["body"], batch["many"], batch["hs"], strict=True):
                text = zlib.decompress(body)
                hashes = hasher.of(np.frombuffer(text, np.uint8))
                place = anchors(hashes, width)
                starts = np.flatnonzero(np.isin(hashes[place].view(np.int64), wanted))
                found: dict[tuple[bytes, bytes], list[int]] = {}
                for key, sides, x in groups(text, place[starts], starts, length, size):
                    found.setdefault((key, sides), []).append(x)
                out.extend((key, sides, digest, many, places) for (key, sides), places in found.items())
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=["key", "sides", "text", "many", "places"])
                    out = []
            if out:
                yield pd.DataFrame(out, columns=["key", "sides", "text", "many", "places"])

    texts = _folded(docs, text_col, length)
    schema = "key binary, sides binary, text binary, many boolean, places array<int>"
    span = "digest binary, start int, end int"

    def cut(hot: bool) -> DataFrame:
        own = shared.filter(F.col("hot") == hot).groupBy("digest").agg(F.collect_set("h").alias("hs"))
        return texts.join(own, "digest").mapInPandas(lambda b: windows(b, hot), schema)

    sorted_ = cut(False).repartition("key").sortWithinPartitions("key")
    spans = sorted_.mapInPandas(lambda b: _merged(b, group, length), span)
    if not shared.filter("hot").isEmpty():
        rows = cut(True)
        counts = rows.groupBy("key").agg(F.sum(F.size("places") * F.when(F.col("many"), 2).otherwise(1)).alias("n"))
        again = rows.join(counts.filter("n > 1").select("key"), "key").select("text", F.explode("places").alias("start"))
        spans = spans.unionByName(again.select(F.col("text").alias("digest"), "start", (F.col("start") + length).alias("end")))
    listed = spans.groupBy("digest").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return texts.join(listed, "digest", "left")


def _rest(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row for each row: the id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept``, the bytes left.

    ``kept`` may end or begin inside a character, so it is binary; it is null for texts that lose nothing.
    """
    found = repeated_spans(docs, text_col, length)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for digest, body, many, spans in zip(batch["digest"], batch["body"], batch["many"], batch["spans"], strict=True):
                text = zlib.decompress(body)
                pairs = [(0, len(text))] if many else united([(s["start"], s["end"]) for s in spans] if spans is not None else [])
                if pairs:
                    out.append((digest, sum(b - a for a, b in pairs), len(pairs), _rest(text, pairs)))
            if out:
                yield pd.DataFrame(out, columns=["digest", "n_removed", "n_spans", "kept"])

    lost = found.mapInPandas(run, "digest binary, n_removed long, n_spans long, kept binary")
    lost = lost.withColumn("rest_sha256", F.sha2("kept", 256))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col), F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("text_sha256"), _digest(text_col)
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    rest = F.coalesce("rest_sha256", "text_sha256").alias("kept_sha256")
    return rows.join(lost, "digest", "left").select(id_col, "n_bytes", zero("n_removed"), zero("n_spans"), rest, "kept")
