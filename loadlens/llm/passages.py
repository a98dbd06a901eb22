"""Fuzzy passages that documents share: seeds, collinear chains with gap costs, aligned ends.

1. Texts with the same words form a class; one text stands for it.
2. Each text gives its minimizers: of every ``SPAN`` consecutive k-mers of
   words the one with the least hash. Two texts that agree in ``SPAN + K - 1``
   words in a row share a seed. A seed carries a byte for each of ``REACH`` words on both sides.
   A pass over the texts finds the seeds that two of them have; another one, of the seeds that could be part of a
   passage, how far they can go on with any other text. Only seeds that could still be part of one are kept.
3. Every occurrence of a kept seed is paired with the seed's first one in the
   text of smallest id. What passages these pairs make is found. Seeds that
   are left, and close enough to others to be part of one more passage, name
   the texts of smaller id that hold them; of those pairs the ones whose common
   seeds could make up a passage are aligned by all their seeds. Of the left seeds the most frequent are not needed as
   long as no passage can be made of them. So results do not depend on tasks.
4. Each shared seed is aligned outwards in both texts over the words it carries.
5. The matches of a pair of texts are chained in the order of both, with a cost
   for the words skipped and overlapping ones trimmed; the best chain before each match comes from a Fenwick
   tree over the second text's places.

Of repeated words, matches inside longer ones that are passages themselves are not chained again.

A passage has ``MIN_WORDS`` words or more in both texts, at least
``MIN_COVER`` of them in matches. Words are lower-cased in A to Z only.

Null and blank texts, and rows without an id, share nothing. Rows with one id
are one document; it shares nothing with itself. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm.common import keyed, place_map, ship, unkeyed, written
from loadlens.llm.jaccard import ID_MAP_BYTES

K = 4
SPAN = 3
# Words that a seed carries of each side.
REACH = 12
MIN_WORDS = 50
MIN_COVER = 0.8
# Gap costs: for each word skipped in either text.
SKIP = 0.25
# Places in the maps of shared seeds and side keys, as powers of two: four or more for each word, as far as a task can hold
# them. A fuller map lets more seeds through that only one text has; none is lost.
LEAST_MAP_LOG, MOST_MAP_LOG = 25, 28
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Bits of a hash that are kept to see whether two texts have it: ten of them part the hashes into blocks, 32 are stored.
KEY_BITS = 42
BLOCK_LOG = KEY_BITS - 32
SEEDS_AT_ONCE = 150_000
TEXT_AT_ONCE = 500_000
PAIRS_AT_ONCE = 50_000
MATCHES_AT_ONCE = 2_000_000


def kmers(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k words, in order."""
    n = len(words) - k + 1
    with np.errstate(over="ignore"):
        h = np.zeros(max(n, 0), np.uint64)
        for j in range(k if n > 0 else 0):
            h = (h ^ words[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h


def minimizers(h: np.ndarray, span: int) -> np.ndarray:
    """Places of the least hash of every ``span`` in a row; all of a shorter text's share one."""
    if not len(h):
        return np.empty(0, np.int64)
    if len(h) <= span:
        return np.array([int(h.argmin())])
    view = np.lib.stride_tricks.sliding_window_view(h, span)
    return np.unique(np.arange(len(view)) + view.argmin(axis=1))


_BYTES = np.random.default_rng(8).integers(1, 1 << 63, 256, np.uint64)
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BYTES[65:91] = _BYTES[97:123]  # A to Z count as lower case
_BYTES[_SPACES] = 0


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of the texts, one text after the other, and how many words each text has."""
    bodies = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([b"", *bodies, b""]), np.uint8)
    begins = np.cumsum([1, *[len(b) + 1 for b in bodies]])
    blank = _SPACES[data]
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    sizes = np.diff(np.searchsorted(starts, begins))
    if not len(starts):
        return np.empty(0, np.uint64), sizes
    lengths = np.diff(np.concatenate((starts, [len(data)])))
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate(([1], np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))), dtype=np.uint64)
        place = np.arange(int(lengths.sum())) - np.repeat(starts - starts[0], lengths)
        h = np.add.reduceat(_BYTES[data[starts[0] :]] * powers[place], starts - starts[0])
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31)), sizes


def laid_out(texts: list[str], k: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimizers of many texts at once: their texts' numbers, places, hashes and contexts; and each text's number of words.

    A context has a byte for each of the ``REACH`` words before a seed and of those after it; 0 beyond the text.
    """
    own, sizes = word_hashes(texts)
    starts = REACH + np.cumsum(sizes + REACH) - (sizes + REACH)
    words = np.zeros(len(own) + REACH * (len(texts) + 1), np.uint64)
    marks = np.zeros(len(words), np.uint8)
    spots = np.arange(len(own)) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
    words[spots] = own
    marks[spots] = np.maximum(own & np.uint64(0xFF), np.uint64(1))
    h = kmers(words, k)
    grams = np.maximum(sizes - k + 1, 0)
    windows = np.maximum(grams - span + 1, 0)
    best = np.repeat(starts - np.cumsum(windows) + windows, windows) + np.arange(int(windows.sum()))
    first = best.copy()
    for j in range(1, span):
        best = np.where(h[first + j] < h[best], first + j, best)
    least = np.zeros(len(words), bool)
    least[best] = True
    for i in np.flatnonzero((grams > 0) & (windows == 0)):
        least[starts[i] + int(h[starts[i] : starts[i] + grams[i]].argmin())] = True
    at = np.flatnonzero(least)
    number = np.searchsorted(starts, at, side="right") - 1
    around = marks[at[:, None] + np.concatenate((np.arange(-REACH, 0), np.arange(k, k + REACH)))[None, :]]
    return number, at - starts[number], h[at], around, sizes


def side_keys(h: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys that two occurrences of a seed have in common if they go on alike for five words or more; and which keys there are.

    Six for the left, six for the right. Of five to nine words on which four in five are equal, four of the first five
    are; of ten to twelve, those or the second five.
    """
    keys, there = np.empty((len(h), 12), np.uint64), np.empty((len(h), 12), bool)
    for side, own in enumerate((around[:, :REACH][:, ::-1], around[:, REACH:])):
        for i in range(6):
            part = own[:, [j for j in range(5) if j != i]] if i < 5 else own[:, 5:10]
            x = np.full(len(h), 6 * side + i + 1, np.uint64)
            for j in range(part.shape[1]):
                x = (x << np.uint64(8)) | part[:, j]
            with np.errstate(over="ignore"):
                x = (h ^ (x * np.uint64(0xBF58476D1CE4E5B9))) * np.uint64(0x9E3779B97F4A7C15)
            keys[:, 6 * side + i] = x ^ (x >> np.uint64(29))
            there[:, 6 * side + i] = (part != 0).all(axis=1)
    return keys, there


def could_hold(begin: np.ndarray, end: np.ndarray, min_words: int, min_cover: float) -> np.ndarray:
    """Whether each of these stretches of a text can be part of a passage whose matches lie in their union."""
    if not len(begin) or min_cover <= 0:
        return np.ones(len(begin), bool)
    order = np.argsort(begin, kind="stable")
    top = np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate(([True], begin[order][1:] > top[:-1])))
    lo, hi = begin[order][new], top[np.concatenate((new[1:], [len(top)])) - 1]
    covered = np.cumsum(hi - lo)
    # From block i to block j there are enough words if gains[j] >= needs[i]; the last such j makes the longest passage.
    gains, needs = covered - min_cover * hi, covered - (hi - lo) - min_cover * lo
    later = np.maximum.accumulate(gains[::-1])
    last = len(lo) - 1 - np.searchsorted(later, needs - 1e-6, side="left")
    good = hi[last] - lo >= min_words
    step = np.zeros(len(lo) + 1, np.int64)
    np.add.at(step, np.flatnonzero(good), 1)
    np.add.at(step, last[good] + 1, -1)
    inside = np.cumsum(step[:-1]) > 0
    return inside[np.searchsorted(lo, begin, side="right") - 1]


def reach(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How far two aligned stretches go on alike: to the last equal word up to which four of five are equal."""
    same = (a == b) & (a != 0)
    steps = np.arange(1, a.shape[1] + 1, dtype=np.int16)
    good = same & (np.cumsum(same, axis=1, dtype=np.int16) * np.int16(5) >= 4 * steps)
    return np.where(good, steps, np.int16(0)).max(axis=1).astype(np.int64)


def _reaches(mine: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far each pair of occurrences goes on to the left and to the right, some pairs at a time."""
    left, right = np.empty(len(mine), np.int64), np.empty(len(mine), np.int64)
    for lo in range(0, len(mine), PAIRS_AT_ONCE):
        part = slice(lo, lo + PAIRS_AT_ONCE)
        a, b = mine[part], theirs[part]
        left[part] = reach(a[:, :REACH][:, ::-1], b[:, :REACH][:, ::-1])
        right[part] = reach(a[:, REACH:], b[:, REACH:])
    return left, right


PACK = np.dtype([("h", "<i8"), ("begin", "<i4"), ("end", "<i4"), ("open", "?")])
MARKS, THEIRS = ["m0", "m1", "m2"], ["t0", "t1", "t2"]  # a context's 24 bytes as three whole numbers


def _aligned(x: pd.DataFrame, k: int) -> pd.DataFrame:
    """Matches of pairs of occurrences, aligned outwards over the words that both carry."""
    rows = lambda names: np.ascontiguousarray(x[names].to_numpy(np.int64)).view(np.uint8).reshape(len(x), 2 * REACH)
    left, right = _reaches(rows(MARKS), rows(THEIRS))
    at, bt = x["place"].to_numpy(np.int64), x["bt"].to_numpy(np.int64)
    made = {"at": (at - left).astype(np.int32), "bt": (bt - left).astype(np.int32), "n": (left + k + right).astype(np.int32)}
    return x.drop(columns=["bt"]).assign(**made)


def _whole(batches: Iterator[pd.DataFrame], *keys: str) -> Iterator[pd.DataFrame]:
    """Sorted rows in frames that hold all rows of each key."""
    held = []
    for x in batches:
        if not len(x):
            continue
        last = (x[[*keys]] == x[[*keys]].iloc[-1]).all(axis=1).to_numpy()
        if not last.all():
            yield pd.concat([*held, x[~last]], ignore_index=True)
            held = []
        elif held and tuple(held[-1][[*keys]].iloc[0]) != tuple(x[[*keys]].iloc[0]):
            yield pd.concat(held, ignore_index=True)
            held = []
        held.append(x[last])
    if held:
        yield pd.concat(held, ignore_index=True)


def map_log(words: int) -> int:
    return min(max(LEAST_MAP_LOG, (4 * words).bit_length()), MOST_MAP_LOG)


def _parted(h: np.ndarray, log: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes' blocks, each of which has its own part of a map of ``2 ** log`` places, and 32 further bits."""
    low, key = np.uint64(log - BLOCK_LOG), h >> np.uint64(64 - KEY_BITS)
    rest = ((key >> np.uint64(log)) << low) | (key & ((np.uint64(1) << low) - np.uint64(1)))
    return (key >> low) & np.uint64((1 << BLOCK_LOG) - 1), rest


def _spots(rest: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places that a hash marks in its block's part of a map, which has ``2 ** low``."""
    other = (rest * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
    return (rest & np.uint64((1 << low) - 1)).astype(np.int64), (other >> np.uint64(32 - low)).astype(np.int64)


def _shared_map(blocks: DataFrame, log: int) -> np.ndarray:
    """A packed map of the hashes that two of the blocks have or one has from two ids; each block's task makes its part."""
    low = log - BLOCK_LOG

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, last = [], None

        def part() -> pd.DataFrame:
            once, more = (np.concatenate([np.frombuffer(x[c], np.uint32) for x in held]) for c in ("once", "more"))
            once.sort()
            flags = np.zeros(1 << low, np.uint8)
            for own in (once[1:][once[1:] == once[:-1]], more):
                for places in _spots(own.astype(np.uint64), low):
                    flags[places] = 1
            return pd.DataFrame({"bucket": [last], "bits": [np.packbits(flags).tobytes()]})

        for batch in batches:
            for row in batch.to_dict("records"):
                if last is not None and row["bucket"] != last:
                    yield part()
                    held = []
                last = row["bucket"]
                held.append(row)
        if held:
            yield part()

    parts = blocks.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(run, "bucket long, bits binary")
    flags = np.zeros((1 << BLOCK_LOG, (1 << low) // 8), np.uint8)
    for bucket, bits in parts.collect():
        flags[bucket] = np.frombuffer(bytes(bits), np.uint8)
    return flags.ravel()


def _blocks(h: np.ndarray, ids: np.ndarray, log: int) -> pd.DataFrame:
    """The distinct hashes in blocks: those of one id, and those of several."""
    bucket, rest = _parted(h, log)
    key = (bucket << np.uint64(32)) | rest
    order = np.argsort(key)
    key, ids = key[order], ids[order]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    several = np.maximum.reduceat(ids, starts) != np.minimum.reduceat(ids, starts)
    key = key[starts]
    bucket, rest = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    rows = [(bucket[lo], rest[lo:hi][~several[lo:hi]].tobytes(), rest[lo:hi][several[lo:hi]].tobytes()) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
    return pd.DataFrame(rows, columns=["bucket", "once", "more"])


def _bit(flags: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether the places' bits are set in a map packed by ``packbits``."""
    return (flags[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 > 0


def _marked(flags: np.ndarray, h: np.ndarray, log: int) -> np.ndarray:
    """Whether both places of each hash are marked."""
    bucket, rest = _parted(h, log)
    base = bucket.astype(np.int64) << (log - BLOCK_LOG)
    one, other = _spots(rest, log - BLOCK_LOG)
    out = _bit(flags, base + one)
    found = np.flatnonzero(out)
    out[found] = _bit(flags, (base + other)[found])
    return out


def _of_texts(docs: DataFrame, id_col: str, text_col: str, sent: list[Broadcast], places: int, log: int, k: int, span: int, min_words: int, min_cover: float) -> DataFrame:
    """A pass over the texts that stand for their classes, by the first map, of ``places`` bits; ids must be whole numbers.

    Without further maps: the seeds, in blocks. With the map of shared seeds: the side keys of those that could be part
    of a passage, in blocks. With the map of shared side keys too: the seeds that still could, with ``l`` and ``r``,
    the words that they go on at most with any other text.
    """

    def seeds_of(ids: np.ndarray, texts: list[str]) -> tuple:
        number, place, h, around, sizes = laid_out(texts, k, span)
        ids = ids[number]
        if len(sent) == 1:
            return h, ids
        # All texts on one line, so far apart that no passage reaches from one to another.
        apart = int(np.ceil(2 / min_cover)) if min_cover > 0 else 1
        base = np.cumsum(sizes + apart * (sizes + np.concatenate((sizes[1:], [0])))) - sizes - apart * (sizes + np.concatenate((sizes[1:], [0])))

        def kept(left, right, *columns):
            begin, end = np.maximum(place - left, 0), np.minimum(place + k + right, sizes[number])
            good = could_hold(begin + base[number], end + base[number], min_words, min_cover)
            return [c[good] for c in (number, place, h, around, ids, *columns)]

        good = _marked(sent[1].value, h, log)
        number, place, h, around, ids = (c[good] for c in (number, place, h, around, ids))
        number, place, h, around, ids = kept(REACH, REACH)
        keys, there = side_keys(h, around)
        if len(sent) == 2:
            return keys[there], np.repeat(ids, there.sum(axis=1))
        alike = there & _marked(sent[2].value, keys.ravel(), log).reshape(keys.shape)
        left, right = (np.where(alike[:, half].any(axis=1), REACH, 4) for half in (slice(0, 6), slice(6, 12)))
        number, place, h, around, ids, left, right = kept(left, right, left, right)
        m = np.ascontiguousarray(around).view(np.int64).reshape(len(h), 3)
        return h.view(np.int64), ids, place.astype(np.int32), m[:, 0], m[:, 1], m[:, 2], left.astype(np.int32), right.astype(np.int32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0

        def made() -> pd.DataFrame:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            held.clear()
            return _blocks(*columns, log) if len(sent) < 3 else pd.DataFrame(dict(zip(names, columns, strict=True)))

        for batch in batches:
            batch = batch[_bit(sent[0].value, batch["place"].to_numpy())]
            ids, texts = batch["id"].astype("int64").to_numpy(), batch["text"].tolist()
            number = np.cumsum([len(t or "") for t in texts]) // TEXT_AT_ONCE
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(number)) + 1, [len(texts)])) if texts else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                found = seeds_of(ids[lo:hi], texts[lo:hi])
                if len(found[0]):
                    held.append(found)
                    n += len(found[0])
                if n >= (SEEDS_AT_ONCE if len(sent) == 3 else 4 * SEEDS_AT_ONCE):
                    yield made()
                    held, n = [], 0
        if held:
            yield made()

    names = ["h", "id", "place", *MARKS, "l", "r"]
    kind = "h long, id long, place int, m0 long, m1 long, m2 long, l int, r int" if len(sent) == 3 else "bucket long, once binary, more binary"
    rows = docs.filter(F.col(id_col).isNotNull()).withColumn("_place", F.pmod(F.xxhash64(id_col), F.lit(places)))
    return keyed(rows, id_col, text=text_col, place="_place").mapInPandas(run, kind)


def _first_matches(seeds: DataFrame, k: int) -> DataFrame:
    """Every shared occurrence aligned with the first one of its seed in the text of smallest id; and how often the seed stands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in _whole(batches, "h"):
            h, ids = x["h"].to_numpy(), x["id"].to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            sizes = np.diff(np.concatenate((starts, [len(h)])))
            first = np.repeat(starts, sizes)
            theirs = {t: x[m].to_numpy()[first] for m, t in zip(MARKS, THEIRS, strict=True)}
            x = x.assign(b=ids[first], bt=x["place"].to_numpy()[first], holders=np.repeat(sizes, sizes), **theirs)[ids > ids[first]]
            for lo in range(0, len(x), PAIRS_AT_ONCE):
                yield _aligned(x.iloc[lo : lo + PAIRS_AT_ONCE].rename(columns={"id": "a"}), k)[["a", "b", "at", "bt", "n", "h", "place", "l", "r", "holders"]]

    spread = seeds.repartition("h").sortWithinPartitions("h", "id", "place", *MARKS)
    return spread.mapInPandas(run, "a long, b long, at int, bt int, n int, h long, place int, l int, r int, holders long")


ENTRIES = ["place", "many", "step", "l", "r", *MARKS]


def in_steps(rows: list[tuple]) -> list[tuple]:
    """Occurrences (place, l, r, and the three parts of a context) of a seed in a text; those in even steps with one context become one entry."""
    rows, out = sorted(set(rows)), []
    for row in rows:
        if out and out[-1][3:] == row[1:]:
            place, many, step = out[-1][:3]
            if many == 1 and row[0] - place <= REACH or many > 1 and row[0] - place == many * step:
                out[-1] = (place, many + 1, row[0] - place if many == 1 else step, *row[1:])
                continue
        out.append((row[0], 1, 0, *row[1:]))
    return out


def _crossed(own: np.ndarray, other: np.ndarray, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Each of a group's ``own`` with each of its ``other``, some at a time: the group, and the numbers of both in it."""
    ends = np.cumsum(own * other)
    for lo in range(0, int(ends[-1]) if len(ends) else 0, at_once):
        nth = np.arange(lo, min(lo + at_once, int(ends[-1])))
        row = np.searchsorted(ends, nth, side="right")
        nth -= (ends - own * other)[row]
        yield row, nth // other[row], nth % other[row]


def _stepped(p: dict[str, np.ndarray], q: dict[str, np.ndarray], left: np.ndarray, right: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches of pairs of entries: those of one diagonal that touch come as one, if both entries have the same step."""
    step = np.maximum(p["step"], q["step"])
    even = ((p["many"] == 1) | (q["many"] == 1) | (p["step"] == q["step"])) & (step <= k + left + right)
    made = []
    i = np.flatnonzero(even)
    count = p["many"][i] + q["many"][i] - 1
    row = np.repeat(i, count)
    off = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) - (q["many"][row] - 1)
    x, y = np.maximum(off, 0), np.maximum(-off, 0)
    long = np.minimum(p["many"][row] - x, q["many"][row] - y)
    made.append((p["place"][row] + x * step[row] - left[row], q["place"][row] + y * step[row] - left[row], (long - 1) * step[row] + left[row] + k + right[row]))
    i = np.flatnonzero(~even)
    for group, x, y in _crossed(p["many"][i], q["many"][i], MATCHES_AT_ONCE):
        row = i[group]
        made.append((p["place"][row] + x * p["step"][row] - left[row], q["place"][row] + y * q["step"][row] - left[row], left[row] + k + right[row]))
    return tuple(np.concatenate(c) for c in zip(*made, strict=True))


def pair_matches(mine: list[dict[str, np.ndarray]], theirs: list[dict[str, np.ndarray]], k: int, min_words: int, min_cover: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Matches of all occurrences of a pair's common seeds that could be part of a passage by the words around them.

    ``mine`` and ``theirs`` have the entries of each seed in either text. Stretches are as long as the seeds go on with any
    other text, then as they go on in this pair; what cannot hold a passage in either text goes before it is paired.
    """
    sides = [
        {"seed": np.repeat(np.arange(len(own)), [len(e["place"]) for e in own]), **{c: np.concatenate([e[c] for e in own]) for c in ENTRIES}}
        for own in (mine, theirs)
    ]

    def pruned() -> bool:
        before = -1
        while all(len(e["place"]) for e in sides) and before != (before := sum(len(e["place"]) for e in sides)):
            for i, e in enumerate(sides):
                end = e["place"] + np.maximum(e["many"] - 1, 0) * e["step"] + k + e["r"]
                good = could_hold(e["place"] - e["l"], end, min_words, min_cover)
                sides[i] = {c: v[good] for c, v in e.items()}
            common = np.intersect1d(sides[0]["seed"], sides[1]["seed"])
            for i, e in enumerate(sides):
                good = np.isin(e["seed"], common)
                sides[i] = {c: v[good] for c, v in e.items()}
        return all(len(e["place"]) for e in sides)

    def met() -> Iterator[tuple[np.ndarray, ...]]:
        seeds = np.unique(sides[0]["seed"])
        bounds = [np.searchsorted(e["seed"], np.concatenate((seeds, [len(mine)]))) for e in sides]
        for row, p, q in _crossed(*(np.diff(x) for x in bounds), PAIRS_AT_ONCE):
            p, q = (x[row] + own for x, own in zip(bounds, (p, q), strict=True))
            yield p, q, *_alike(*sides, p, q)

    if not pruned():
        return None
    ends = [[np.zeros(len(e["place"]), np.int64) for _ in "lr"] for e in sides]
    parts = []
    for part in met():
        parts = [*parts, part] if not parts else [None]  # one part is kept, more are made again
        for own, most in zip(part[:2], ends, strict=True):
            for value, side in zip(part[2:], most, strict=True):
                np.maximum.at(side, own, value)
    for e, most in zip(sides, ends, strict=True):
        e["l"], e["r"] = most
    before = [len(e["place"]) for e in sides]
    if not pruned():
        return None
    found = []
    for p, q, left, right in parts if len(parts) == 1 and parts[0] and before == [len(e["place"]) for e in sides] else met():
        sizes = np.cumsum(sides[0]["many"][p] * 1.0 * sides[1]["many"][q])
        cuts = np.unique(np.searchsorted(sizes, np.arange(0, sizes[-1], MATCHES_AT_ONCE)))
        for lo, hi in zip(cuts, [*cuts[1:], len(p)], strict=True):
            part = slice(lo, hi)
            entries = ({c: e[c][i[part]] for c in ("place", "many", "step")} for e, i in zip(sides, (p, q), strict=True))
            found.append(_on_diagonals(*_stepped(*entries, left[part], right[part], k)))
    return _on_diagonals(*(np.concatenate(c) for c in zip(*found, strict=True))) if len(found) > 1 else found[0]


def _alike(one: dict[str, np.ndarray], other: dict[str, np.ndarray], p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far entry ``p`` of one text and entry ``q`` of the other go on alike to the left and to the right."""
    marks = [np.ascontiguousarray(np.stack([e[m] for m in MARKS], axis=1)).view(np.uint8).reshape(-1, 2 * REACH) for e in (one, other)]
    left, right = np.empty(len(p), np.int64), np.empty(len(p), np.int64)
    for lo in range(0, len(p), PAIRS_AT_ONCE):
        part = slice(lo, lo + PAIRS_AT_ONCE)
        left[part], right[part] = _reaches(marks[0][p[part]], marks[1][q[part]])
    return left, right


def _all_passages(seeds: DataFrame, wanted: DataFrame, k: int, min_words: int, min_cover: float) -> DataFrame:
    """The passages that all occurrences of the pairs' seeds make: rows of ``wanted`` are (a, b, h)."""
    kind = ", ".join(f"{c} array<{'long' if c in MARKS else 'int'}>" for c in ENTRIES)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            rows = [list(zip(*in_steps([(p["place"], p["l"], p["r"], *(p[m] for m in MARKS)) for p in own]), strict=True)) for own in x["rows"]]
            yield pd.DataFrame({"id": x["id"], "h": x["h"], **{c: [np.array(r[j], np.int64) for r in rows] for j, c in enumerate(ENTRIES)}})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in _whole(batches, "a", "b"):
            a, b = x["a"].to_numpy(), x["b"].to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]), [True])))
            sides = [[dict(zip(ENTRIES, (np.asarray(v, np.int64) for v in row), strict=True)) for row in zip(*(x[f"{side}{c}"] for c in ENTRIES), strict=True)] for side in "ab"]
            held, n = [], 0
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                found = pair_matches(sides[0][lo:hi], sides[1][lo:hi], k, min_words, min_cover)
                if found is not None:
                    held.append(pd.DataFrame({"a": a[lo], "b": b[lo], **dict(zip(("at", "bt", "n"), found, strict=True))}))
                    n += len(found[0])
                if held and (n > PAIRS_AT_ONCE or hi == len(a)):
                    yield judged(pd.concat(held, ignore_index=True), min_words, min_cover)
                    held, n = [], 0

    lists = seeds.join(wanted.select("h").distinct(), "h", "left_semi").groupBy("id", "h").agg(F.collect_list(F.struct("place", "l", "r", *MARKS)).alias("rows"))
    lists = lists.mapInPandas(listed, f"id long, h long, {kind}")
    mine, theirs = (lists.select(F.col("id").alias(side), "h", *[F.col(c).alias(f"{side}{c}") for c in ENTRIES]) for side in "ab")
    met = wanted.join(mine, ["a", "h"]).join(theirs, ["b", "h"]).drop("h")
    return met.repartition("a", "b").sortWithinPartitions("a", "b").mapInPandas(run, _FOUND)


def open_seeds(
    begin: np.ndarray, end: np.ndarray, holders: np.ndarray, done: np.ndarray, min_words: int, min_cover: float
) -> np.ndarray:
    """Which of a text's shared seeds any passage not yet found must have one of; a seed's matches lie in ``begin`` to ``end``.

    A new passage has a seed outside of what was found (``done``). Of those the
    most frequent are left out as long as they and the found ones, without the
    others, could not make up a passage.
    """
    out = np.zeros(len(begin), bool)
    left = np.flatnonzero(could_hold(begin, end, min_words, min_cover) & ~done)
    if not len(left):
        return out
    left = left[np.argsort(-holders[left], kind="stable")]
    lo, hi = 0, len(left)  # so many of the most frequent can, or cannot, be left out
    while lo < hi:
        mid = (lo + hi + 1) // 2
        tried = done.copy()
        tried[left[:mid]] = True
        kept = np.flatnonzero(tried)
        if (could_hold(begin[kept], end[kept], min_words, min_cover) & ~done[kept]).any():
            hi = mid - 1
        else:
            lo = mid
    out[left[lo:]] = True
    return out


def chain(at: np.ndarray, bt: np.ndarray, n: np.ndarray, skip: float = SKIP) -> list[list[int]]:
    """Collinear chains of matches, best first, each match in one chain.

    A match follows another if it begins after that one's end in both texts.
    Its score is its words plus the best score before it less the words
    skipped in both texts times ``skip``; with the ends' places added to the
    scores, the best one before is a prefix maximum over b's places.
    """
    m = len(at)
    ends_a, ends_b = at + n, bt + n
    places = np.unique(ends_b)
    tree = [(-np.inf, -1)] * (len(places) + 1)
    score, back = [0.0] * m, [-1] * m
    waiting = sorted(range(m), key=lambda i: ends_a[i])
    w = 0
    upto = np.searchsorted(places, bt, side="right")
    slot = np.searchsorted(places, ends_b) + 1
    for i in sorted(range(m), key=lambda i: (at[i], bt[i])):
        while w < m and ends_a[waiting[w]] <= at[i]:
            j = waiting[w]
            value, p = (score[j] + skip * float(ends_a[j] + ends_b[j]), j), int(slot[j])
            while p < len(tree):
                if value > tree[p]:
                    tree[p] = value
                p += p & -p
            w += 1
        best, p = (-np.inf, -1), int(upto[i])
        while p > 0:
            if tree[p] > best:
                best = tree[p]
            p -= p & -p
        gain = best[0] - skip * float(at[i] + bt[i])
        score[i] = float(n[i]) + max(gain, 0.0)
        back[i] = best[1] if gain > 0 else -1
    used, out = [False] * m, []
    for i in sorted(range(m), key=lambda i: -score[i]):
        links = []
        while i >= 0 and not used[i]:
            used[i] = True
            links.append(i)
            i = back[i]
        if links:
            out.append(links[::-1])
    return out


def cut_where_others_end(at: np.ndarray, bt: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The matches, cut at the places of either text where another one ends inside them.

    A chain can then follow an overlapping match with the rest of the next one, and no word counts twice.
    There are never more pieces than words in matches.
    """
    inside = []
    for begin in (at, bt):
        ends = np.unique(begin + n)
        lo, hi = np.searchsorted(ends, begin, side="right"), np.searchsorted(ends, begin + n, side="left")
        which = np.repeat(np.arange(len(n)), hi - lo)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)
        inside.append((which, ends[lo[which] + nth] - begin[which]))
    which = np.concatenate([np.arange(len(n)), *(w for w, _ in inside)])
    off = np.concatenate([np.zeros(len(n), np.int64), *(o for _, o in inside)]).astype(np.int64)
    which, off = np.unique(np.stack((which, off)), axis=1)
    last = np.concatenate((which[1:] != which[:-1], [True]))
    until = np.where(last, n[which], np.concatenate((off[1:], [0])))
    return at[which] + off, bt[which] + off, until - off


def _on_diagonals(at: np.ndarray, bt: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches of one pair of texts: those on one diagonal that touch or overlap become one."""
    d = at - bt
    far = int((at + n).max()) + 1
    order = np.argsort((d - d.min()) * far + at)
    at, d, end = at[order], d[order], (at + n)[order]
    group = np.concatenate(([True], d[1:] != d[:-1]))
    shift = np.cumsum(group) * far
    top = np.maximum.accumulate(end + shift) - shift
    starts = np.flatnonzero(group | np.concatenate(([True], at[1:] > top[:-1])))
    last = np.concatenate((starts[1:], [len(at)])) - 1
    return at[starts], at[starts] - d[starts], top[last] - at[starts]


def undominated(at: np.ndarray, bt: np.ndarray, n: np.ndarray, min_words: int) -> np.ndarray:
    """Which matches of a pair of texts to chain: words that recur within a passage need no further alignment of it.

    Of matches in falling length one goes if a longer one, itself a passage, holds its words in both texts; or if it is
    a passage whose words all lie in passages that stay, in either text.
    """
    order = np.lexsort(((at - bt) * 0x9E3779B1 & 0xFFFF, -n))
    keep = np.ones(len(n), bool)
    if int(n[order[0]]) < min_words:
        return keep
    seen = [np.zeros(int((x + n).max()) + 1, bool) for x in (at, bt)]
    big = np.empty((4, len(n)), np.int64)
    m = 0
    for i in order:
        a, b, w = int(at[i]), int(bt[i]), int(n[i])
        if ((big[0, :m] <= a) & (a + w <= big[1, :m]) & (big[2, :m] <= b) & (b + w <= big[3, :m])).any():
            keep[i] = False
        elif w >= min_words:
            if seen[0][a : a + w].all() and seen[1][b : b + w].all():
                keep[i] = False
                continue
            big[:, m] = a, a + w, b, b + w
            seen[0][a : a + w] = seen[1][b : b + w] = True
            m += 1
    return keep


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """Matches of a pair of texts on one diagonal that touch or overlap become one."""
    rows = rows.assign(d=rows["at"] - rows["bt"]).sort_values(["a", "b", "d", "at"], kind="stable")
    a, b, d, at = (rows[c].to_numpy() for c in ("a", "b", "d", "at"))
    end = at + rows["n"].to_numpy()
    group = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (d[1:] != d[:-1])))
    number = np.cumsum(group)
    shift = number * (int(end.max()) + 1)  # one running maximum serves all groups
    top = np.maximum.accumulate(end + shift) - shift
    new = group | np.concatenate(([True], at[1:] > top[:-1]))
    starts = np.flatnonzero(new)
    last = np.concatenate((starts[1:], [len(rows)])) - 1
    return pd.DataFrame({"a": a[starts], "b": b[starts], "at": at[starts], "bt": at[starts] - d[starts], "n": top[last] - at[starts]})


_SPANS = ["doc_id", "other_id", "start", "end", "other_start", "other_end", "matched"]
_FOUND = "doc_id long, other_id long, start int, end int, other_start int, other_end int, matched int"


def judged(rows: pd.DataFrame, min_words: int, min_cover: float) -> pd.DataFrame:
    """The chains long and dense enough: a, b, their word spans and the words in matches."""
    rows = _merged(rows).sort_values(["a", "b"], kind="stable").reset_index(drop=True)
    out = []
    key = rows[["a", "b"]].to_numpy()
    cuts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1), [True])))
    at, bt, n = (rows[c].to_numpy(np.int64) for c in ("at", "bt", "n"))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if hi - lo == 1:
            if n[lo] >= min_words:
                out.append((key[lo, 0], key[lo, 1], at[lo], at[lo] + n[lo], bt[lo], bt[lo] + n[lo], n[lo]))
            continue
        if n[lo:hi].sum() < min_cover * min_words:
            continue
        stays, before = np.arange(lo, hi), 0
        while len(stays) and len(stays) != before:  # only matches that can be part of a passage by their places in either text
            before = len(stays)
            for x in (at, bt):
                stays = stays[could_hold(x[stays], x[stays] + n[stays], min_words, min_cover)]
        if not len(stays):
            continue
        stays = stays[undominated(at[stays], bt[stays], n[stays], min_words)]
        p, q, w = cut_where_others_end(at[stays], bt[stays], n[stays])
        for links in chain(p, q, w):
            i, j = links[0], links[-1]
            spans = p[i], p[j] + w[j], q[i], q[j] + w[j]
            covered = sum(int(w[x]) for x in links)
            size = min(spans[1] - spans[0], spans[3] - spans[2]), max(spans[1] - spans[0], spans[3] - spans[2])
            if size[0] >= min_words and covered >= min_cover * size[1]:
                out.append((key[lo, 0], key[lo, 1], *spans, covered))
    return pd.DataFrame(out, columns=_SPANS)


def covered(begin: np.ndarray, end: np.ndarray) -> int:
    """Words in the union of stretches."""
    order = np.argsort(begin, kind="stable")
    top = np.maximum.accumulate(np.concatenate(([0], end[order])))
    return int(np.maximum(end[order] - np.maximum(begin[order], top[:-1]), 0).sum())


def _first_chains(matches: DataFrame, min_words: int, min_cover: float, k: int) -> DataFrame:
    """The passages with first holders; rows with ``h`` for the seeds of each text that more may hang on; its seeds in a ``pack``.

    With ``h`` are the words that its occurrences can cover (``words``) and those that all such seeds of the text must (``lack``).
    """

    def settled(rows: pd.DataFrame) -> pd.DataFrame:
        found = judged(rows, min_words, min_cover)
        rows = rows.sort_values(["a", "place"], kind="stable")
        a, places, holders, h, l, r = (rows[c].to_numpy() for c in ("a", "place", "holders", "h", "l", "r"))
        spans = {d: x[["start", "end"]].to_numpy() for d, x in found.groupby("doc_id")} if len(found) else {}
        cuts = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1], [True])))
        left, packs = [], []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            own, done = places[lo:hi], np.zeros(hi - lo, bool)
            begin, end = own - l[lo:hi], own + k + r[lo:hi]
            if int(end.max() - begin.min()) < min_words:
                continue
            for start, stop in spans.get(a[lo], ()):
                done |= (start <= own) & (own + k <= stop)
            opened = open_seeds(begin, end, holders[lo:hi], done, min_words, min_cover)
            if opened.any():
                could = could_hold(begin, end, min_words, min_cover)
                lack = min_cover * min_words - covered(begin[could & ~opened], end[could & ~opened])
                left.append(pd.DataFrame({"doc_id": a[lo], "h": h[lo:hi], "begin": begin, "end": end, "words": end - begin, "lack": lack})[opened])
                pack = np.rec.fromarrays([h[lo:hi], begin, end, opened], dtype=PACK)
                packs.append((a[lo], pack[could].tobytes()))
        more = pd.DataFrame(columns=["doc_id", "h", "words", "lack"])
        if left:
            by = pd.concat(left, ignore_index=True).groupby(["doc_id", "h"])
            more = by.agg(words=("words", "sum"), lack=("lack", "max"), lo=("begin", "min"), hi=("end", "max")).reset_index()
            more = more.assign(words=np.minimum(more["words"], more["hi"] - more["lo"])).drop(columns=["lo", "hi"])
        packs = pd.DataFrame(packs, columns=["doc_id", "pack"])
        both = pd.concat([x.astype(object) for x in (found, more, packs)], ignore_index=True).reindex(columns=[*_SPANS, "h", "words", "lack", "pack"])
        return both.astype({c: "Int64" for c in both.columns[:-2]}).astype({"lack": "Float64", "pack": object}).where(both.notna(), None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole(batches, "a"):
            yield settled(rows)

    spread = matches.repartition("a").sortWithinPartitions("a", "b", "at")
    return spread.mapInPandas(run, f"{_FOUND}, h long, words int, lack double, pack binary")


@contextmanager
def _dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that wrote them has ended, not when the driver happens to collect its garbage."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


# A text's seed in four bytes: a part of its hash, and the words that its occurrences can cover, or the most, for as many and more.
MOST_COVERED = 255


def summed_up(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((h.view(np.uint64) & np.uint64(0xFFFFFF)) << np.uint64(8)).astype(np.uint32) | np.minimum(words, MOST_COVERED).astype(np.uint32)


def near_pairs(pack: np.ndarray, others: list[np.ndarray], min_words: int, min_cover: float) -> Iterator[tuple[int, np.ndarray]]:
    """Which of the other texts have seeds in common with a pack that could make up a passage with an open seed; and those seeds.

    A matched word lies in an occurrence of a common seed in both texts, so no more words match than all their occurrences cover in either text.
    """
    own, at = np.unique(pack["h"].view(np.uint64) & np.uint64(0xFFFFFF), return_inverse=True)
    can, opened = np.zeros(len(own), np.int64), np.zeros(len(own), bool)
    np.add.at(can, at, pack["end"] - pack["begin"])
    np.logical_or.at(opened, at, pack["open"])
    theirs = np.concatenate(others)
    i = np.minimum(np.searchsorted(own, theirs >> np.uint32(8)), len(own) - 1)
    found = np.flatnonzero(own[i] == theirs >> np.uint32(8))
    row, i, words = np.repeat(np.arange(len(others)), [len(x) for x in others])[found], i[found], (theirs[found] & np.uint32(0xFF)).astype(np.int64)
    words = np.where(words < MOST_COVERED, np.minimum(words, can[i]), can[i])
    enough = np.bincount(row, words, len(others)) >= min_cover * min_words - 1e-6
    enough &= np.bincount(row, opened[i], len(others)) > 0
    for r in np.flatnonzero(enough):
        has = np.zeros(len(own), bool)
        has[i[np.searchsorted(row, r) : np.searchsorted(row, r, side="right")]] = True
        both = pack[has[at]]
        could = could_hold(both["begin"], both["end"], min_words, min_cover)
        if (could & both["open"]).any():
            yield int(r), np.unique(both["h"][could])


def _near(pairs: DataFrame, held: DataFrame, packs: DataFrame, min_words: int, min_cover: float) -> DataFrame:
    """The pairs (a, b) whose common seeds could make up a passage with an open seed, with those seeds; none that can is left out."""

    def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            yield pd.DataFrame({"b": x["b"], "pack": [summed_up(np.asarray(h, np.int64), np.asarray(w, np.int64)).tobytes() for h, w in zip(x["hs"], x["ws"], strict=True)]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, own = None, None
        for x in batches:
            good = [(0, 0, np.empty(0, np.int64))]
            a, b, kind, packs = (x[c].to_numpy() for c in ("a", "b", "kind", "pack"))
            cuts = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1], [True]))) if len(x) else []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if kind[lo] == 0:
                    last, own, lo = a[lo], np.frombuffer(packs[lo], PACK), lo + 1
                if lo < hi and a[lo] == last:
                    others = [np.frombuffer(p, np.uint32) for p in packs[lo:hi]]
                    good += [(a[lo], b[lo + r], h) for r, h in near_pairs(own, others, min_words, min_cover)]
            found, other, h = zip(*good, strict=True)
            times = [len(own) for own in h]
            yield pd.DataFrame({"a": np.repeat(np.array(found, np.int64), times), "b": np.repeat(np.array(other, np.int64), times), "h": np.concatenate(h)})

    lists = held.groupBy("b").agg(F.collect_list(F.struct("h", "w")).alias("l")).select("b", F.col("l.h").alias("hs"), F.col("l.w").alias("ws"))
    maps = lists.mapInPandas(mapped, "b long, pack binary")
    rows = pairs.join(maps, "b").select("a", "b", F.lit(1).alias("kind"), "pack")
    rows = packs.select("a", F.lit(0).cast("long").alias("b"), F.lit(0).alias("kind"), "pack").unionByName(rows)
    return rows.repartition("a").sortWithinPartitions("a", "kind").mapInPandas(run, "a long, b long, h long")


def _passages(
    docs: DataFrame, id_col: str, text_col: str, reps: np.ndarray, words: int, k: int, span: int, min_words: int, min_cover: float
) -> DataFrame:
    """First holders, then all holders for what they leave open; ``words`` says how large the maps should be."""
    spark = ship(docs.sparkSession)
    sent, log = [spark.sparkContext.broadcast(np.packbits(reps))], map_log(words)
    with _dropped_shuffles(spark):
        for _ in range(2):
            found = _of_texts(docs, id_col, text_col, sent, len(reps), log, k, span, min_words, min_cover)
            sent = [*sent, spark.sparkContext.broadcast(_shared_map(found, log))]
        seeds = written(_of_texts(docs, id_col, text_col, sent, len(reps), log, k, span, min_words, min_cover), "seeds")
        first = written(_first_chains(_first_matches(seeds, k), min_words, min_cover, k), "first")
    found, more = first.filter("start IS NOT NULL").select(*_SPANS), first.filter("h IS NOT NULL").select("h", F.col("doc_id").alias("a"), "words", "lack")
    packs = first.filter("pack IS NOT NULL").select(F.col("doc_id").alias("a"), "pack")
    # A seed's occurrences in a text cover no more words than all of them together, nor than there are from the first to the last.
    cover = F.least(F.sum(F.expr(f"l + r + {k}")), F.max(F.expr(f"place + {k} + r")) - F.min(F.expr("place - l"))).cast("int")
    held = seeds.groupBy("h", F.col("id").alias("b")).agg(cover.alias("w"))
    pairs = more.join(held, "h").filter("b < a").groupBy("a", "b").agg(F.sum(F.least("words", "w")).alias("can"), F.max("lack").alias("lack"))
    pairs = pairs.filter("can >= lack - 1e-6").select("a", "b")
    with _dropped_shuffles(spark):
        wanted = written(_near(pairs, held, packs, min_words, min_cover), "wanted")
        again = written(_all_passages(seeds, wanted, k, min_words, min_cover), "again")
    wanted = wanted.select("a", "b").distinct()
    kept = found.join(wanted, (found["doc_id"] == wanted["a"]) & (found["other_id"] == wanted["b"]), "left_anti")
    return kept.unionByName(again)


def _signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n words and a digest of them."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for batch in batches:
            out = []
            for text in batch["text"]:  # one text's words at a time: those of a batch take many times its bytes
                words = (text or "").encode("utf-8", "surrogatepass").lower().split()
                out.append((len(words), xxhash.xxh3_128_hexdigest(b" ".join(words)) if words else None))
            made = pd.DataFrame(out, columns=["n", "digest"])
            yield made.assign(id=batch["id"].values)[["id", "n", "digest"]]

    return unkeyed(keyed(docs, id_col, text=text_col).mapInPandas(run, "id string, n long, digest string"), docs, id_col)


def shared_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_cover: float = MIN_COVER,
    k: int = K, span: int = SPAN,
) -> DataFrame:
    """One row for each passage that a document shares with one of smaller id.

    Columns: ``doc_id``, ``other_id``, the word spans ``start`` to ``end`` and
    ``other_start`` to ``other_end``, ``matched`` words, and ``kind``: a
    ``passage`` between texts that stand for their classes, or a ``copy`` that
    ties a document to the text that stands for it.
    """
    signed = written(_signed(docs, id_col, text_col).withColumnRenamed(id_col, "doc").filter("doc IS NOT NULL AND digest IS NOT NULL"), "signed")
    classes = signed.groupBy("digest").agg(F.min("doc").alias("rep"), F.max("n").alias("size"), F.count("*").alias("copies"))
    classes = written(classes, "classes")
    # A map of the ids that stand for a class keeps most copies from being seeded; the few it lets through do no harm.
    flags = place_map(classes.select(F.xxhash64("rep").alias("h")), ID_MAP_BYTES)
    words = classes.agg(F.sum("size")).first()[0] or 0
    found = _passages(docs, id_col, text_col, flags, words, k, span, min_words, min_cover)
    copies = (
        signed.join(classes.filter(f"copies > 1 AND size >= {min_words}"), "digest")
        .filter("doc <> rep")
        .select(
            F.col("doc").cast("long").alias("doc_id"), F.col("rep").cast("long").alias("other_id"), F.lit(0).alias("start"),
            F.col("n").cast("int").alias("end"), F.lit(0).alias("other_start"), F.col("n").cast("int").alias("other_end"),
            F.col("n").cast("int").alias("matched"), F.lit("copy").alias("kind"),
        )
    )
    return found.withColumn("kind", F.lit("passage")).unionByName(copies.distinct())


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without the passages that a document of smaller id holds; those left without a word go.

    A cut takes a span's words and the white space after them. ``n_chars``
    follows the text where it changed. Spans are told by id, so rows of an id
    that stands with several different texts are left as they are. Other
    columns come back unchanged, whatever their names.
    """
    import re

    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    spans = shared_passages(plain, **options).groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("_spans"))
    hashed = plain.select("doc_id", F.xxhash64("text").alias("h")).groupBy("doc_id").agg(F.min("h").alias("a"), F.max("h").alias("b"))
    spans = spans.join(hashed.filter("a <> b").select("doc_id"), "doc_id", "left_anti")
    spans = written(spans.withColumnRenamed("doc_id", "_id"), "spans")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        word = re.compile(r"[^\x20\x09-\x0D]+")
        out = []
        for text, own in zip(texts, cuts, strict=True):
            if own is None or not text:
                out.append(text)
                continue
            starts = [m.start() for m in word.finditer(text)] + [len(text)]
            drop = np.zeros(len(starts) - 1, bool)
            for x in own:
                drop[x["start"] : x["end"]] = True
            out.append(text[: starts[0]] + "".join(text[starts[i] : starts[i + 1]] for i in np.flatnonzero(~drop)))
        return pd.Series(out)

    rows = docs.select(F.col(id_col).alias("_key"), F.col(text_col).alias("_body"), F.struct(*docs.columns).alias("_row"))
    joined = rows.join(spans, rows["_key"] == spans["_id"], "left").withColumn("_cut", cut("_body", "_spans"))
    left = joined.filter(F.col("_spans").isNull() | (F.regexp_replace("_cut", r"[\x20\x09-\x0D]+", "") != ""))
    out = {c: F.col("_row")[c] for c in docs.columns}
    out[text_col] = F.col("_cut")
    if "n_chars" in out:
        length = F.length("_cut").cast(docs.schema["n_chars"].dataType)
        out["n_chars"] = F.when(F.col("_spans").isNotNull(), length).otherwise(out["n_chars"])
    return left.select(*[value.alias(c) for c, value in out.items()])
