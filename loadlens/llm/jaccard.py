"""Documents linked by the Jaccard similarity of their word shingles: T-occurrence search with DivideSkip.

A document that reaches similarity t with x holds at least T = t * |x| of the
shingles of x. All but T - 1 of x's inverted lists therefore suffice to find
it, so the longest lists are never merged: they are only probed.

1. Texts with the same shingles form a class; one text stands for it.
2. Shingles held by many documents are counted over the corpus; their lists are
   the long ones. A map of fixed size of these goes to the tasks.
3. Each text gives its |x| - T + 1 shingles with the shortest lists: rare ones
   by hash, long lists only where too few are rare. Spark's sort by shingle
   merges these short lists.
4. In each list every text is paired with the centres of the list, for each
   class of size the text with the fewest rare shingles, so a group of n near
   copies gives a few times n pairs. Pairs with enough lists in common are
   verified by binary search of the one's sorted shingles in the other's,
   stopped as soon as T is out of reach. Verified links are contracted.
5. Texts that share a list and are still in different components are paired
   and verified in the same way. Pairs inside a component cannot change it, and
   pairs between components are all looked at, so the components are exact.

Words are lower-cased in A to Z only. Null and blank texts have no shingles and
are linked with nothing; a text with fewer words than a shingle has one
shingle. Rows with a null id are returned with a null component. Rows with one
id are one vertex. Shingles are 64-bit hashes. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import keyed, let_through, place_map, ship, unkeyed, written
from loadlens.llm.components import components

# A list is long if tasks that saw its shingle ``OFTEN`` times saw it so often together.
LONG_LIST = 32
OFTEN = 3
COUNTED_AT_ONCE = 4_000_000
LONG_MAP_BYTES = 1 << 22
ID_MAP_BYTES = 1 << 22
CACHED_WORDS = 400_000
SALTS = 16


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, size: int):
        import xxhash

        self.size, self.known, self.hash = size, {}, xxhash.xxh3_64_intdigest
        self.powers = [pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(size + 1)]

    def words(self, text: str) -> np.ndarray:
        """A hash for each word."""
        words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six blanks only
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.hash(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def shingles(self, text: str) -> np.ndarray:
        """Hashes in rising order; each is a polynomial of its words' hashes, well mixed."""
        w = self.words(text)
        if not len(w):
            return w
        width = min(self.size, len(w))
        n = len(w) - width + 1
        with np.errstate(over="ignore"):
            h = np.full(n, np.uint64(width))
            for k in range(width):
                h += w[k : k + n] * np.uint64(self.powers[k + 1])
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            return np.unique(h ^ (h >> np.uint64(31)))


def needed(size: int, percent: int) -> int:
    """The least overlap that a set of this size has with one that is similar enough."""
    return -(-percent * size // 100)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * |a and b| >= percent * |a or b|; both sorted.

    The smaller set's shingles are looked up in the larger by binary search, a
    stretch at a time, until enough are found or too many are missing.
    """
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b) or not len(a):
        return False
    least = -(-percent * (len(a) + len(b)) // (100 + percent))
    found = 0
    for lo in range(0, len(a), 256):
        part = a[lo : lo + 256]
        at = np.searchsorted(b, part)
        found += int((b[np.minimum(at, len(b) - 1)] == part).sum())
        if found + len(a) - lo - len(part) < least:
            return False
    return found >= least


def _signed(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, long_lists: np.ndarray | None) -> DataFrame:
    """id, n, digest of the set, ``short`` and ``long``: the shingles of the lists to merge."""
    shared = ship(docs.sparkSession).sparkContext.broadcast(long_lists)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        make, flags = Shingler(size), shared.value
        for batch in batches:
            out = []
            for text in batch["text"]:
                h = make.shingles(text or "")
                take = len(h) - needed(len(h), percent) + 1 if len(h) else 0
                if flags is None:
                    short, rest = h[:take], h[:0]
                else:
                    common = flags[h % np.uint64(len(flags))] > 0
                    short = h[~common][:take]
                    rest = h[common][: take - len(short)]
                digest = xxhash.xxh3_128_hexdigest(h.tobytes()) if len(h) else None
                out.append((len(h), digest, short.view(np.int64), rest.view(np.int64)))
            made = pd.DataFrame(out, columns=["n", "digest", "short", "long"])
            yield made.assign(id=batch["id"].values)[["id", "n", "digest", "short", "long"]]

    schema = "id string, n long, digest string, short array<long>, long array<long>"
    return keyed(docs, id_col, text=text_col).mapInPandas(run, schema)


def _long_lists(docs: DataFrame, id_col: str, text_col: str, size: int) -> np.ndarray:
    """The map of shingles with long lists, counted over all shingles of all documents.

    A task counts its distinct texts' shingles a few million at a time and
    passes on those it has seen ``OFTEN`` times, so what is shuffled follows
    the repetition in the corpus and not its size. Which shingles are taken
    for long decides what the search costs, not what it finds.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make, held, n, seen = Shingler(size), [], 0, set()

        def often() -> pd.DataFrame:
            h, count = np.unique(np.concatenate(held), return_counts=True)
            keep = count >= OFTEN
            return pd.DataFrame({"h": h[keep].view(np.int64), "c": count[keep]})

        for batch in batches:
            for text in batch["text"]:
                h = make.shingles(text or "")
                key = hash(h.tobytes())
                if not len(h) or key in seen:
                    continue
                seen.add(key)
                held.append(h)
                n += len(h)
                if n >= COUNTED_AT_ONCE:
                    yield often()
                    held, n, seen = [], 0, set()
        if held:
            yield often()

    counts = keyed(docs, id_col, text=text_col).mapInPandas(run, "h long, c long")
    many = counts.groupBy("h").agg(F.sum("c").alias("c")).filter(F.col("c") >= LONG_LIST)
    # A hash is taken as unsigned in numpy; 2^64 is a multiple of the map's size, so the remainder is the same.
    return place_map(many.select("h"), LONG_MAP_BYTES)


def _in_lists(reps: DataFrame) -> DataFrame:
    """h, rep, n, rare of the texts in lists of two or more; a long list's rows are dealt out over salts.

    ``rare`` is how many short lists the text is in.
    """
    own = ("rep", "n", F.size("short").alias("rare"))
    each = reps.select(*own, F.explode("short").alias("h"), F.lit(False).alias("long"))
    rows = each.unionByName(reps.select(*own, F.explode("long").alias("h"), F.lit(True).alias("long")))
    salt = F.when(F.col("long"), F.pmod(F.xxhash64("rep"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    rows = rows.withColumn("salt", salt).repartition("h", "salt").sortWithinPartitions("h", "salt")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            h, s = batch["h"].to_numpy(), batch["salt"].to_numpy()
            same = (h[1:] == h[:-1]) & (s[1:] == s[:-1])
            keep = batch["long"].to_numpy().copy()
            keep[1:] |= same
            keep[:-1] |= same
            held = batch.iloc[[-1]] if not keep[-1] else None
            if held is None:  # the list may go on: its next row is kept if it is told that one came before
                last = batch.iloc[[-1]].assign(rep=None)
                held = last
            out = batch[keep & batch["rep"].notna().to_numpy()]
            if len(out):
                yield out
        # A row that is held at the end is alone in its list.

    return rows.mapInPandas(run, rows.schema)


def _possible(percent: int) -> str:
    """Whether two texts of one list can be similar: by size and, on a long list, by what they cannot share.

    Texts of a long list have all their rare shingles in short lists. Those
    of a pair that shares no short list are in neither's overlap; a pair that
    shares one meets there.
    """
    most = "least(n - rare, m - rarer)"
    return (
        f"100 * least(n, m) >= {percent} * greatest(n, m) AND (NOT long OR (100 + {percent}) * {most} >= {percent} * (n + m))"
    )


def _enough(met: DataFrame, percent: int) -> DataFrame:
    """a, b of the pairs whose lists in common leave the overlap in reach.

    Lists are merged in one order for all texts, short ones first. Past the
    end of the merged part that ends first, a pair shares at most what that
    text has left; the rest of the overlap stands in merged lists. For a pair
    that shares short lists the merged part is those; for one that shares
    none it is all of them, and T - 1 shingles are left.
    """
    found = met.withColumn("rest", F.expr("greatest(n - rare, m - rarer)")).groupBy(
        F.greatest("rep", "head").alias("a"), F.least("rep", "head").alias("b"), F.least("n", "m").alias("n"),
        F.greatest("n", "m").alias("m"), "rest",
    ).agg(F.count(F.expr("if(long, NULL, 1)")).alias("few"), F.count(F.expr("if(long, 1, NULL)")).alias("many"))
    least = f"ceil({percent} * (n + m) / {100 + percent})"
    by_short = f"few > 0 AND few >= {least} - rest"
    by_long = f"many > 0 AND many >= {least} - ceil({percent} * m / 100) + 1"
    return found.filter(f"({by_short}) OR ({by_long})").select("a", "b")


def _centre_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Every text with the centres of its list: of those about as large, the text with the fewest rare shingles."""
    step = -math.log(percent / 100) if percent < 100 else 1.0
    sized = lists.withColumn("class", F.floor(F.log("n") / F.lit(step)))
    best = F.min(F.struct("rare", F.xxhash64("rep").alias("tie"), F.col("rep").alias("head"), F.col("n").alias("m")))
    heads = sized.groupBy("h", "class").agg(best.alias("c")).select("h", "class", "c.head", "c.m", F.col("c.rare").alias("rarer"))
    asked = sized.withColumn("class", F.explode(F.array(*[F.col("class") + k for k in (-1, 0, 1)])))
    met = asked.join(heads, ["h", "class"]).filter("rep <> head").filter(_possible(percent))
    return _enough(met, percent)


def _other_pairs(lists: DataFrame, parts: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """Texts of one list in different components that no pair has been tested for."""
    own = lists.join(parts, lists["rep"] == parts["vertex"], "left").select(
        "h", "rep", "n", "rare", "long", F.coalesce("component", "rep").alias("part")
    )
    mixed = own.groupBy("h").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo <> hi").select("h")
    left = own.join(mixed, "h", "left_semi")
    names = {"rep": "head", "n": "m", "rare": "rarer", "part": "other"}
    right = left.drop("long").withColumnsRenamed(names)
    met = left.join(right, "h").filter("rep > head AND part <> other").filter(_possible(percent))
    pairs = _enough(met, percent)
    return pairs.join(tested, ["a", "b"], "left_anti")


def _verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """The pairs that are similar enough. Only texts that a map of the pairs' ids lets through are moved."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    flags = place_map(ids.select(F.xxhash64("id").alias("h")), ID_MAP_BYTES)
    texts = let_through(docs.filter(F.col(text_col).isNotNull()), id_col, text_col, flags)
    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    both = left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make, last, held = Shingler(size), None, None
        for batch in batches:
            good = []
            for ta, tb in zip(batch["ta"], batch["tb"], strict=True):
                if tb != last:
                    last, held = tb, make.shingles(tb)
                good.append(similar(make.shingles(ta), held, percent))
            yield batch.loc[good, ["a", "b"]]

    kind = pairs.schema["a"].dataType.simpleString()
    return both.select("a", "b", "ta", "tb").mapInPandas(run, f"a {kind}, b {kind}")


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 85) -> DataFrame:
    """Per document: id, ``n_shingles`` and ``component_id``, the smallest id that links lead to."""
    long_lists = _long_lists(docs, id_col, text_col, size)
    signed = unkeyed(_signed(docs, id_col, text_col, size, percent, long_lists), docs, id_col)
    signed = written(signed.withColumnRenamed(id_col, "doc"), "signed")
    own = signed.filter("digest IS NOT NULL AND doc IS NOT NULL")
    classes = own.groupBy("digest").agg(F.min("doc").alias("rep"), F.count("*").alias("copies"))
    reps = own.join(classes.select("rep", "digest"), (own["doc"] == F.col("rep")) & (own["digest"] == classes["digest"])).drop(classes["digest"])
    reps = reps.groupBy("rep", "digest").agg(*[F.first(c).alias(c) for c in ("n", "short", "long")])
    lists = written(_in_lists(reps), "lists")
    centred = written(_centre_pairs(lists, percent), "pairs")
    links = written(_verified(centred, docs, id_col, text_col, size, percent), "links")
    parts = components(links)
    others = written(_other_pairs(lists, parts, centred, percent), "pairs")
    more = written(_verified(others, docs, id_col, text_col, size, percent), "links")
    copies = own.join(classes.filter("copies > 1"), "digest").filter("doc <> rep").select(F.col("doc").alias("a"), F.col("rep").alias("b"))
    whole = components(links.unionByName(more).unionByName(copies))
    result = signed.select("doc", "n").join(whole, signed["doc"] == whole["vertex"], "left")
    return result.select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")
    )


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that a document of smaller id is linked to; empty texts stay."""
    found = linked(docs, size=size, percent=percent)
    gone = written(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
