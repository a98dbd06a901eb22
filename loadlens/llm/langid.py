"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram binds its letters,
the first one's vector rotated by two places, the second's by one, by
multiplication; a document bundles its trigrams by addition. A language's
prototype is the sum of its documents' bundles, and a document is given the
language whose prototype has the greatest cosine with its own bundle.

Vectors follow from the letter alone (a seeded generator), so every task makes
the same ones. Bundles are linear, so training sums trigram counts in each
task before binding and Spark adds the vectors up over all documents: there is
no sample. What reaches the driver is one vector for each language.

Texts are lower-cased; runs of characters that are no letters are one blank.
A null text, or one without a letter, is ``und`` with score 0, as are all
texts if nothing could be learned. Ties take the first language by name.
Documents with null language, and those held out, are not learned from.
Repeated rows count as often as they occur; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.llm.common import keyed, ship, unkeyed

DIMENSIONS = 512
SEED = 20240
# Characters of text that are worked on at once, and trigrams that are bound at once.
SLICE_CHARS = 1_000_000
BOUND_AT_ONCE = 4096
_CODES = 0x110000
_LETTERS: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """For every code point whether it is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(_CODES)), bool, _CODES))
    return _LETTERS[0]


def letter_vector(code: int, dimensions: int, seed: int) -> np.ndarray:
    """The +1 and -1 of a code point; 0 stands for the blank."""
    return np.random.default_rng([seed, code]).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1


class Binder:
    """Vectors of letters and trigrams; a trigram is one integer of three 21-bit code points."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed, self.letters = dimensions, seed, {}

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) > 20_000:
                self.letters = {}
            self.letters[code] = letter_vector(code, self.dimensions, self.seed)
        return self.letters[code]

    def bound(self, trigrams: np.ndarray) -> np.ndarray:
        """One row for each trigram."""
        parts = []
        for shift, turn in ((42, 2), (21, 1), (0, 0)):
            codes, back = np.unique((trigrams >> shift) & 0x1FFFFF, return_inverse=True)
            parts.append(np.stack([np.roll(self._letter(int(c)), turn) for c in codes])[back])
        return (parts[0] * parts[1] * parts[2]).astype(np.float32)


def trigrams_of(text: str) -> np.ndarray:
    """The trigrams of the letters with one blank at each end and between words."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes = np.where(_is_letter()[codes], codes, 0)
    codes = np.concatenate(([0], codes, [0]))
    codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
    if len(codes) < 3:  # blanks only
        return np.empty(0, np.int64)
    return (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of rows of about a set number of characters."""
    at = size = 0
    for k, t in enumerate(texts):
        size += len(t) + 64
        if size >= SLICE_CHARS:
            yield at, k + 1
            at, size = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


# Up to so many distinct letters, the trigrams of a slice are counted in an array of their cube.
DENSE_LETTERS = 128


def _counts(texts: list[str], groups: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams, and for each occurrence its group and its trigram's place."""
    grams = [trigrams_of(t) for t in texts]
    owner = np.repeat(np.asarray(groups, np.int64), [len(g) for g in grams])
    every = np.concatenate(grams) if grams else np.empty(0, np.int64)
    present = np.zeros(_CODES, bool)
    for shift in (42, 21, 0):
        present[(every >> shift) & 0x1FFFFF] = True
    letters = np.flatnonzero(present)
    if len(letters) > DENSE_LETTERS:
        vocabulary, place = np.unique(every, return_inverse=True)
        return vocabulary, owner, place
    k, number = len(letters), np.zeros(_CODES, np.int64)
    number[letters] = np.arange(k)
    cell = (number[every >> 42] * k + number[(every >> 21) & 0x1FFFFF]) * k + number[every & 0x1FFFFF]
    used = np.flatnonzero(np.bincount(cell, minlength=k**3))
    where = np.zeros(k**3, np.int64)
    where[used] = np.arange(len(used))
    vocabulary = (letters[used // (k * k)] << 42) | (letters[used // k % k] << 21) | letters[used % k]
    return vocabulary, owner, where[cell]


def _bundles(binder: Binder, texts: list[str], groups: list[int], n: int) -> np.ndarray:
    """The bundle of each group, ``n`` rows."""
    vocabulary, owner, place = _counts(texts, groups)
    out = np.zeros((n, binder.dimensions), np.float64)
    order = np.argsort(place, kind="stable") if len(vocabulary) > BOUND_AT_ONCE else None
    for at in range(0, len(vocabulary), BOUND_AT_ONCE):
        end = min(at + BOUND_AT_ONCE, len(vocabulary))
        if order is None:
            own, where = owner, place
        else:
            lo, hi = np.searchsorted(place, [at, end], sorter=order)
            own, where = owner[order[lo:hi]], place[order[lo:hi]] - at
        counts = np.bincount(own * (end - at) + where, minlength=n * (end - at)).reshape(n, end - at)
        out += counts.astype(np.float32) @ binder.bound(vocabulary[at:end])
    return out


def prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """``lang``, ``vector``: the bundle of all documents of each language."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        binder, sums = Binder(dimensions, seed), {}
        for batch in batches:
            texts = list(batch["text"])
            names = sorted(set(batch["lang"]))
            index = {n: k for k, n in enumerate(names)}
            groups = [index[x] for x in batch["lang"]]
            for lo, hi in _slices(texts):
                made = _bundles(binder, texts[lo:hi], groups[lo:hi], len(names))
                for name, k in index.items():
                    sums[name] = sums.get(name, 0) + made[k]
        for name, vector in sums.items():
            yield pd.DataFrame({"lang": name, "place": np.arange(dimensions, dtype=np.int32), "value": vector})

    ship(docs.sparkSession)
    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    parts = known.mapInPandas(run, "lang string, place int, value double")
    sums = parts.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    ordered = F.sort_array(F.collect_list(F.struct("place", "value")))
    return sums.groupBy("lang").agg(F.transform(ordered, lambda x: x["value"]).alias("vector"))


def predict(
    docs: DataFrame, learned: DataFrame, id_col: str = "doc_id", text_col: str = "text", dimensions: int = DIMENSIONS, seed: int = SEED,
) -> DataFrame:
    """Per document: id, ``lang_pred`` and ``score``, the greatest cosine, 0 at least."""
    rows = sorted(((r["lang"], r["vector"]) for r in learned.collect()), key=lambda r: r[0])  # one for each language
    names = [r[0] for r in rows]
    matrix = np.asarray([r[1] for r in rows], np.float64).reshape(len(rows), dimensions)
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix = matrix / np.where(lengths == 0, 1, lengths)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        binder = Binder(dimensions, seed)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            langs, scores = [], []
            for lo, hi in _slices(texts):
                made = _bundles(binder, texts[lo:hi], list(range(hi - lo)), hi - lo)
                norms = np.linalg.norm(made, axis=1, keepdims=True)
                if not names:
                    langs += ["und"] * (hi - lo)
                    scores += [0.0] * (hi - lo)
                    continue
                cosines = made @ matrix.T / np.where(norms == 0, 1, norms)
                best = cosines.argmax(axis=1)
                told = norms[:, 0] > 0
                langs += [names[k] if ok else "und" for k, ok in zip(best, told, strict=True)]
                scores += list(np.where(told, np.clip(cosines[np.arange(hi - lo), best], 0, 1), 0.0))
            yield pd.DataFrame({"id": batch["id"], "lang_pred": langs, "score": scores})

    ship(docs.sparkSession)
    schema = T.StructType(
        [T.StructField("id", T.StringType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return unkeyed(keyed(docs, id_col, text=text_col).mapInPandas(run, schema), docs, id_col)


def held_out(id_col: Column) -> Column:
    """Every fifth document by the checksum of its id."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
