"""Token counts of a byte-level BPE vocabulary at every prefix, by dynamic programming.

A sequence of tokens is what the merges make of a text if each pair of
neighbours is (a pair that the merges leave apart). So the last token of every
prefix follows from shorter prefixes: among the vocabulary's tokens that end
there, it is the one whose left neighbour, the last token of the rest, it
stands well beside. The count at a prefix is one more than at that rest.

The vocabulary merges within pre-tokens only, so the table of a text is made
of its pre-tokens' tables. A task builds the table of each distinct pre-token
once; tables are cleared at a set number, so memory is bounded.

``count_prefixes`` answers from the tables without encoding again: tokens in
all, and for each budget the longest prefix that fits. ``prefix_counts`` is the
whole table of a text, one count for each prefix in characters.

Null texts count as empty. Rows keep their order and number; columns other than
the id and the text are ignored. Special strings inside a text are one token
each, as the library does by default.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.llm.common import keyed, shared_model, unkeyed

TABLE_PIECES = 800_000
# How a byte-level vocabulary cuts a text before the merges.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_RUN = re.compile(r" \s")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself, or the next free code from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class PrefixCounter:
    """Prefix tables of distinct pre-tokens under one vocabulary."""

    def __init__(self, body: bytes, limit: int = TABLE_PIECES):
        import ahocorasick
        import regex

        model = json.loads(body)
        kind = model.get("pre_tokenizer") or {}
        if model["model"]["type"] != "BPE" or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space"):
            raise ValueError("not a byte-level BPE vocabulary without a prefix space")
        vocab, merges = model["model"]["vocab"], model["model"]["merges"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        self.rank = {p: k for k, p in enumerate(pairs)}
        self.halves = {a + b: (a, b) for a, b in reversed(pairs)}
        letters = byte_letters()
        self.letters = {b: c for b, c in enumerate(letters)}
        # Only tokens that the merges reach can be part of an encoding.
        self.tokens = set(vocab) & (set(self.halves) | set(letters))
        self.found = ahocorasick.Automaton()
        for token in self.tokens:
            self.found.add_word(token, token)
        self.found.make_automaton()
        self.direct = len(self.halves) == len(pairs)  # each token has one merge, so its growth is known
        self.edges: tuple[dict, dict] = {}, {}
        self.apart: dict[tuple[str, str], bool] = {}
        special = [t["content"] for t in model.get("added_tokens") or ()]
        special.sort(key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.cut, self.blank = regex.compile(PIECES), regex.compile(r"\s*")
        self.limit = limit
        self.totals: dict[str, int] = {}
        self.stretches: dict[str, int] = {}

    def merged(self, text: str) -> list[str]:
        """The merges applied to a short text, lowest rank first; used to judge pairs of tokens."""
        parts = list(text)
        while len(parts) > 1:
            ranked = [(self.rank.get(p, 1 << 60), k) for k, p in enumerate(zip(parts, parts[1:], strict=False))]
            best, k = min(ranked)
            if best == 1 << 60:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def edge(self, token: str, right: bool) -> list[tuple[str, int, int]]:
        """The tokens that stood at one edge while the token grew: each with the rank that made it and that ended it."""
        known = self.edges[right].get(token)
        if known is None:
            known, end = [], 1 << 60
            while token in self.halves:
                halves = self.halves[token]
                made = self.rank[halves]
                known.append((token, made, end))
                token, end = halves[right], made
            known.append((token, -1, end))
            self.edges[right][known[0][0]] = known
        return known

    def stands(self, left: str, right: str) -> bool:
        """Whether the merges leave the two tokens as neighbours.

        They do unless some token at the left one's edge and some token at
        the right one's edge exist at one time and merge before either grows.
        """
        key = (left, right)
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) > self.limit:
                self.apart = {}
            known = self._stands(left, right) if self.direct else self.merged(left + right) == [left, right]
            self.apart[key] = known
        return known

    def _stands(self, left: str, right: str) -> bool:
        rank = self.rank.get
        for a, made_a, end_a in self.edge(left, True):
            for b, made_b, end_b in self.edge(right, False):
                if made_a <= end_b and made_b < end_a:
                    joined = rank((a, b))
                    if joined is not None and joined < end_a and joined <= end_b:
                        return False
        return True

    def table(self, piece: str) -> list[int]:
        """Counts at the prefixes of a pre-token's byte letters, from 0 on."""
        n, apart = len(piece), self.apart
        counts, last = [0] * (n + 1), [""] * (n + 1)
        for at, token in self.found.iter(piece):  # every token that ends at each place, place by place
            end = at + 1
            if last[end]:
                continue
            start = end - len(token)
            if start == 0:
                ok = self.direct or self.merged(token) == [token]
            else:
                ok = apart.get((last[start], token))
                if ok is None:
                    ok = self.stands(last[start], token)
                    apart = self.apart
            if ok:
                counts[end], last[end] = counts[start] + 1, token
        if "" in last[1:]:
            raise ValueError("no token ends somewhere; the vocabulary lacks a byte")
        return counts

    def spelled(self, piece: str) -> str:
        letters = self.letters
        return "".join([letters[b] for b in piece.encode("utf-8", "surrogatepass")])

    def total(self, piece: str) -> int:
        """Tokens of a pre-token."""
        known = self.totals.get(piece)
        if known is None:
            if len(self.totals) >= self.limit:
                self.totals = {}
            known = self.totals[piece] = self.table(self.spelled(piece))[-1]
        return known

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """Pre-tokens and special strings, in order."""
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            yield from ((p, False) for p in self.cut.findall(text[at : found.start()]))
            yield found.group(), True
            at = found.end()
        yield from ((p, False) for p in self.cut.findall(text[at:] if at else text))

    def count(self, text: str) -> int:
        """Tokens of a text."""
        if self.special is not None and self.special.search(text):
            return sum(1 if whole else self.total(p) for p, whole in self.parts(text))
        if _RUN.search(text):
            return sum(map(self.total, self.cut.findall(text)))
        # A blank before anything but white space begins a pre-token, so the stretches between blanks are independent.
        first, *rest = text.split(" ")
        if len(self.stretches) > self.limit:
            self.stretches = {}
        known = self.stretches
        for new in set(rest).difference(known):
            known[new] = sum(map(self.total, self.cut.findall(" " + new)))
        return sum(map(self.total, self.cut.findall(first))) + sum(map(known.__getitem__, rest))

    def longest_prefix(self, text: str, budget: int) -> int:
        """Characters of the longest prefix whose count is in the budget.

        Counts at the starts of pre-tokens never fall, so the place is found
        from totals; inside the stretch around it every prefix is looked up.
        """
        at = used = low_at = low_used = special_end = 0
        free = True  # the next pre-token does not go on with a run of white space
        for piece, whole in self.parts(text):
            if free and not (whole and at > special_end):  # a part of a special string could join what stands before it
                if used > budget:
                    break
                low_at, low_used = at, used
            used += 1 if whole else self.total(piece)
            at += len(piece)
            free = whole or not self.blank.fullmatch(piece)
            special_end = at if whole else special_end
        counts = self.all_prefixes(text[low_at:at])
        return low_at + max(k for k, n in enumerate(counts) if low_used + n <= budget)

    def prefixes(self, piece: str) -> list[int]:
        """Counts at the character prefixes of a pre-token."""
        if len(piece) == 3 and piece in ("'re", "'ve", "'ll"):  # its first two characters are two pre-tokens
            return [0, self.total("'"), self.total("'") + self.total(piece[1]), self.total(piece)]
        counts, out, at = self.table(self.spelled(piece)), [0], 0
        for char in piece:
            at += len(char.encode("utf-8", "surrogatepass"))
            out.append(counts[at])
        return out

    def all_prefixes(self, text: str) -> list[int]:
        """Counts at all character prefixes, each as if the text ended there.

        A text that ends in a run of white space has the run as one
        pre-token, and one that ends in a part of a special string has that
        part as plain text.
        """
        out, used, segment, run = [0], 0, 0, None
        for piece, whole in self.parts(text):
            at = len(out) - 1
            if whole:
                before = out[segment]
                out += [before + self.count(text[segment : at + k]) for k in range(1, len(piece))]
                used += 1
                out.append(used)
                segment, run = at + len(piece), None
                continue
            lead = self.blank.match(piece).end()
            if lead and run is None:
                run = at, used
            if lead:
                start, before = run
                # One table of the run has the count at each of its prefixes.
                counts = self.prefixes(text[start : at + lead])
                out += [before + n for n in counts[at - start + 1 :]]
            inner = self.prefixes(piece) if lead < len(piece) else ()
            out += [used + n for n in inner[lead + 1 :]]
            used += self.total(piece)
            if lead < len(piece):
                run = None
        return out


_COUNTERS: dict[tuple[int, int], PrefixCounter] = {}


def _counter(body: bytes, limit: int) -> PrefixCounter:
    key = (hash(body), limit)
    if key not in _COUNTERS:
        _COUNTERS[key] = PrefixCounter(body, limit)
    return _COUNTERS[key]


def count_prefixes(
    docs: DataFrame, model_path: str, budgets: tuple[int, ...] = (1024,), id_col: str = "doc_id", text_col: str = "text",
    limit: int = TABLE_PIECES,
) -> DataFrame:
    """Per document: id, n_bytes, n_tokens, and ``fits_<budget>``, the characters that fit each budget."""
    model = shared_model(docs, model_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(model.value, limit)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            totals = [counter.count(t) for t in texts]
            out = {"id": batch["id"], "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts], "n_tokens": totals}
            for b in budgets:
                out[f"fits_{b}"] = [len(t) if n <= b else counter.longest_prefix(t, b) for t, n in zip(texts, totals, strict=True)]
            yield pd.DataFrame(out)

    names = ["n_bytes", "n_tokens", *[f"fits_{b}" for b in budgets]]
    schema = T.StructType([T.StructField("id", T.StringType()), *[T.StructField(n, T.LongType()) for n in names]])
    return unkeyed(keyed(docs, id_col, text=text_col).mapInPandas(run, schema), docs, id_col)


def prefix_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = TABLE_PIECES) -> DataFrame:
    """Per document the id and ``prefix_counts``, an int for each prefix from 0 characters to all."""
    model = shared_model(docs, model_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(model.value, limit)
        for batch in batches:
            yield pd.DataFrame(
                {"id": batch["id"], "prefix_counts": [np.asarray(counter.all_prefixes(t or ""), "int32") for t in batch["text"]]}
            )

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("prefix_counts", T.ArrayType(T.IntegerType()))])
    return unkeyed(keyed(docs, id_col, text=text_col).mapInPandas(run, schema), docs, id_col)
