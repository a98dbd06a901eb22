"""Repair of conversations by generalised LR parsing with edits.

The roles of a sound conversation are words of the grammar below: an optional
system turn, then pairs of user and assistant. A parse keeps a graph-structured
stack; every turn may be kept, given another role, or deleted, and an empty
turn may be inserted before it, each at a cost. Stack tops that become equal
are merged into the one with the smaller (cost, audit), where the audit is the
string of the edits' initials. Two audits of equal cost over the same turns are
never prefixes of one another (they would differ in insertions alone), so the
smaller of two stays smaller whatever follows, and parses can be cut anywhere.

Turns are sorted by conversation, turn (nulls first), role and text and dealt
in ranges, so a conversation of any size spreads over many tasks. Conversations
inside a range are repaired there. Those at the edge of a range go on in chunks
of bounded size: first occurrences of (role, text) are settled by a small join,
each chunk is parsed from every possible stack, the chunks' results are linked
in order, and each chunk then writes its own part of the repaired turns. Only
edits and costs pass through one task, never the texts; hashing a conversation
is sequential and streams one part at a time.

Turn numbers are whole numbers. Null roles and texts are one blank; an empty
role has no initial and cannot be kept. A null conversation id is a conversation
of its own. Turns that share a number are ordered by role and digest of the
text; repeated rows are duplicates.
Texts of any length are one cell. Other columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import WORD_SPACE, ship, written

# Start symbol first. Terminals are the initials of roles.
GRAMMAR = (
    ("conversation", ()),
    ("conversation", ("turns",)),
    ("turns", ("first",)),
    ("turns", ("turns", "u", "a")),
    ("first", ("u", "a")),
    ("first", ("s", "u", "a")),
)
TERMINALS = ("s", "u", "a")
MADE = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LEGAL = {"su", "ua", "au"}
CHUNK = 256

# LR(0) automaton: a state is a set of (rule, dot).


def _closure(items: Iterable[tuple[int, int]]) -> frozenset:
    found, todo = set(items), list(items)
    while todo:
        rule, dot = todo.pop()
        body = GRAMMAR[rule][1]
        for k, (head, _) in enumerate(GRAMMAR):
            if dot < len(body) and head == body[dot] and (k, 0) not in found:
                found.add((k, 0))
                todo.append((k, 0))
    return frozenset(found)


@lru_cache(None)
def _goto(state: frozenset, symbol: str) -> frozenset:
    return _closure([(r, d + 1) for r, d in state if d < len(GRAMMAR[r][1]) and GRAMMAR[r][1][d] == symbol])


START = (_closure([(r, 0) for r, (head, _) in enumerate(GRAMMAR) if head == GRAMMAR[0][0]]), None)


def _reduced(node: tuple) -> list[tuple]:
    """The node and all it reduces to; a node is a state and the node below it."""
    found = [node]
    for top in found:
        for rule, dot in top[0]:
            head, body = GRAMMAR[rule]
            if dot == len(body) and head != GRAMMAR[0][0]:
                below = top
                for _ in body:
                    below = below[1]
                new = (_goto(below[0], head), below)
                if new not in found:
                    found.append(new)
    return found


@lru_cache(None)
def after(node: tuple, terminal: str) -> tuple:
    """The tops that follow when a terminal is shifted: those that can shift another one."""
    state = _goto(node[0], terminal)
    if not state:
        return ()
    return tuple(n for n in _reduced((state, node)) if any(_goto(n[0], t) for t in TERMINALS))


@lru_cache(None)
def accepts(node: tuple) -> bool:
    """Whether the turns so far make a whole conversation."""
    return any(
        GRAMMAR[r][0] == GRAMMAR[0][0] and d == len(GRAMMAR[r][1]) for n in _reduced(node) for r, d in n[0]
    )


def _all_tops() -> list[tuple]:
    found = [START]
    for node in found:
        for t in TERMINALS:
            found.extend(n for n in after(node, t) if n not in found)
    return found


TOPS = _all_tops()
NUMBER = {node: k for k, node in enumerate(TOPS)}

# A parse: for each top the least (cost, audit) that leads to it.
Parse = dict[tuple, tuple[int, str]]


def _put(tops: Parse, node: tuple, cost: int, audit: str) -> bool:
    if node not in tops or (cost, audit) < tops[node]:
        tops[node] = (cost, audit)
        return True
    return False


def with_insertions(tops: Parse) -> Parse:
    """The tops and all that inserted turns reach."""
    found = dict(tops)
    todo = list(found)
    while todo:
        node = todo.pop()
        cost, audit = found[node]
        for t in MADE:
            todo.extend(n for n in after(node, t) if _put(found, n, cost + INSERT, audit + "I"))
    return found


def parse(kinds: str, tops: Parse) -> Parse:
    """The tops after some turns.

    A turn's kind is ``d`` if it must go, else its role's initial (``x`` if that is none of the grammar), in capitals
    if its text is cut off.
    """
    for kind in kinds:
        new: Parse = {}
        role = kind.lower()
        extra = TRUNCATED if kind != role else 0
        for node, (cost, audit) in with_insertions(tops).items():
            _put(new, node, cost + DELETE, audit + "D")
            if kind == "d":
                continue
            for n in after(node, role) if role in TERMINALS else ():
                _put(new, n, cost + KEEP + extra, audit + "K")
            for t in MADE:
                for n in after(node, t):
                    _put(new, n, cost + REROLE + extra, audit + "R")
        tops = new
    return tops


def finish(tops: Parse) -> tuple[int, str]:
    """The least (cost, audit) of a whole conversation."""
    return min(v for node, v in with_insertions(tops).items() if accepts(node))


@lru_cache(1 << 14)
def _short(kinds: str) -> tuple[int, str]:
    return finish(parse(kinds, {START: (0, "")}))


def cheapest(kinds: str) -> tuple[int, str]:
    """Cost and audit of the repair of a conversation's turns."""
    if len(kinds) <= 64:
        return _short(kinds)
    link = Linker()
    for k in range(0, len(kinds), CHUNK):
        link.add(k, paths(kinds[k : k + CHUNK]))
    return link.end()[0], "".join(audit for _, _, audit in link.settled)


@lru_cache(1 << 10)
def paths(kinds: str) -> list[tuple[int, int, int, str]]:
    """For every top to begin with and every top reached: the numbers of both, least cost and audit."""
    return [
        (NUMBER[start], NUMBER[n], cost, audit)
        for start in TOPS
        for n, (cost, audit) in parse(kinds, {start: (0, "")}).items()
    ]


class Linker:
    """Chunks of a conversation put together in order; what all tops agree on is settled and leaves the comparison."""

    def __init__(self):
        self.tops: dict[int, tuple[int, str]] = {0: (0, "")}
        self.steps: dict[int, tuple] = {0: ()}
        self.settled: list[tuple] = []

    def add(self, chunk, found: list[tuple[int, int, int, str]]) -> None:
        new: dict[int, tuple[int, str]] = {}
        steps: dict[int, tuple] = {}
        for start, end, cost, audit in found:
            if start in self.tops:
                so_far = (self.tops[start][0] + cost, self.tops[start][1] + audit)
                if end not in new or so_far < new[end]:
                    new[end], steps[end] = so_far, (self.steps[start], (chunk, start, audit))
        self.tops, self.steps = new, steps
        self._settle()

    def _settle(self) -> None:
        """Steps that lead to every top are the same list, as lists share their beginnings."""
        rows = {k: self._listed(s) for k, s in self.steps.items()}
        shared = 0
        first = next(iter(rows.values()))
        while all(shared < len(r) and r[shared] == first[shared] for r in rows.values()):
            shared += 1
        if shared:
            self.settled += first[:shared]
            gone = sum(len(audit) for _, _, audit in first[:shared])
            for k, r in rows.items():
                steps: tuple = ()
                for step in r[shared:]:
                    steps = (steps, step)
                self.steps[k] = steps
                self.tops[k] = (self.tops[k][0], self.tops[k][1][gone:])

    @staticmethod
    def _listed(steps: tuple) -> list[tuple]:
        out = []
        while steps:
            steps, step = steps
            out.append(step)
        return out[::-1]

    def end(self) -> tuple[int, str]:
        """The cost, and the insertions after the last turn; all steps are settled then."""
        best = None
        for k, (cost, audit) in self.tops.items():
            for node, (more, tail) in with_insertions({TOPS[k]: (0, "")}).items():
                if accepts(node) and (best is None or (cost + more, audit + tail) < best[:2]):
                    best = (cost + more, audit + tail, k, tail)
        last = self._listed(self.steps[best[2]])
        self.settled += last
        if best[3]:
            self.settled.append((None, best[2], best[3]))
        return best[0], best[3]


def repaired_lines(audit: str, roles: list[str], texts: list[str], top: int = 0) -> list[str]:
    """The turns that an audit leaves or makes, each as ``role:text``."""
    node, k, out = TOPS[top], 0, []
    for edit in audit:
        made = next((t for t in MADE if after(node, t)), None)
        if edit == "I":
            out.append(f"{MADE[made]}:")
        elif edit == "K":
            out.append(f"{roles[k]}:{texts[k]}")
            made = roles[k][:1]
        elif edit == "R":
            out.append(f"{MADE[made]}:{texts[k]}")
        k += edit != "I"
        if edit != "D":
            node = after(node, made)[0]
    return out


def kind_of(role: str, blank: bool, whole: bool, seen: bool) -> str:
    if blank or seen:
        return "d"
    initial = role[:1] if role[:1] in TERMINALS else "x"
    return initial if whole else initial.upper()


def illegal_pairs(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False))


# Spark

_COUNTS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
_SLICED = (
    f"key string, slice int, place bigint, {_COUNTS}, audit string, repaired string, turn string, role string, text string, "
    "mark string, seen boolean"
)
_ROW = ["turn", "role", "text", "blank", "whole", "mark"]


def _gaps(turns: list[int]) -> int:
    return turns[-1] - turns[0] + 1 - len(set(turns)) if turns else 0


def _repaired(key: str, rows: list[tuple]) -> tuple:
    """The finished row of a conversation that lies in one range."""
    turns, roles, texts, blanks, wholes, marks = (list(c) for c in zip(*rows, strict=True))
    met: set[str] = set()
    kinds, blank, duplicate, truncated = [], 0, 0, 0
    for role, is_blank, whole, mark in zip(roles, blanks, wholes, marks, strict=True):
        seen = mark in met
        met.add(mark)
        kinds.append(kind_of(role, is_blank, whole, seen))
        blank += is_blank
        duplicate += seen and not is_blank
        truncated += not (is_blank or seen or whole)
    cost, audit = cheapest("".join(kinds))
    gaps = _gaps([int(t) for t in turns if t is not None])
    lines = "\n".join(repaired_lines(audit, roles, texts))
    return (key, None, 0, gaps, blank, duplicate, truncated, illegal_pairs(roles), cost, audit, lines, *[None] * 4, None)


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Finished conversations of a range, and the rows of those at its edges."""
    number = TaskContext.get().partitionId()
    columns = [c.split()[0] for c in _SLICED.split(", ")]
    held: list[tuple] = []
    key, edge, place, met = None, True, 0, set()

    def open_row(row: tuple) -> tuple:
        nonlocal place
        turn, role, text, blank, whole, mark = row
        seen = mark in met
        met.add(mark)
        place += 1
        kind = kind_of(role, blank, whole, False)
        return (key, number, place - 1, *[None] * 6, kind, None, turn, role, text, mark, seen)

    for batch in batches:
        out = []
        for own, *row in batch[["key", *_ROW]].itertuples(index=False, name=None):
            if key is not None and own != key:
                if not edge:
                    out.append(_repaired(key, held))
                held, edge, place, met = [], False, 0, set()
            key = own
            row = tuple(None if c is None or c != c else c for c in row)
            if edge:
                out.append(open_row(row))
            else:
                held.append(row)
        if out:
            yield pd.DataFrame(out, columns=columns)
    if held:
        yield pd.DataFrame([open_row(row) for row in held], columns=columns)


_CHUNK = (
    "key string, slice int, chunk bigint, n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "first string, last string, turns array<bigint>, paths array<struct<start: int, end: int, cost: bigint, audit: string>>"
)


def _chunk(rows: pd.DataFrame, later: pd.DataFrame) -> pd.DataFrame:
    """One chunk parsed from every top; ``later`` has places of rows that an earlier range has too."""
    if len(rows) == 0:
        return pd.DataFrame(columns=[c.split()[0] for c in _CHUNK.split(", ")[:11]] + ["paths"])
    rows = rows.sort_values("place")
    roles, plain = rows["role"].tolist(), rows["audit"].tolist()
    seen = (rows["seen"] | rows["place"].isin(later["place"])).tolist()
    kinds = "".join("d" if s else k for s, k in zip(seen, plain, strict=True))
    turns = sorted({int(t) for t in rows["turn"] if t is not None and t == t})
    told = {
        "key": rows["key"].iloc[0], "slice": rows["slice"].iloc[0], "chunk": rows["chunk"].iloc[0], "n": len(rows),
        "blank": plain.count("d"), "duplicate": sum(s and k != "d" for s, k in zip(seen, plain, strict=True)),
        "truncated": sum(k.isupper() for k in kinds), "illegal": illegal_pairs(roles),
        "first": roles[0][:1], "last": roles[-1][:1], "turns": turns,
        "paths": [dict(zip(("start", "end", "cost", "audit"), p, strict=True)) for p in paths(kinds)],
    }
    return pd.DataFrame([told])


_LINKED = f"key string, slice int, chunk bigint, top int, audit string, {_COUNTS}"


def _link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks in order to the edits of each chunk, and a last row with the counts of the conversation."""
    columns = [c.split()[0] for c in _LINKED.split(", ")]
    key, link, last = None, Linker(), (0, 0)

    def settled() -> list[tuple]:
        rows = [(key, *(chunk or (last[0], last[1] + 1)), top, audit, *[None] * 6) for chunk, top, audit in link.settled]
        link.settled = []
        return rows

    def ended() -> list[tuple]:
        cost, _ = link.end()
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
        return [*settled(), (key, last[0], last[1] + 2, None, "", gaps, *sums, cost)]

    turns, sums, before = None, [0, 0, 0, 0], ""
    for batch in batches:
        out = []
        for x in batch.itertuples(index=False):
            if x.key != key:
                if key is not None:
                    out += ended()
                key, link, turns, sums, before = x.key, Linker(), None, [0, 0, 0, 0], None
            own = [int(t) for t in x.turns]
            if own and turns:
                turns = (turns[0], own[-1], turns[2] + len(own) - (own[0] == turns[1]))
            elif own:
                turns = (own[0], own[-1], len(own))
            joint = before is not None and before + x.first not in LEGAL
            sums = [a + int(b) for a, b in zip(sums, (x.blank, x.duplicate, x.truncated, x.illegal + joint), strict=True)]
            before, last = x.last, (int(x.slice), int(x.chunk))
            link.add(last, [(p["start"], p["end"], p["cost"], p["audit"]) for p in x.paths])
            out += settled()
        if out:
            yield pd.DataFrame(out, columns=columns)
    if key is not None:
        yield pd.DataFrame(ended(), columns=columns)


_PART = f"key string, slice int, chunk bigint, {_COUNTS}, audit string, repaired string"


def _part(rows: pd.DataFrame, edits: pd.DataFrame) -> pd.DataFrame:
    """The repaired turns of one chunk."""
    rows = rows.sort_values("place")
    x = edits.iloc[[0]].copy()
    top = x["top"].iloc[0]
    lines = repaired_lines(x["audit"].iloc[0], rows["role"].tolist(), rows["text"].tolist(), int(top)) if top == top else []
    x["repaired"] = "\n".join(lines)
    return x[[c.split()[0] for c in _PART.split(", ")]]


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Parts in order to one row a conversation."""
    names = ["key", *[c.split()[0] for c in _COUNTS.split(", ")], "audit", "repaired_sha256"]
    key, audit, digest, empty = None, [], hashlib.sha256(), True
    for batch in batches:
        out = []
        for x in batch.itertuples(index=False):
            if x.key != key:
                key, audit, digest, empty = x.key, [], hashlib.sha256(), True
            audit.append(x.audit)
            if x.repaired:
                digest.update((x.repaired if empty else "\n" + x.repaired).encode("utf-8", "surrogatepass"))
                empty = False
            if x.cost == x.cost and x.cost is not None:
                counts = [int(getattr(x, n)) for n in names[1:7]]
                out.append((key, *counts, "".join(audit), digest.hexdigest()))
        if out:
            yield pd.DataFrame(out, columns=names)


def repaired_parts(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Every conversation's repaired turns in one part or more, ordered by ``slice`` (-1 if there is but one) and ``chunk``.

    ``repaired`` has the part's turns as lines of ``role:text``, ``audit`` its edits. The counts are in the last part of
    a conversation. ``key`` is ``=`` and the id, empty for a null id.
    """
    ship(turns.sparkSession)
    role, text = F.coalesce(role_col, F.lit(" ")), F.coalesce(text_col, F.lit(" "))
    bare = F.btrim(text, F.lit(WORD_SPACE))
    rows = turns.select(
        F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("")).alias("key"),
        F.col(turn_col).alias("order"),
        F.col(turn_col).cast("string").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        (bare == "").alias("blank"),
        F.right(bare, F.lit(1)).isin(".", "!", "?").alias("whole"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("mark"),
        F.monotonically_increasing_id().alias("given"),
    )
    order = ["key", F.asc_nulls_first("order"), "role", "mark", "given"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", *_ROW)
    sliced = written(ranged.mapInPandas(_slices, _SLICED), "turns")
    done = sliced.filter(F.col("slice").isNull())
    open_ = sliced.filter(F.col("slice").isNotNull()).withColumn("chunk", F.floor(F.col("place") / CHUNK))

    # Rows that stand in their range for the first time are duplicates if an earlier range has them.
    firsts = open_.filter(~F.col("seen")).select("key", "slice", "chunk", "place", "mark")
    least = firsts.groupBy("key", "mark").agg(F.min("slice").alias("least"))
    later = firsts.join(least, ["key", "mark"]).filter(F.col("slice") > F.col("least"))
    by = ["key", "slice", "chunk"]
    later = later.select(*[F.col(c).alias(c) for c in (*by, "place")])
    chunks = open_.groupBy(*by).cogroup(later.groupBy(*by)).applyInPandas(_chunk, _CHUNK)
    linked = chunks.repartition("key").sortWithinPartitions(*by).mapInPandas(_link, _LINKED)
    linked = written(linked, "edits")
    parts = open_.groupBy(*by).cogroup(linked.groupBy(*by)).applyInPandas(_part, _PART)
    whole = done.select("key", F.lit(-1).alias("slice"), F.col("place").alias("chunk"), *parts.columns[3:])
    return whole.unionByName(parts)


def repair(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row a conversation: counts of faults, the edits that repair it and the digest of the repaired turns."""
    parts = repaired_parts(turns, conv_col, turn_col, role_col, text_col)
    schema = f"key string, {_COUNTS}, audit string, repaired_sha256 string"
    several = parts.filter(F.col("slice") >= 0).repartition("key").sortWithinPartitions("key", "slice", "chunk")
    joined = several.mapInPandas(_joined, schema)
    single = parts.filter(F.col("slice") < 0).withColumn("repaired_sha256", F.sha2("repaired", 256))
    joined = joined.unionByName(single.select(*joined.columns))
    back = F.when(F.col("key") != "", F.substr("key", F.lit(2))).cast(turns.schema[conv_col].dataType)
    return joined.select(back.alias(conv_col), *joined.columns[1:])


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` with faults by the CRC of ``conv_id:turn``: dropped, emptied, cut off, repeated or misnamed turns."""
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(cell("conv_id"), F.lit(":"), cell("turn"))), F.lit(20))
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(cell("text"), "[.!?]", "")).otherwise(cell("text"))
    role = F.when(fault == 4, F.lit("user")).otherwise(cell("role"))
    copies = F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    kept = turns.filter(fault != 0)
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def with_every_id(repaired: DataFrame, turns: DataFrame) -> DataFrame:
    """The repaired conversations and, with zeros, those of which no turn was left."""
    ids = turns.select(F.col("conv_id").alias("all_id")).distinct()
    met = ids.join(repaired, F.col("all_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    counts: list[Column] = [zero(c.split()[0]) for c in _COUNTS.split(", ")]
    return met.select(
        F.col("all_id").alias("conv_id"), *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
