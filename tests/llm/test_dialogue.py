"""Repair of conversations against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from loadlens.llm import dialogue, queries

TURNS = "conv_id long, turn long, role string, text string"
COST = {"K": 0, "R": 1, "D": 2, "I": 5}


def repair_by_force(kinds):
    """Every string of edits with up to two insertions in a gap, tried in turn."""
    best = None
    for edits in itertools.product("KRD", repeat=len(kinds)):
        if any(k == "d" and e != "D" for k, e in zip(kinds, edits, strict=True)):
            continue
        for gaps in itertools.product(range(3), repeat=len(kinds) + 1):
            audit = "".join("I" * g + e for g, e in zip(gaps, (*edits, ""), strict=True))
            out = []
            for g, e, k in zip(gaps, (*edits, ""), (*kinds, ""), strict=True):
                out += ["ua"] * g + ([k.lower()] if e == "K" else ["ua"] if e == "R" else [])
            if not any(re.fullmatch("(s?(ua)+)?", "".join(o)) for o in itertools.product(*out)):
                continue
            cost = sum(COST[e] for e in audit) + sum(5 for k, e in zip(kinds, edits, strict=True) if k.isupper() and e != "D")
            best = min(best or (cost, audit), (cost, audit))
    return best


def test_parses_are_those_of_brute_force():
    r = random.Random(3)
    for n in range(5):
        cases = list(itertools.product("dsuaxSUA", repeat=n))
        for kinds in r.sample(cases, min(len(cases), [1, 8, 64, 60, 6][n])):
            assert dialogue.cheapest("".join(kinds)) == repair_by_force("".join(kinds)), kinds


def test_chunks_put_together_are_the_whole():
    r = random.Random(2)
    for _ in range(60):
        kinds = "".join(r.choice("dssuuaaxSUAX"[: r.randint(2, 12)]) for _ in range(r.randint(0, 60)))
        link = dialogue.Linker()
        for k in range(0, len(kinds), 7):
            link.add(k, dialogue.paths(kinds[k : k + 7]))
        cost, _ = link.end()
        assert (cost, "".join(a for _, _, a in link.settled)) == dialogue.cheapest(kinds)


def contract(rows):
    """The contract, with conversations parsed by ``cheapest``."""
    ids, convs = {r[0] for r in rows}, {}
    for conv, turn, role, text in rows:
        cell = lambda x: " " if x is None else str(x)
        role, text = cell(role), cell(text)
        h = zlib.crc32(f"{cell(conv)}:{cell(turn)}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        convs.setdefault(conv, []).extend([(turn, role, text)] * (2 if h == 3 else 1))
    mark = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
    for conv in ids:
        own = sorted(convs.get(conv, []), key=lambda t: (t[0] is not None, t[0] or 0, t[1], mark(t[1], t[2])))
        counts, kinds, seen = {"b": 0, "d": 0, "t": 0}, "", set()
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            kinds += "d" if fault in ("b", "d") and fault else initial.upper() if fault else initial
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit = dialogue.cheapest(kinds)
        out, k = [], 0
        for e in audit:
            made = "user" if len([x for x in out if not x.startswith("s")]) % 2 == 0 else "assistant"
            if e != "D":
                out.append(f"{made}:" if e == "I" else f"{own[k][1] if e == 'K' else made}:{own[k][2]}")
            k += e != "I"
        sha = hashlib.sha256("\n".join(out).encode()).hexdigest()
        yield (conv, gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit, sha)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("parts", ["3", "40"])
def test_query_is_the_contract_s(spark, tmp_path, parts, monkeypatch):
    """Small ranges and chunks, so that conversations cross both."""
    monkeypatch.setattr(dialogue, "CHUNK", 5)
    r = random.Random(9)
    texts = ["Hello there.", "Yes!", "No?", "cut off", "", None, " \n", "Ünïcode \n line.", "w " * 3000 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    rows = []
    for conv in [None, *range(120)]:
        start = r.randint(-3, 3)
        for k in range(r.randint(1, 9)):
            text = r.choice(texts) if r.random() < 0.4 else f"Turn {r.random()}."
            rows.append((conv, r.choice([start + k] * 6 + [None, start + 20, start]), r.choice(roles), text))
    rows += [(500, k, ["user", "assistant"][k % 2], f"Answer {k % 90}.") for k in range(400)]
    rows += [(501, 7, "user", "The same.")] * 150
    path = str(tmp_path / f"t{parts}")
    df = spark.createDataFrame(rows, TURNS).withColumns({n: F.lit("x") for n in ("key", "slice", "mark", "copy")})
    df.repartition(3).write.parquet(f"{path}/conversations.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [tuple(x) for x in queries.QUERIES["op13_conversation_repair"](spark, path).select(*COLUMNS).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(map(str, got)) == sorted(map(str, contract(rows)))


def test_empty_table(spark):
    assert dialogue.repair(spark.createDataFrame([], TURNS)).count() == 0
