"""Quality rules as a ledger of failure bits and measurements; policies and ablations read the ledger only.

Every rule runs once per document. Its outcome is one bit of ``failed`` and
its measurements stay in columns, so a policy, a new threshold version or an
ablation is bit arithmetic over the ledger and never reads a text again.

Null and blank texts have no words, measure zero everywhere and fail the base
rule on words. Repeated rows give repeated ledger rows. Extra columns are
ignored; the ledger carries the id only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import WORD_SPACE, let, words_of

# The characters counted as symbols.
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A named test over measurements; ``fails`` is SQL over the measured columns."""

    name: str
    fails: str


# The bit of a rule is its place in this tuple; new rules are added at the end.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("shouting", "100 * n_upper > 40 * n_letters"),
    Rule("exclamations", "100 * n_exclaims > 30 * n_words"),
    Rule("short_words", "100 * word_chars < 250 * n_words"),
    Rule("long_words", "100 * word_chars > 1200 * n_words"),
    Rule("few_letters", "100 * n_letters < 50 * word_chars"),
)


def bits_of(*names: str) -> int:
    places = {r.name: k for k, r in enumerate(RULES)}
    return sum(1 << places[n] for n in names)


@dataclass(frozen=True)
class Policy:
    """A document passes if no ``required`` bit failed, and at most ``allowed`` of the ``counted`` ones."""

    name: str
    version: int
    required: int
    counted: int = 0
    allowed: int = 0


BASE = Policy("base", 1, bits_of("few_words", "repeated_words"))
STRICT = Policy("strict", 1, (1 << len(RULES)) - 1)
LENIENT = Policy("lenient", 1, BASE.required, STRICT.required & ~BASE.required, 1)
POLICIES = (BASE, LENIENT, STRICT)


# Up to so many repeated hashes, a document's windows are compared with each of them; beyond, windows are sorted with places.
FEW_REPEATS = 16


def _covered(places: Column) -> Column:
    """Words that windows at the sorted places cover: up to three each, without those that the next one covers."""
    steps = lambda p: F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1), x + 3) - x))
    return let(places, lambda p: F.aggregate(steps(p), F.lit(0), lambda a, b: a + b))


def _places_by_sort(h: Column) -> Column:
    """Places of hashes that occur twice or more: equal neighbours after a sort of (hash, place)."""
    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    same = lambda s, x, j: F.get(s, j)["h"] == x["h"]
    twice = lambda s: F.filter(
        s, lambda x, i: same(s, x, i + 1) | F.coalesce((i > 0) & same(s, x, F.greatest(i - 1, F.lit(0))), F.lit(False))
    )
    return F.sort_array(F.transform(let(pairs, twice), lambda x: x["p"]))


def _repeat_words(words: Column) -> Column:
    """How many words stand in a 3-word window that the text has twice or more.

    Windows are compared by 64-bit hash. A sort of the hashes alone tells
    which occur again; few texts have any, and fewer have many.
    """
    hashes = lambda w: F.when(
        F.size(w) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
    )
    again = lambda h: let(
        F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i + 1)))
    )
    few = lambda h, d: F.filter(
        F.transform(h, lambda x, i: F.when(F.array_contains(d, x), i)), lambda i: i.isNotNull()
    )
    count = lambda h, d: F.when(F.size(d) == 0, F.lit(0)).when(
        F.size(d) <= FEW_REPEATS, _covered(few(h, d))
    ).otherwise(_covered(_places_by_sort(h)))
    return F.coalesce(let(let(words, hashes), lambda h: let(again(h), lambda d: count(h, d))), F.lit(0))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with everything the rules need."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col), text.alias("_t"), words_of(F.col(text_col)).alias("_w"))
    t, w = F.col("_t"), F.col("_w")
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(WORD_SPACE)) != "")
    counted = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")))
    count = lambda pattern: F.regexp_count(t, F.lit(pattern)).cast("bigint")
    return base.select(
        id_col,
        F.size(w).cast("bigint").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)).alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        counted.alias("_l"),
        _repeat_words(w).cast("bigint").alias("n_repeat_words"),
        F.length(F.regexp_replace(t, r"\P{L}+", "")).cast("bigint").alias("n_letters"),
        (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))).cast("bigint").alias("n_upper"),
        (F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))).cast("bigint").alias("n_exclaims"),
    ).select(
        id_col, "n_words", "word_chars", "n_symbols",
        F.col("_l")["d"].cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        F.col("_l")["n"].cast("bigint").alias("n_lines"),
        "n_letters", "n_upper", "n_exclaims",
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements and ``failed``, a long with bit k set if rule k fails."""
    bits = F.lit(0).cast("bigint")
    for k, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint"))
    return measures(docs, id_col, text_col).withColumn("failed", bits)


def passes(policy: Policy, failed: str | Column = "failed") -> Column:
    """Whether a ledger row passes a policy."""
    bits = F.col(failed) if isinstance(failed, str) else failed
    counted = F.bit_count(bits.bitwiseAND(F.lit(policy.counted).cast("bigint")))
    return (bits.bitwiseAND(F.lit(policy.required).cast("bigint")) == 0) & (counted <= policy.allowed)


def ablations(book: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """For every policy and rule: documents that fail the rule, and documents kept if the rule alone were dropped.

    One aggregation over the ledger; an empty ledger gives zero counts.
    """
    parts, cells = [], []
    for p in policies:
        kept = f"kept_{p.name}"
        parts.append(F.count(F.when(passes(p), 1)).alias(kept))
        for k, rule in enumerate(RULES):
            bit = 1 << k
            without = Policy(p.name, p.version, p.required & ~bit, p.counted & ~bit, p.allowed)
            fails, more = f"fails_{p.name}_{k}", f"without_{p.name}_{k}"
            parts.append(F.count(F.when(F.col("failed").bitwiseAND(F.lit(bit).cast("bigint")) != 0, 1)).alias(fails))
            parts.append(F.count(F.when(passes(without), 1)).alias(more))
            cells.append(
                F.struct(
                    F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(rule.name).alias("rule"),
                    F.col(fails).alias("n_failing"), F.col(kept).alias("n_kept"),
                    (F.col(more) - F.col(kept)).alias("n_gained"),
                )
            )
    return book.agg(*parts).select(F.inline(F.array(*cells)))


def kept_documents(docs: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The documents that pass, with all their columns; measured in place, so no join and no shuffle."""
    numbered = F.struct(*[F.col(c) for c in docs.columns])
    book = ledger(docs.select(numbered.alias("_row"), F.col("text")), "_row", "text")
    return book.filter(passes(policy)).select("_row.*")
