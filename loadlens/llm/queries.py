"""The registered queries of this subpackage, each next to its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm import decontaminate, dialogue, extract, jaccard, langid, passages, periodic, pieces, quality, repeats, tokencount, urlfilter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 1024


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_sentencepiece")
def op1(spark, folder):
    return pieces.round_trip(table(spark, folder, "documents"), PIECE_MODEL)


@query("op2_html_extract")
def op2(spark, folder):
    return extract.extract(table(spark, folder, "pages"))


@query("op3_token_counts")
def op3(spark, folder):
    counted = tokencount.count_prefixes(table(spark, folder, "documents"), BYTE_MODEL, (TOKEN_LIMIT,))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


# The dated list of the URL query comes from the hosts seen: by digits of the host's MD5, a host or its parent domain is
# blocked on a day of January, allowed on a day of May and blocked again on a day of October.
_DAY = lambda k: f"(instr('0123456789abcdef', substr(md5(host), {k}, 1)) + 5)"
_HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]+)', 1))"


def listed_entries(pages: DataFrame) -> DataFrame:
    hosts = pages.select(urlfilter.host_of(F.col("url")).alias("host")).dropna().distinct()
    hosts = hosts.withColumn("m", F.md5("host"))
    digit = lambda k: F.instr(F.lit("0123456789abcdef"), "x") if k is None else F.expr(
        f"instr('0123456789abcdef', substr(m, {k}, 1)) - 1"
    )
    day = lambda month, k: F.make_date(F.lit(2024), F.lit(month), digit(k) + 6).cast("timestamp")
    parent = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    entry = lambda kind, key, action, at: F.struct(
        F.lit(kind).alias("kind"), key.alias("key"), F.lit(action).alias("action"), at.alias("listed_at")
    )
    host, wide = digit(1) < 6, digit(2) < 2
    none = F.lit(None)
    events = F.array(
        F.when(host, entry("host", F.col("host"), "block", day(1, 3))).otherwise(none),
        F.when(host, entry("host", F.col("host"), "allow", day(5, 4))).otherwise(none),
        F.when(host, entry("host", F.col("host"), "block", day(10, 5))).otherwise(none),
        F.when(wide, entry("domain", parent, "block", day(3, 6))).otherwise(none),
    )
    return hosts.select(F.inline(F.filter(events, lambda x: x.isNotNull()))).filter(F.col("key") != "")


@query(
    "op4_url_filter",
    rf"""
WITH h AS (SELECT page_id, url, nullif({_HOST}, '') AS host,
             TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * CAST(page_id % 365 AS INTEGER) AS fetched_at FROM pages),
hosts AS (SELECT DISTINCT host, md5(host) AS m FROM h WHERE host IS NOT NULL),
d AS (SELECT host, regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS parent,
        instr('0123456789abcdef', substr(m, 1, 1)) - 1 AS d1, instr('0123456789abcdef', substr(m, 2, 1)) - 1 AS d2,
        instr('0123456789abcdef', substr(m, 3, 1)) + 5 AS d3, instr('0123456789abcdef', substr(m, 4, 1)) + 5 AS d4,
        instr('0123456789abcdef', substr(m, 5, 1)) + 5 AS d5, instr('0123456789abcdef', substr(m, 6, 1)) + 5 AS d6 FROM hosts),
entries AS (
  SELECT 'host' AS kind, host AS key, 'block' AS action, CAST(make_date(2024, 1, CAST(d3 AS BIGINT)) AS TIMESTAMP) AS listed_at FROM d WHERE d1 < 6
  UNION ALL SELECT 'host', host, 'allow', CAST(make_date(2024, 5, CAST(d4 AS BIGINT)) AS TIMESTAMP) FROM d WHERE d1 < 6
  UNION ALL SELECT 'host', host, 'block', CAST(make_date(2024, 10, CAST(d5 AS BIGINT)) AS TIMESTAMP) FROM d WHERE d1 < 6
  UNION ALL SELECT 'domain', parent, 'block', CAST(make_date(2024, 3, CAST(d6 AS BIGINT)) AS TIMESTAMP) FROM d WHERE d2 < 2 AND parent <> ''),
one AS (SELECT kind, key, listed_at, max(action) AS action FROM entries GROUP BY ALL),
spans AS (SELECT *, lead(listed_at) OVER (PARTITION BY kind, key ORDER BY listed_at) AS ended FROM one),
met AS (SELECT h.page_id, s.kind, s.key, s.action, s.listed_at,
          row_number() OVER (PARTITION BY h.page_id ORDER BY CASE s.kind WHEN 'host' THEN 2 ELSE 1 END DESC, length(s.key) DESC, s.listed_at DESC) AS r
        FROM h JOIN spans s ON ((s.kind = 'host' AND s.key = h.host) OR (s.kind = 'domain' AND (h.host = s.key OR ends_with(h.host, '.' || s.key))))
          AND s.listed_at <= h.fetched_at AND (s.ended IS NULL OR h.fetched_at < s.ended))
SELECT h.page_id, h.url, h.host, h.fetched_at, coalesce(m.action, 'allow') AS action, m.kind AS matched_kind, m.key AS matched_key,
       m.listed_at
FROM h LEFT JOIN (SELECT * FROM met WHERE r = 1) m USING (page_id)
""",
)
def op4(spark, folder):
    """Page n was fetched on day n modulo 365 of 2024."""
    pages = table(spark, folder, "pages")
    day = F.make_date(F.lit(2024), F.lit(1), F.lit(1)) + F.pmod("page_id", F.lit(365)).cast("int")
    return urlfilter.filter_captures(pages.withColumn("fetched_at", day.cast("timestamp")), listed_entries(pages))


_BASE32 = "list_aggregate(list_transform(range(1, 41, 5), lambda i: list_aggregate(list_transform([15, 10, 5, 0], lambda k: " \
    "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, i, 5) AS BIGINT) >> k) & 31 AS INTEGER) + 1, 1)" \
    "), 'string_agg', '')), 'string_agg', '')"  # fmt: skip


@query(
    "op5_warc",
    f"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS h, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
""",
)
def op5(spark, folder):
    _, back = warc.archive(table(spark, folder, "pages"))
    return back.drop("url", "payload")


@query("op6_decontaminate")
def op6(spark, folder):
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


MEASURES_SQL = r"""
base AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         coalesce(repeats.n, 0) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines,
         CAST(length(regexp_replace(t, '\P{L}', '', 'g')) AS BIGINT) AS n_letters,
         CAST(length(regexp_replace(t, '\P{Lu}', '', 'g')) AS BIGINT) AS n_upper,
         CAST(length(regexp_replace(t, '[^!]', '', 'g')) AS BIGINT) AS n_exclaims
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM base)
  LEFT JOIN repeats USING (doc_id)
),
book AS (SELECT *, CAST(""" + " + ".join(
    f"CASE WHEN {r.fails} THEN {1 << k} ELSE 0 END" for k, r in enumerate(quality.RULES)
) + " AS BIGINT) AS failed FROM measured)"


@query(
    "op7_quality_rules",
    f"WITH {MEASURES_SQL} SELECT *, failed & {quality.BASE.required} <> 0 AS base_failed, failed = 0 AS kept FROM book",
)
def op7(spark, folder):
    book = quality.ledger(table(spark, folder, "documents"))
    return book.select("*", (~quality.passes(quality.BASE)).alias("base_failed"), quality.passes(quality.STRICT).alias("kept"))


def _ablation_sql() -> str:
    passed = lambda p: (
        f"(failed & {p.required}) = 0 AND bit_count(failed & {p.counted}) <= {p.allowed}"
    )
    rows = []
    for p in quality.POLICIES:
        for k, r in enumerate(quality.RULES):
            bit = 1 << k
            without = quality.Policy(p.name, p.version, p.required & ~bit, p.counted & ~bit, p.allowed)
            rows.append(
                f"SELECT '{p.name}' AS policy, {p.version} AS version, '{r.name}' AS rule, "
                f"count(*) FILTER (WHERE failed & {bit} <> 0) AS n_failing, count(*) FILTER (WHERE {passed(p)}) AS n_kept, "
                f"count(*) FILTER (WHERE {passed(without)}) - count(*) FILTER (WHERE {passed(p)}) AS n_gained FROM book"
            )
    return f"WITH {MEASURES_SQL} " + " UNION ALL ".join(rows)


@query("quality_ablations", _ablation_sql())
def quality_ablations(spark, folder):
    return quality.ablations(quality.ledger(table(spark, folder, "documents")))


@query("op8_shared_passages")
def op8(spark, folder):
    return passages.shared_passages(table(spark, folder, "documents"))


@query(
    "op9_ngram_jaccard",
    r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1) + 1))) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT doc_id AS v, doc_id AS r FROM n UNION SELECT reach.v, edges.b FROM reach JOIN edges ON edges.a = reach.r)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.r, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT v, min(r) AS r FROM reach GROUP BY v) m ON m.v = w.doc_id
""",
)
def op9(spark, folder):
    return jaccard.linked(table(spark, folder, "documents"))


@query("op10_language")
def op10(spark, folder):
    docs = table(spark, folder, "documents").withColumn("held_out", langid.held_out(F.col("doc_id")))
    learned = langid.prototypes(docs.filter(~F.col("held_out")))
    told = langid.predict(docs, learned)
    return told.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op11_periodic_runs")
def op11(spark, folder):
    docs = periodic.with_planted_period(table(spark, folder, "documents"))
    return periodic.digests(periodic.periodic_runs(docs))


@query("op12_repeated_strings")
def op12(spark, folder):
    return repeats.without_repeats(table(spark, folder, "documents")).drop("kept")


@query("op13_conversation_repair")
def op13(spark, folder):
    turns = table(spark, folder, "conversations")
    return dialogue.with_every_id(dialogue.repair(dialogue.damaged(turns)), turns)
