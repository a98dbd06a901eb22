"""URL filters whose list entries have dates: every capture meets the entries in force when it was fetched.

A list is a log of dated decisions, ``(kind, key, action, listed_at)``. The
next decision on the same key ends the one before, so each becomes an interval
``[valid_from, valid_to)``. A capture is asked under its host, the host's
parent domains and its path heads; the as-of join takes the entries in force
at its fetch time, and the most telling one decides.

The join is an equality on kind, key, month and salt. Intervals are cut into
the months between the first and the last capture, so a key's long history and
a host with a third of all captures are both spread over many tasks.

Null or unreadable URLs, and captures without a time, meet no entry and are
allowed, with null host and match. Entries without kind, key, action or date
are ignored; of entries on one key at one time, block wins. Repeated captures
give repeated rows. Extra columns are ignored. Empty lists allow everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 8
# How telling a kind of entry is.
RANKS = {"path": 3, "host": 2, "domain": 1}


def host_of(url: Column) -> Column:
    """The lower-case host without user, port and final dot; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.regexp_replace(host, r"\.$", ""), F.lit(""))


def path_head(url: Column) -> Column:
    """Host and first path segment, as ``host/segment``; null without a segment."""
    head = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)", 1)
    return F.when(head != "", F.concat(host_of(url), F.lit("/"), head))


def domains_of(host: Column) -> Column:
    """The host's parent domains of two labels or more, the host itself among them."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.when(
        n >= 2, F.transform(F.sequence(F.lit(2), n), lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))
    ).otherwise(F.array().cast("array<string>"))


def validity(entries: DataFrame) -> DataFrame:
    """The dated decisions as intervals; ``valid_to`` is null for the last one of a key."""
    # A path keeps its case behind the host, as in path_head.
    host, rest = (F.regexp_extract("key", r"(?s)^([^/]*)(.*)$", k) for k in (1, 2))
    key = F.when(F.col("kind") == "path", F.concat(F.lower(host), rest)).otherwise(F.lower("key"))
    told = entries.select("kind", key.alias("key"), "action", F.col("listed_at").cast("timestamp").alias("valid_from"))
    one = told.dropna().groupBy("kind", "key", "valid_from").agg(F.max("action").alias("action"))  # block > allow
    steps = one.groupBy("kind", "key").agg(F.sort_array(F.collect_list(F.struct("valid_from", "action"))).alias("s"))
    return steps.select(
        "kind", "key",
        F.inline(
            F.transform(
                "s",
                lambda x, i: F.struct(
                    x["valid_from"].alias("valid_from"), F.get(F.col("s"), i + 1)["valid_from"].alias("valid_to"),
                    x["action"].alias("action"),
                ),
            )
        ),
    )


def filter_captures(
    captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at"
) -> DataFrame:
    """Per capture: id, url, host, fetched_at, action (allow or block), matched_kind, matched_key, listed_at."""
    month = lambda c: (F.year(c) * 12 + F.month(c)).cast("int")
    rows = captures.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"),
        F.col(time_col).cast("timestamp").alias("fetched_at"),
    )
    # A capture's rows meet again by its own values, so the row number of a repeated capture is not needed.
    one = rows.groupBy("id", "url", "host", "fetched_at").agg(F.count("*").alias("copies"))
    none = F.array().cast("array<struct<kind:string,key:string>>")
    pair = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.alias("key"))
    keys = F.concat(
        F.coalesce(F.transform(domains_of(F.col("host")), lambda d: pair("domain", d)), none),
        F.array(pair("host", F.col("host")), pair("path", path_head(F.col("url")))),
    )
    asked = (
        one.withColumn("k", F.explode(F.filter(keys, lambda x: x["key"].isNotNull())))
        .filter(F.col("fetched_at").isNotNull())
        .select(
            "id", "url", "fetched_at", "k.kind", "k.key", month(F.col("fetched_at")).alias("month"),
            F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int").alias("salt"),
        )
    )
    span = rows.agg(F.min(month(F.col("fetched_at"))).alias("lo"), F.max(month(F.col("fetched_at"))).alias("hi")).first()
    lo, hi = (span["lo"], span["hi"]) if span["lo"] is not None else (0, 0)
    first = F.greatest(month(F.col("valid_from")), F.lit(lo))
    last = F.least(F.coalesce(month(F.col("valid_to")), F.lit(hi)), F.lit(hi))
    listed = (
        validity(entries)
        .filter(first <= last)
        .withColumn("month", F.explode(F.sequence(first, last)))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in RANKS.items()], F.lit(0))
    said = (
        asked.join(listed, ["kind", "key", "month", "salt"])
        .filter((F.col("valid_from") <= F.col("fetched_at")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to"))))
        .groupBy("id", "url", "fetched_at")
        .agg(F.max(F.struct(rank.alias("rank"), F.length("key").alias("n"), "valid_from", "action", "kind", "key")).alias("m"))
    )
    same = one.alias("a").join(
        said.alias("b"),
        F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.url") == F.col("b.url")) & (F.col("a.fetched_at") == F.col("b.fetched_at")),
        "left",
    )
    return same.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        F.col("a.id").alias(id_col), F.col("a.url").alias("url"), "host", F.col("a.fetched_at").alias("fetched_at"),
        F.coalesce(F.col("m.action"), F.lit("allow")).alias("action"), F.col("m.kind").alias("matched_kind"),
        F.col("m.key").alias("matched_key"), F.col("m.valid_from").alias("listed_at"),
    )
