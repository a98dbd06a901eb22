"""Benchmark decontamination by template windows with consistent slots.

Numbers, names and units become typed placeholders and the rest is folded to
lower-case letters and digits, word by word. Windows of the canonical words of
an item are looked up in the documents by hash; equal windows must also be
equal word by word. Matches on one diagonal (document place minus item place)
form an alignment, and its slots must map every value of the item to one value
of the document: then a question with other numbers or names is still found,
and text that merely has numbers at the same places is not.

Windows of plain folded words, without placeholders, are looked up as well and
taken together with them: they find exact copies whose names are written in
another case or after other white space, and those of items made of slots.

All of it is built from SQL functions. Both kinds of words are made in one pass
over a text, and the hashes of its windows meet those of the benchmark in a
broadcast join inside the task that reads the text, so only matches are ever
shuffled. The broadcast side holds at most ``BLOCK`` hashes; a larger benchmark
takes one pass over the documents for each block of its windows.

Null and blank texts match nothing. A text of any length is cut in one row of
one task, in time in proportion to its length. Extra columns are ignored, whatever their names. An item of fewer words than its window is
one window of its own length; an item without words cannot be found. Repeated
documents give repeated evidence under their id and one row; items with null
ids are left out, as a row could not name them. Names are words
with one leading capital that follow a letter, comma or semicolon and one
blank; elsewhere a name is a plain word and matches by itself only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import words_of, written

WINDOW = 8
MIN_COVER = 0.5
# Items of fewer words than three windows have narrow ones. So many equal words in a row are always reported.
NARROW = 4
LONG_RUN = 25
SALTS = 16
# Distinct hashes of windows broadcast at once, eight bytes each and about 32 in the hash table made of them.
BLOCK = 1 << 20

# Unit words that may follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml l s ms min h hr hrs hour hours minute minutes second seconds day "
    "days week weeks month months year years meter meters metre metres kilometer kilometers kilometre kilometres "
    "gram grams kilogram kilograms liter liters litre litres mile miles foot feet inch inches pound pounds dollar "
    "dollars euro euros cent cents percent degree degrees"
).split()
# In ASCII, so that texts in ASCII stay so and are folded fast; a word of a text that has one of them counts as a slot.
NAME, NUMBER, UNIT = "\x01", "\x02", "\x03"


def _canonical_text(text: Column) -> Column:
    """The text with placeholders and without punctuation.

    Patterns begin with the character they look for and look back from there,
    so most places of a text cost one comparison.
    """
    t = F.regexp_replace(text, r"\p{Lu}(?<=[\p{L},;] \p{Lu})\p{Ll}+(?!\p{L})", NAME)
    t = F.regexp_replace(t, r"\p{N}(?<![\p{L}\p{N}]\p{N})(?:[.,:/]?\p{N})*+(?!\p{L})", NUMBER)
    t = F.regexp_replace(t, rf"{NUMBER} (?:{'|'.join(UNITS)})(?!\p{{L}})", f"{NUMBER} {UNIT}")
    return F.lower(F.regexp_replace(t, rf"[^\p{{L}}\p{{N}}{NAME}{NUMBER}{UNIT}\x20\x09-\x0D]+", ""))


def canonical_words(text: Column) -> Column:
    """The canonical words: one for every word of the text with a letter or a digit."""
    return words_of(_canonical_text(text))


def _is_slot(word: Column) -> Column:
    return word.rlike(f"[{NAME}{NUMBER}{UNIT}]")


def plain_words(text: Column) -> Column:
    """The words in lower case without the punctuation around them, place by place with ``canonical_words``."""
    kept = rf"\p{{L}}\p{{N}}{NAME}{NUMBER}{UNIT}"
    odd = rf"[^{kept}\x20\x09-\x0D]"
    # Begins with the odd character, so that other places cost one comparison: odd runs at a word's start, then at its end.
    return words_of(F.lower(F.regexp_replace(text, rf"{odd}(?:(?<![{kept}]{odd}){odd}*+|{odd}*+(?![{kept}]))", "")))


def _around(words: Column, at: Column, wide: Column, reach: int, before: str, after: str) -> tuple[Column, Column]:
    """The words before a window, the nearest first, and those after it."""
    lo = F.greatest(at - reach, F.lit(0))
    return F.reverse(F.slice(words, lo + 1, at - lo)).alias(before), F.slice(words, at + wide + 1, reach).alias(after)


def template_windows(items: DataFrame, id_col: str, text_col: str, window: int, plain: bool = False) -> DataFrame:
    """Every window of every item: hash, place, words compared, the same places' plain words, and the words around.

    Template windows of which over half the words are slots say nothing and are
    left out; plain windows are all kept.
    """
    words = plain_words if plain else canonical_words
    both = items.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("c"), plain_words(F.col(text_col)).alias("r")
    )
    n = F.size("c")
    wide = F.least(n, F.when(n < 3 * window, F.lit(min(NARROW, window))).otherwise(F.lit(window)))
    placed = both.filter(n > 0).withColumn("wide", wide).withColumn("ipos", F.explode(F.sequence(F.lit(0), n - wide)))
    cut = placed.select(
        "item_id", "ipos", "wide",
        F.slice("c", F.col("ipos") + 1, F.col("wide")).alias("icanon"), F.slice("r", F.col("ipos") + 1, F.col("wide")).alias("iraw"),
        *_around(F.col("c"), F.col("ipos"), F.col("wide"), window, "ibefore", "iafter"),
    )
    told = F.lit(plain) | (F.size(F.filter("icanon", lambda w: ~_is_slot(w))) * 2 >= F.col("wide"))
    return cut.filter(told).select("*", F.lit(plain).alias("plain"), F.xxhash64("icanon").alias("h"))


def _met(docs: DataFrame, id_col: str, text_col: str, hashes: DataFrame, kinds: list[tuple[bool, int]], window: int) -> DataFrame:
    """The documents' windows, of the kinds (plain, width) given, whose hash is among the few ``hashes``.

    The generators are outer ones: for others Spark adds filters on the size of
    the array, which would make the words a second time.
    """
    text = F.col(text_col)
    made = docs.select(F.col(id_col).alias("_id"), canonical_words(text).alias("c"), plain_words(text).alias("r"))
    spots = made.select("_id", "c", "r", F.posexplode_outer("r").alias("pos", "_word"))

    def keyed(plain: bool, wide: int) -> Column:
        words = F.col("r" if plain else "c")
        return F.when(F.col("pos") + wide <= F.size("r"), F.xxhash64(F.slice(words, F.col("pos") + 1, wide)))

    keys = F.array(*[keyed(plain, wide) for plain, wide in kinds])
    each = spots.select("_id", "c", "r", "pos", F.posexplode_outer(keys).alias("kind", "h"))
    known = each.join(F.broadcast(hashes), "h")
    wide = F.array(*[F.lit(w) for _, w in kinds])[F.col("kind")]
    plain = F.array(*[F.lit(p) for p, _ in kinds])[F.col("kind")]
    known = known.withColumn("wide", wide).withColumn("plain", plain).withColumn("w", F.when(F.col("plain"), F.col("r")).otherwise(F.col("c")))
    return known.select(
        "_id", "h", "pos", "wide", "plain",
        F.slice("w", F.col("pos") + 1, F.col("wide")).alias("canon"), F.slice("r", F.col("pos") + 1, F.col("wide")).alias("raw"),
        *_around(F.col("w"), F.col("pos"), F.col("wide"), window, "before", "after"),
    )


def matches(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, block: int = BLOCK,
) -> DataFrame:
    """Equal windows, of template words with the values of their slots and of plain words.

    Columns: the id, ``item_id``, ``pos``, ``ipos``, ``wide`` and ``slots``, an array of (kind, item value, document value);
    ``covered``, the item's places in the window and equal ones beside it.
    """
    both = [template_windows(items, item_col, item_text, window, plain) for plain in (False, True)]
    own = written(both[0].unionByName(both[1]), "items")
    kinds = sorted((r["plain"], r["wide"]) for r in own.select("plain", "wide").distinct().collect())
    if not kinds:
        types = [("item_id", dict(items.dtypes)[item_col]), ("pos", "int"), ("ipos", "int"), ("wide", "int"), ("plain", "boolean")]
        types += [("covered", "array<int>"), ("slots", "array<struct<kind:string,item:string,doc:string>>")]
        return docs.limit(0).select(F.col(id_col), *[F.lit(None).cast(t).alias(n) for n, t in types])
    hashes = own.select("h").distinct()
    blocks = -(-hashes.count() // block)
    salted = own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = None
    for number in range(blocks):
        some = hashes.filter(F.pmod(F.xxhash64("h"), F.lit(blocks)) == number)
        each = _met(docs, id_col, text_col, some, kinds, window)
        each = each.withColumn("salt", F.pmod(F.xxhash64("_id", "pos"), F.lit(SALTS)).cast("int"))
        joined = each.join(salted, ["h", "plain", "wide", "salt"]).filter(F.col("canon") == F.col("icanon"))
        joined = written(joined, "windows")
        found = joined if found is None else found.unionByName(joined)
    zipped = F.transform(
        F.filter(F.arrays_zip("canon", "iraw", "raw"), lambda x: _is_slot(x["canon"])),
        lambda x: F.struct(x["canon"].alias("kind"), _value(x["iraw"]).alias("item"), _value(x["raw"]).alias("doc")),
    )
    end = F.col("ipos") + F.col("wide")
    covered = F.concat(
        F.sequence(F.col("ipos"), end - 1),
        _alike("ibefore", "before", lambda t: F.col("ipos") - 1 - t), _alike("iafter", "after", lambda t: end + t),
    )
    return found.select(
        F.col("_id").alias(id_col), "item_id", "pos", "ipos", "wide", "plain", covered.alias("covered"), zipped.alias("slots")
    )


def _alike(item: str, doc: str, place) -> Column:
    """Places of the item's words beside a window that the document has at the same distance; slots are not judged there."""
    same = lambda x: (x[item] == x[doc]) & ~_is_slot(x[item])
    found = F.transform(F.arrays_zip(item, doc), lambda x, t: F.when(same(x), place(t)))
    return F.filter(found, lambda p: p.isNotNull())


def _value(word: Column) -> Column:
    """A slot's value: the lower-case word without what else stands around it."""
    return F.regexp_replace(word, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, min_cover: float = MIN_COVER,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document and item found in it.

    Columns: the id, ``item_id``, ``n_windows`` of the item matched on
    consistent diagonals, ``item_windows``, ``cover`` by words, ``n_slots`` of distinct
    values, ``kind`` (``verbatim`` or ``reparameterised``). A run of
    ``LONG_RUN`` equal words is reported whatever it covers.
    """
    found = matches(docs, items, id_col, text_col, item_col, item_text, window, block)
    ids = F.col(id_col)
    aligned = (
        found.withColumn("diagonal", F.col("pos") - F.col("ipos"))
        .groupBy(ids.alias("_id"), "item_id", "diagonal")
        .agg(
            F.collect_set("ipos").alias("places"), F.collect_set(F.when(~F.col("plain"), F.col("ipos"))).alias("told_places"),
            F.collect_set(F.when(F.col("plain"), F.col("ipos"))).alias("plain_places"), F.max("wide").alias("wide"),
            F.array_distinct(F.flatten(F.collect_set("covered"))).alias("covered"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("pairs"),
        )
    )
    consistent = F.size("pairs") == F.size(
        F.array_distinct(F.transform("pairs", lambda x: F.struct(x["kind"], x["item"])))
    )
    more = F.lit(LONG_RUN) - F.col("wide")
    # Where slots contradict one another, only a long run of equal words counts.
    long = F.exists("plain_places", lambda p: F.size(F.filter("plain_places", lambda q: (q >= p) & (q <= p + more))) > more)
    both = [template_windows(items, item_col, item_text, window, plain).select("item_id", "ipos", "wide") for plain in (False, True)]
    per_item = both[0].withColumn("told", F.lit(1)).unionByName(both[1].withColumn("told", F.lit(0))).groupBy("item_id").agg(
        F.countDistinct(F.when(F.col("told") == 1, F.col("ipos"))).alias("told"), F.countDistinct("ipos").alias("item_windows"),
        F.max(F.col("ipos") + F.col("wide")).alias("item_words"),
    )
    whole = (
        aligned.filter(consistent | long)
        .groupBy("_id", "item_id")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("bigint").alias("n_windows"),
            F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("n_covered"), F.max(long).alias("long"),
            F.size(F.array_distinct(F.flatten(F.collect_list("told_places")))).alias("n_told"),
            F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"),
        )
        .join(per_item, "item_id")
        .withColumn("cover", F.col("n_covered") / F.col("item_words"))
        .withColumn("by_told", F.coalesce(F.try_divide("n_told", "told"), F.lit(0.0)))
        .withColumn("cover", F.greatest("cover", "by_told"))
        .filter((F.col("cover") >= min_cover) | F.col("long"))
    )
    changed = F.exists("pairs", lambda x: F.lower(x["item"]) != F.lower(x["doc"]))
    return whole.select(
        F.col("_id").alias(id_col), "item_id", "n_windows", "item_windows", "cover",
        F.size("pairs").cast("bigint").alias("n_slots"),
        F.when(changed, "reparameterised").otherwise("verbatim").alias("kind"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents in which no item was found, with all their columns.

    The found ids are written first: Spark then knows their size before it plans the join, and sends them to the
    documents if they are few instead of shuffling the texts.
    """
    dirty = written(contaminated(docs, items, **options).select(F.col("doc_id").alias("_dirty")).distinct(), "dirty")
    return docs.join(dirty, docs["doc_id"] == dirty["_dirty"], "left_anti")
