"""The training-data operators against brute force, the tokenizer libraries and planted cases."""

import datetime
import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loadlens.llm import (
    common,
    components,
    decontaminate,
    dom,
    extract,
    jaccard,
    langid,
    passages,
    pieces,
    quality,
    queries,
    tokencount,
    urlfilter,
    warc,
)

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["", None, "  \n\t ", "a", "a", "x y z", "<|endoftext|> and <s>", "▁ ▁▁x", "é́日本😀 ½ Ⅷ", "a  b\n\n c\r\n"]


def words(n, seed, stock=None):
    r = random.Random(seed)
    stock = stock or [f"w{k}" for k in range(5000)]
    return [r.choice(stock) for _ in range(n)]


def docs_of(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df, *names):
    return df.withColumns({n: F.lit("other") for n in names})


# SentencePiece


def test_pieces_are_the_library_s(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    r = random.Random(3)
    alphabet = list("ab \n\t.é日😀▁  \x00") + ["<s>", " the", "##"]
    texts = ODD + ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(150)] + ["long " * 30_000]
    docs = clashing(docs_of(spark, texts), "n_tokens", "id", "ids")
    got = {x["doc_id"]: x for x in pieces.round_trip(docs, queries.PIECE_MODEL, limit=500).collect()}
    encoded = pieces.encode(docs, queries.PIECE_MODEL)
    ids = {x["doc_id"]: x["ids"] for x in pieces.with_ids(encoded).collect()}
    back = {x["doc_id"]: x["decoded"] for x in pieces.decode(encoded, queries.PIECE_MODEL).collect()}
    for i, t in enumerate(texts):
        want = model.encode(t or "")
        text = model.decode(want)
        assert ids[i] == want and back[i] == text
        assert got[i]["n_tokens"] == len(want)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


# Token counts


def test_counts_at_every_prefix_are_the_library_s(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.BYTE_MODEL)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    r = random.Random(4)
    alphabet = list("ab cT \n'.!é日½") + ["<|endoftext|>", "'re", "'ll", "  "]
    texts = ODD + ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(120)]
    docs = clashing(docs_of(spark, texts), "n_tokens", "id")
    got = {x["doc_id"]: x for x in tokencount.count_prefixes(docs, queries.BYTE_MODEL, (0, 5), limit=20).collect()}
    whole = {x["doc_id"]: x["prefix_counts"] for x in tokencount.prefix_counts(docs, queries.BYTE_MODEL).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        want = [count(t[:k]) for k in range(len(t) + 1)]
        assert whole[i] == want, t
        assert got[i]["n_tokens"] == want[-1] and got[i]["n_bytes"] == len(t.encode())
        for budget in (0, 5):
            fits = len(t) if want[-1] <= budget else max(k for k, n in enumerate(want) if n <= budget)
            assert got[i][f"fits_{budget}"] == fits, t


def test_pairs_of_tokens_stand_as_the_merges_leave_them():
    counter = tokencount.PrefixCounter(common.model_bytes(queries.BYTE_MODEL))
    tokens = sorted(counter.tokens)
    r = random.Random(1)
    for _ in range(4000):
        a, b = r.choice(tokens), r.choice(tokens)
        assert counter.stands(a, b) == (counter.merged(a + b) == [a, b])


# Pages


@pytest.fixture(scope="module")
def trees(spark):
    return extract.fit(spark, pages=200, trees=12)


def test_main_text(spark, trees):
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
        "<div class='ad'>Buy this now.</div><article><h1>A &amp; B</h1><p>First  text,\n with words enough to be told.<p><b>Second"
        " one<br>goes on, and ends here.</p></article><section class='comments'><p>I liked it, thanks.</p></section>"
        "<footer>&copy; x <a href='#'>legal</a></footer>"
    )
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (1, "u", page), (4, "u", "<nav><a href='/'>x</a></nav>"), (None, "u", page)]
    df = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"), "text", "id")
    got = extract.extract(df, trees).collect()
    want = "A & B\n\nFirst text, with words enough to be told.\n\nSecond one goes on, and ends here."
    assert sorted((x["page_id"] or -1, x["text"], x["n_chars"]) for x in got) == sorted(
        [(1, want, len(want)), (1, want, len(want)), (-1, want, len(want)), (2, "", 0), (3, "", 0), (4, "", 0)]
    )


def test_choices_never_contradict(trees):
    from loadlens.llm import layouts

    for page in layouts.pages(40, 99):
        order = dom.parse(page)
        scores = [random.Random(len(page) + k).uniform(-1, 1) for k in range(len(order))]
        dom.features(order)
        kept = dom.decode(order, scores).split("\n\n")
        assert set(filter(None, kept)) <= {n.text for n in order if n.text}
    assert dom.parse("")[0].tag == "#root" and len(dom.parse("<p" * 1000)) >= 1


def test_given_pages_match_their_articles(spark, trees):
    import html
    import re

    rows = spark.read.parquet(f"{FOLDER}/pages.parquet").filter("html IS NOT NULL")
    got = {x["page_id"]: x["text"] for x in extract.extract(rows, trees).collect()}
    for x in rows.collect():
        article = re.sub("<br>", " ", re.sub("</?b>", "", re.search(r"<article>(.*?)</article>", x["html"], re.S)[1]))
        blocks = [re.sub(r"\s+", " ", html.unescape(b)).strip() for b in re.split("</?(?:p|h1)>", article)]
        assert got[x["page_id"]] == "\n\n".join(b for b in blocks if b)


# URL lists


def test_entries_count_from_their_date_to_the_next(spark):
    day = lambda m, d=1: datetime.datetime(2024, m, d)
    entries = spark.createDataFrame(
        [
            ("host", "a.b.com", "block", day(2)), ("host", "A.b.com", "allow", day(4)), ("domain", "b.com", "block", day(3)),
            ("path", "a.b.com/x", "block", day(1)), ("host", "a.b.com", "block", day(4)), ("host", None, "block", day(1)),
        ],
        "kind string, key string, action string, listed_at timestamp",
    )
    captures = spark.createDataFrame(
        [
            (1, "http://a.b.com/", day(1)), (2, "http://a.b.com/", day(2)), (3, "https://c.b.com/y", day(2, 28)),
            (4, "https://u@C.B.com.:8/y", day(3)), (5, "http://a.b.com/x?q", day(1)), (6, "http://a.b.com/y", day(5)), (7, None, day(3)),
            (8, "http://a.b.com/", None), (9, "no url", day(3)), (2, "http://a.b.com/", day(2)), (None, "http://a.b.com/", day(2)),
        ],
        "page_id long, url string, fetched_at timestamp",
    )
    got = urlfilter.filter_captures(clashing(captures, "key", "action"), entries).collect()
    assert sorted((x["page_id"] or 0, x["action"]) for x in got) == [
        (0, "block"), (1, "allow"), (2, "block"), (2, "block"), (3, "allow"), (4, "block"), (5, "block"), (6, "block"),
        (7, "allow"), (8, "allow"), (9, "allow"),
    ]
    assert {x["action"] for x in urlfilter.filter_captures(captures, entries.limit(0)).collect()} == {"allow"}
    assert urlfilter.filter_captures(captures.limit(0), entries).count() == 0


def test_path_entries_keep_the_case_of_the_path(spark):
    at = datetime.datetime(2024, 3, 1)
    pages = spark.createDataFrame([(1, "https://A.example/Docs/x", at), (2, "https://a.example/docs/x", at)], "page_id long, url string, fetched_at timestamp")
    entries = spark.createDataFrame([("path", "A.Example/Docs", "block", at)], "kind string, key string, action string, listed_at timestamp")
    got = {x["page_id"]: (x["action"], x["matched_key"]) for x in urlfilter.filter_captures(pages, entries).collect()}
    assert got == {1: ("block", "a.example/Docs"), 2: ("allow", None)}


# WARC


def test_archives_come_back(spark):
    rows = [(3, "u 1\r\n", "same"), (1, None, "same"), (2, "u", ""), (5, "u", None), (3, "u", "same"), (9, "u", "é" * 300_000), (None, "u", "same")]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"), "payload", "first")
    index, back = warc.archive(pages, archive_bytes=200)
    got = sorted((x["page_id"] or -1, x["record_type"], x["refers_to"] or -1, x["payload_bytes"], x["payload_digest"]) for x in back.collect())
    d = lambda t: warc.digest_of(t.encode())
    assert got == sorted(
        [
            (1, "response", -1, 4, d("same")), (3, "revisit", 1, 4, d("same")), (3, "revisit", 1, 4, d("same")), (-1, "revisit", 1, 4, d("same")),
            (2, "response", -1, 0, d("")), (5, "revisit", 2, 0, d("")), (9, "response", -1, 600_000, d("é" * 300_000)),
        ]
    )
    assert index.count() == len(rows) and index.select("sidecar").distinct().count() >= 1
    _, alone = warc.archive(pages, min_revisit_bytes=5)
    assert {x["record_type"] for x in alone.collect()} == {"response"}
    assert warc.archive(pages.limit(0))[1].count() == 0


# Decontamination


def test_items_are_found_with_other_numbers_and_names(spark):
    item = "on Monday morning she told Maria that 12 km of road and 7 tons of sand were ready for Maria to move"
    other = item.replace("Maria", "Petra").replace("12", "30").replace(" 7 ", " 9 ")
    mixed = item.replace("told Maria", "told Petra").replace("for Maria", "for Olga")
    fill = " ".join(words(60, 1))
    texts = [f"{fill} {item} {fill}", f"{fill}, {other} {fill}", f"{fill} {mixed} {fill}", fill, None, "", item.upper(), f"{fill} {item}"]
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "tiny item here"), (None, item)], "item_id long, text string")
    docs = clashing(docs_of(spark, [*texts, f"a {fill} tiny item here {fill}"]), "item_id", "h", "pos")
    got = {(x["doc_id"], x["item_id"]): x["kind"] for x in decontaminate.contaminated(docs, items).collect()}
    assert got[(0, 1)] == "verbatim" and got[(1, 1)] == "reparameterised" and got[(7, 1)] == "verbatim" and got[(8, 4)] == "verbatim"
    assert (2, 1) not in got and not any(d in (3, 4, 5) for d, _ in got)
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    left = decontaminate.clean_documents(docs, items)
    assert left.columns == docs.columns and {x["doc_id"] for x in left.collect()} == set(range(9)) - {d for d, _ in got}


def test_copies_in_lower_case_or_with_other_line_breaks_are_found(spark):
    item = "then we asked Maria and later Petra whether old Tom or young Olga had seen Boris near the mill with Anna that day"
    fill = " ".join(words(40, 2))
    texts = [f"{fill} {x} {fill}" for x in (item.lower(), item.replace(" ", "\n"), item.replace(" ", "  "), item.upper())]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {x["doc_id"]: x["kind"] for x in decontaminate.contaminated(docs_of(spark, texts), items).collect()}
    assert got == dict.fromkeys(range(4), "verbatim")


def test_items_of_numbers_are_found_as_copies_only(spark):
    fill = " ".join(words(40, 3))
    texts = [f"{fill} 12 + 30 = 42 {fill}", f"{fill} 13 + 30 = 43 {fill}"]
    items = spark.createDataFrame([(1, "12 + 30 = 42")], "item_id long, text string")
    assert [(x["doc_id"], x["kind"]) for x in decontaminate.contaminated(docs_of(spark, texts), items).collect()] == [(0, "verbatim")]


def test_items_with_changed_words_and_long_runs_are_found(spark):
    short, mid, big = words(15, 4), words(37, 5), words(90, 6)
    change = lambda item, *at: [f"changed{k}" if k in at else w for k, w in enumerate(item)]
    fill = words(40, 7)
    texts = [change(short, 7), change(mid, 9, 18, 27), big[20:50], big[20:40]]
    items = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate((short, mid, big))], "item_id long, text string")
    docs = docs_of(spark, [" ".join(fill + t + fill) for t in texts])
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.contaminated(docs, items).collect()}
    assert got == {(0, 0), (1, 1), (2, 2)}


def test_all_planted_items_are_found(spark):
    import re

    fold = lambda t: re.sub(r"[^\w\s]", "", (t or "").lower()).split()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    joined = {x["doc_id"]: f" {' '.join(fold(x['text']))} " for x in docs.collect()}
    want = {(d, x["item_id"]) for x in items.collect() for d, t in joined.items() if f" {' '.join(fold(x['text']))} " in t}
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.contaminated(docs, items).collect()}
    assert want and got == want


def test_a_benchmark_of_many_blocks_gives_the_same_rows(spark):
    docs = clashing(spark.read.parquet(f"{FOLDER}/documents.parquet"), "h", "pos", "c", "r")
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    whole, parts = decontaminate.contaminated(docs, items), decontaminate.contaminated(docs, items, block=700)
    assert sorted(whole.collect()) == sorted(parts.collect()) != []


def test_the_plan_of_the_lookup_stays_small_and_makes_the_words_once(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    hashes = spark.range(5000).select(F.xxhash64("id").alias("h"))
    plan = decontaminate._met(docs, "doc_id", "text", hashes, [(False, 8), (True, 8)], 8)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000 and plan.count("split(") == 2


def test_a_very_long_text_is_searched_whole(spark):
    item = " ".join(words(30, 8))
    text = " ".join(words(300_000, 9)) + " " + item
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = docs_of(spark, [text, text, "--- " * 100_000])
    got = {(x["doc_id"], x["item_id"], x["cover"]) for x in decontaminate.contaminated(docs, items).collect()}
    assert got == {(0, 1, 1.0), (1, 1, 1.0)}


# Quality


def test_policies_read_the_ledger(spark):
    good = " ".join(words(80, 2, [a + b + "er" for a in "abcdefgh" for b in "ijklmnopqrst"]))
    texts = [good, "a b c " * 40, "### $$$ " * 60, good.upper() + "!", None, "", "short text"]
    docs = clashing(docs_of(spark, texts), "failed", "n_words")
    book = quality.ledger(docs)
    bits = {x["doc_id"]: x["failed"] for x in book.collect()}
    assert bits[0] == 0 and bits[1] & quality.bits_of("repeated_words") and bits[2] & quality.bits_of("symbols", "few_letters")
    assert bits[3] == quality.bits_of("shouting") and bits[4] & quality.bits_of("few_words")
    assert {x["doc_id"] for x in book.filter(quality.passes(quality.LENIENT)).collect()} == {0, 3}
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns and [x["doc_id"] for x in kept.collect()] == [0]
    dropped = {x["rule"]: x["n_gained"] for x in quality.ablations(book).filter("policy = 'strict'").collect()}
    assert dropped["shouting"] == 1
    assert quality.ablations(book.limit(0)).agg(F.sum("n_failing")).first()[0] == 0


def test_repeated_windows_by_both_ways(spark):
    r = random.Random(5)
    texts = [" ".join(r.choice("abcdefgh"[: r.randint(1, 8)]) for _ in range(r.randint(0, 90))) for _ in range(120)]
    got = {x["doc_id"]: x["n_repeat_words"] for x in quality.measures(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        w = t.split()
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        assert got[i] == len({k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)})


# Passages


def test_shared_passages(spark):
    shared = words(70, 10)
    fuzzy = [w if k % 23 else "changed" for k, w in enumerate(shared)]
    body = lambda k: words(120, 100 + k)
    texts = [
        " ".join(body(0) + shared + body(1)), " ".join(body(2) + shared), " ".join(fuzzy + body(3)), " ".join(body(4) + shared[:30] + body(5)),
        " ".join(body(6)), " ".join(body(6)), None, "", "few words only",
    ]
    docs = clashing(docs_of(spark, texts), "id", "h", "start")
    got = {(x["doc_id"], x["kind"]): (x["other_id"], x["start"], x["end"]) for x in passages.shared_passages(docs).collect()}
    assert got[(1, "passage")] == (0, 120, 190)
    assert got[(2, "passage")][0] in (0, 1) and got[(2, "passage")][2] >= 60
    assert got[(5, "copy")] == (4, 0, 120) and {d for d, _ in got} == {1, 2, 5}
    left = {x["doc_id"]: x["text"] for x in passages.without_repeats(docs).collect()}
    assert left[1].split() == body(2) and left[0] == texts[0] and left[3] == texts[3] and 5 not in left
    assert passages.shared_passages(docs.limit(0)).count() == 0


def test_a_passage_in_many_documents(spark):
    shared = " ".join(words(80, 20))
    texts = [" ".join(words(60, 300 + k)) + " " + shared for k in range(400)]
    found = passages.shared_passages(docs_of(spark, texts).repartition(7))
    rows = found.collect()
    assert {x["doc_id"] for x in rows} == set(range(1, 400)) and len(rows) <= 3 * 400


def test_a_passage_whose_seeds_have_different_first_holders(spark, monkeypatch):
    shared = words(60, 30)
    texts = [shared[:30], shared, shared[:30], shared[30:], shared]
    docs = docs_of(spark, [" ".join(words(60, 310 + k) + t + words(60, 330 + k)) for k, t in enumerate(texts)])
    rows = []
    for parts, at_once in ((1, 150_000), (3, 150_000), (5, 1)):
        monkeypatch.setattr(passages, "SEEDS_AT_ONCE", at_once)
        rows.append(sorted(map(tuple, passages.shared_passages(docs.repartition(parts)).collect())))
    assert [x[:2] for x in rows[0]] == [(4, 1)] and rows[0][0][2] <= 60 and rows[0][0][3] >= 120
    assert rows[1] == rows[0] and rows[2] == rows[0]


def test_a_passage_that_stands_twice_in_a_document(spark, monkeypatch):
    shared, own = words(60, 40), words(60, 41)
    docs = docs_of(spark, [" ".join(shared + words(60, 42)), " ".join(shared + own + shared), " ".join(words(60, 43) + shared)])
    rows = []
    for parts, at_once in ((1, 150_000), (3, 1)):
        monkeypatch.setattr(passages, "SEEDS_AT_ONCE", at_once)
        rows.append({x["doc_id"]: x["text"].split() for x in passages.without_repeats(docs.repartition(parts)).collect()})
    assert rows[0][1] == own and rows[0] == rows[1]


def test_a_passage_with_a_doubled_word(spark):
    import numpy as np

    shared = words(60, 50)
    texts = [shared, shared[:30] + shared[29:], shared[:40] + shared[41:]]
    docs = docs_of(spark, [" ".join(words(60, 51 + k) + t + words(60, 61 + k)) for k, t in enumerate(texts)])
    found = {(x["doc_id"], x["other_id"]): (x["start"], x["end"]) for x in passages.shared_passages(docs).collect()}
    assert found[1, 0][0] <= 60 and found[1, 0][1] >= 121 and found[2, 0][0] <= 60 and found[2, 0][1] >= 119
    at, bt, n = passages.cut_where_others_end(np.array([0, 9, 30]), np.array([0, 10, 31]), np.array([10, 20, 5]))
    assert list(zip(at, bt, n, strict=True)) == [(0, 0, 10), (9, 10, 1), (10, 11, 19), (30, 31, 5)]


def test_passages_with_a_word_changed_in_every_few(spark):
    cases = [(every, size) for every in (6, 8, 10, 12, 15) for size in (60, 100) for _ in range(4)]
    texts = []
    for i, (every, size) in enumerate(cases):
        shared = words(size, 5000 + i)
        changed = [f"changed{i}x{k}" if k % every == every // 2 else w for k, w in enumerate(shared)]
        texts += [" ".join(words(60, 6000 + i) + shared), " ".join(changed + words(60, 7000 + i))]
    got = {(x["doc_id"], x["other_id"]) for x in passages.shared_passages(docs_of(spark, texts)).collect()}
    assert {cases[i] for i in range(len(cases)) if (2 * i + 1, 2 * i) not in got} == set()


def test_stretches_that_could_hold_a_passage_by_brute_force():
    import numpy as np

    r = random.Random(9)
    for _ in range(150):
        m = r.randint(1, 8)
        begin = np.array([r.randint(0, 80) for _ in range(m)])
        end = begin + np.array([r.randint(1, 15) for _ in range(m)])
        union = {x for a, b in zip(begin, end, strict=True) for x in range(a, b)}
        spans = [
            (x, y) for x in union for y in range(x + 20, 100)
            if y - 1 in union and sum(z in union for z in range(x, y)) >= 0.8 * (y - x) - 1e-9
        ]
        want = [any(x <= a and b <= y for x, y in spans) for a, b in zip(begin, end, strict=True)]
        assert passages.could_hold(begin, end, 20, 0.8).tolist() == want


def test_occurrences_that_go_on_alike_have_a_side_key_in_common():
    import numpy as np

    r = np.random.default_rng(3)
    a = r.integers(1, 4, (20_000, 24)).astype(np.uint8)
    b = np.where(r.random(a.shape) < 0.25, r.integers(0, 4, a.shape), a).astype(np.uint8)
    h = np.full(len(a), 5, np.uint64)
    (x, there), (y, _) = passages.side_keys(h, a), passages.side_keys(h, b)
    alike = (x == y) & there
    left, right = passages._reaches(a, b)
    assert (alike[:, :6].any(axis=1) | (left < 5)).all() and (alike[:, 6:].any(axis=1) | (right < 5)).all()


def test_short_common_lines_make_no_pairs_of_all_texts(spark, monkeypatch):
    line, aligned = words(14, 900), []
    texts = [" ".join(words(40, 910 + k) + line + words(30, 1910 + k) + line[:8] + words(20, 2910 + k)) for k in range(60)]
    kept = passages.written
    monkeypatch.setattr(passages, "written", lambda df, label: aligned.append((label, kept(df, label))) or aligned[-1][1])
    assert passages.shared_passages(docs_of(spark, texts)).count() == 0
    assert {label: df.count() for label, df in aligned}["wanted"] < len(texts)


def entries_of(text):
    """The occurrences of each seed of a text, as they are listed for a pair."""
    import numpy as np

    _, place, h, around, _ = passages.laid_out([text], passages.K, passages.SPAN)
    marks = np.ascontiguousarray(around).view(np.int64).reshape(len(h), 3)
    out = {}
    for seed, at, m in zip(h.tolist(), place.tolist(), marks.tolist(), strict=True):
        out.setdefault(seed, []).append((at, passages.REACH, passages.REACH, *m))
    return out


def as_columns(rows):
    import numpy as np

    made = zip(*passages.in_steps(rows), strict=True)
    return dict(zip(passages.ENTRIES, (np.array(c, np.int64) for c in made), strict=True))


def test_passages_of_repeated_words_by_all_pairs_of_places():
    import numpy as np
    import pandas as pd

    r, found = random.Random(12), 0
    for case in range(40):
        bricks = [[w] * r.choice([2, 30, 55, 70]) for w in "xyz"] + [["p", "q"] * 30, ["k", "l", "m"] * 25, words(20, 1), words(60, 2), words(9, 3)]
        texts = [" ".join(w for _ in range(r.randint(1, 5)) for w in r.choice(bricks)) for _ in "ab"]
        mine, theirs = (entries_of(t) for t in texts)
        common = sorted(mine.keys() & theirs.keys())
        if not common:
            continue
        each = [(x, y) for h in common for x in mine[h] for y in theirs[h]]
        a, b = (np.array([e[side][3:] for e in each], np.int64).view(np.uint8).reshape(len(each), -1) for side in (0, 1))
        left, right = passages._reaches(a, b)
        at, bt = (np.array([e[side][0] for e in each]) for side in (0, 1))
        want = passages.judged(pd.DataFrame({"a": 2, "b": 1, "at": at - left, "bt": bt - left, "n": left + passages.K + right}), 50, 0.8)
        some = passages.pair_matches([as_columns(mine[h]) for h in common], [as_columns(theirs[h]) for h in common], passages.K, 50, 0.8)
        got = [] if some is None else passages.judged(pd.DataFrame({"a": 2, "b": 1, **dict(zip(("at", "bt", "n"), some, strict=True))}), 50, 0.8).values.tolist()
        assert sorted(got) == sorted(want.values.tolist()), case
        found += len(got)
    assert found > 20


def test_long_runs_of_a_word_are_not_paired_place_by_place():
    runs = {n: entries_of(" ".join(["word"] * n)) for n in (4000, 30)}
    (seed,) = runs[4000]
    assert len(passages.in_steps(runs[4000][seed])) <= 2 * passages.REACH + 1
    at, _, n = passages.pair_matches([as_columns(runs[4000][seed])], [as_columns(runs[4000][seed])], passages.K, 50, 0.8)
    assert len(at) < 8000 and n.max() == 4000
    assert passages.pair_matches([as_columns(runs[4000][seed])], [as_columns(runs[30][seed])], passages.K, 50, 0.8) is None


def test_a_run_of_a_word_meets_no_text_with_too_little_of_it(spark, monkeypatch):
    aligned = []
    texts = [" ".join(words(60, 910 + k) + ["word"] * 9 + words(60, 1910 + k)) for k in range(40)]
    texts += [" ".join(["word"] * n) for n in (200, 300)]
    kept = passages.written
    monkeypatch.setattr(passages, "written", lambda df, label: aligned.append((label, kept(df, label))) or aligned[-1][1])
    found = passages.shared_passages(docs_of(spark, texts)).collect()
    assert {(x["doc_id"], x["other_id"]) for x in found} == {(41, 40)}
    assert {(x["a"], x["b"]) for label, df in aligned if label == "wanted" for x in df.collect()} <= {(41, 40)}


def test_maps_of_shared_hashes_hold_all_of_them(spark):
    import numpy as np

    h, ids = np.random.default_rng(4).integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2), np.arange(3000) % 7
    both = np.concatenate((h[:1000], h[:500])), np.concatenate((ids[:1000], ids[:500] + 1))
    for log in (passages.LEAST_MAP_LOG, passages.map_log(1 << 24)):
        blocks = [passages._blocks(*x, log) for x in (both, (h[900:], ids[900:]))]
        rows = spark.createDataFrame([tuple(map(lambda v: v if isinstance(v, bytes) else int(v), r)) for x in blocks for r in x.values.tolist()], "bucket long, once binary, more binary")
        flags = passages._shared_map(rows.repartition(3), log)
        shared = np.concatenate((np.arange(500), np.arange(900, 1000)))
        assert len(flags) == 1 << log >> 3 and passages._marked(flags, h[shared], log).all()
        assert not passages._marked(flags, np.delete(h, shared), log).any()
    assert passages.map_log(0) == passages.LEAST_MAP_LOG and passages.map_log(1 << 40) == passages.MOST_MAP_LOG


def test_chains_are_the_best_by_brute_force():
    import numpy as np

    r = random.Random(8)
    for _ in range(60):
        m = r.randint(1, 9)
        at, bt, n = (np.array([r.randint(lo, hi) for _ in range(m)]) for lo, hi in ((0, 60), (0, 60), (3, 9)))
        best = {}

        def score(i, at=at, bt=bt, n=n, best=best, m=m):
            if i not in best:
                ahead = [
                    score(j) - passages.SKIP * (at[i] - at[j] - n[j] + bt[i] - bt[j] - n[j])
                    for j in range(m) if at[j] + n[j] <= at[i] and bt[j] + n[j] <= bt[i]
                ]
                best[i] = n[i] + max([0, *ahead])
            return best[i]

        links = passages.chain(at, bt, n)[0]
        gaps = sum(at[j] - at[i] - n[i] + bt[j] - bt[i] - n[i] for i, j in zip(links, links[1:], strict=False))
        assert sum(n[i] for i in links) - passages.SKIP * gaps == pytest.approx(max(score(i) for i in range(m)))


# Jaccard


def brute_components(texts, size, percent):
    sets = []
    for t in texts:
        w = (t or "").split()
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if either and 100 * both >= percent * either:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def near_copies(seed):
    r, out = random.Random(seed), []
    bases = [words(r.choice([3, 30, 90, 200]), seed * 50 + k) for k in range(4)]
    common_part = words(25, seed + 7)
    for _ in range(110):
        w = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
            w[r.randrange(len(w))] = f"n{r.randrange(10**6)}"
        out.append(" ".join(w + (common_part if r.random() < 0.2 else [])))
    return [*out, None, "", "  ", "a", "A", "a b", "long " * 20_000]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_are_those_of_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "LONG_LIST", 6)
    texts = near_copies(seed)
    got = jaccard.linked(clashing(docs_of(spark, texts), "n", "rep", "h")).orderBy("doc_id").collect()
    lower = [t.lower() if t else t for t in texts]
    assert [(x["n_shingles"], x["component_id"]) for x in got] == brute_components(lower, 4, 85)
    left = jaccard.one_of_each(docs_of(spark, texts))
    assert {x["doc_id"] for x in left.collect()} == {c for _, c in brute_components(lower, 5, 80)}


def test_repeated_and_missing_ids(spark):
    t = " ".join(words(40, 1))
    rows = [(5, t), (5, t), (2, t), (None, t), (7, None)]
    got = jaccard.linked(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x["doc_id"] or -1, x["component_id"] or -1) for x in got) == [(-1, -1), (2, 2), (5, 2), (5, 2), (7, 7)]
    assert jaccard.linked(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {x["vertex"]: x["component"] for x in got} == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}


# Languages


def test_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("out", langid.held_out(F.col("doc_id")))
    learned = langid.prototypes(docs.filter("NOT out"))
    told = langid.predict(docs, learned).join(docs.select("doc_id", "lang", "out"), "doc_id").filter("out AND lang IS NOT NULL")
    assert told.filter("lang = lang_pred").count() >= 0.97 * told.count()
    odd = docs_of(spark, [None, "", "123 !?", "the and of"])
    rows = {x["doc_id"]: x for x in langid.predict(clashing(odd, "score", "id"), learned).collect()}
    assert [rows[k]["lang_pred"] for k in range(3)] == ["und"] * 3 and 0 <= rows[3]["score"] <= 1
    assert {x["lang_pred"] for x in langid.predict(odd, learned.limit(0)).collect()} == {"und"}


def test_bundles_are_sums_of_bound_letters():
    import numpy as np

    b, v = langid.Binder(64, 1), lambda c: langid.letter_vector(ord(c) if c != " " else 0, 64, 1)
    want = sum(np.roll(v(x), 2) * np.roll(v(y), 1) * v(z) for x, y, z in (" ab", "ab ", "b c", " c "))
    assert (langid._bundles(b, ["Ab1c"], [0], 1)[0] == want).all()
    every = "".join(chr(c) for c in range(0x4E00, 0x4F00))
    assert langid._bundles(b, [every], [0], 1).shape == (1, 64)


# Pipeline


def test_every_stage_takes_effect(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    left = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before, left = left, common.written(stage(spark, left, FOLDER), f"stage-{k}")
        assert left.columns == docs.columns and left.count() <= before.count()
    ids = {x["doc_id"] for x in left.collect()}
    assert {x["doc_id"] for x in corpus_pipeline.run(spark, FOLDER).collect()} == ids
    text = {x["doc_id"]: x["text"] for x in docs.collect()}
    assert len(ids) < len(text) and all(len(text[i].split()) >= 50 for i in ids)
    assert [f(spark, docs.limit(0), FOLDER).count() for _, f in corpus_pipeline.STAGES] == [0] * 5


def test_models_are_read_whole():
    assert len(common.model_bytes(public_tokenizers.path("piece_bpe_32k.model"))) > 100_000
    with pytest.raises(ValueError):
        common.model_bytes(public_tokenizers.path("piece_bpe_32k.model"), 10)


def test_cuts_leave_repeated_ids_and_clashing_columns_alone(spark):
    shared, own = " ".join(words(90, 1)), " ".join(words(120, 2))
    rows = [(1, shared), (2, shared + " and more words here"), (3, own), (4, shared + " at the end"), (4, own + " other")]
    docs = spark.createDataFrame(rows, "key long, body string").withColumns({n: F.lit("kept") for n in ("_text", "_spans", "_key", "doc_id", "text")})
    left = {(x["key"], x["body"], x["_text"], x["_spans"], x["_key"], x["doc_id"], x["text"]) for x in
            passages.without_repeats(docs, id_col="key", text_col="body").collect()}
    kept = ("kept",) * 5
    assert left == {(1, shared, *kept), (2, "and more words here", *kept), (3, own, *kept), *[(k, t, *kept) for k, t in rows[3:]]}


def test_white_space_and_stray_tags_take_time_in_proportion():
    import time

    with open(queries.BYTE_MODEL, "rb") as f:
        counter = tokencount._counter(f.read(), 4_000_000)
    began = time.monotonic()
    for run in (" " * 300_000, "\n" * 300_000, "a" + " \n" * 100_000 + "b"):
        assert counter.all_prefixes(run)[-1] == counter.count(run)
    page = "<p>" + "<i>" * 60_000 + "word " + "</b>" * 60_000 + "</p>" + "</td>" * 60_000 + "<p>end</p>"
    assert [n.text for n in dom.parse(page) if n.text] == ["word", "end"]
    assert time.monotonic() - began < 30
