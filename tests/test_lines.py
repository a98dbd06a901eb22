import gzip
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from loadlens.operators import structure
from loadlens.sources import inventory, sinks
from loadlens.sources.lines import first_lines, head_lines, number_lines, read_lines, split_lines


@pytest.fixture
def small_splits(spark):
    """Many splits per file, so that order across splits matters."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_line_numbers_across_splits(spark, write_file, tmp_path, small_splits):
    want = set()
    for name in ("a", "b", "c"):
        body = [f"{name}{i}" + "x" * random.Random(i).randrange(40) for i in range(1, 501)]
        write_file(f"n/{name}.txt", "\n".join(body) + ("\n" if name != "c" else ""))
        want |= {(line, i) for i, line in enumerate(body, 1)}
    lines = read_lines(spark, str(tmp_path / "n"))
    assert lines.rdd.getNumPartitions() > 8
    got = number_lines(lines, lines).select("value", "line_no").collect()
    assert {tuple(r) for r in got} == want
    some = lines.filter(F.col("value").rlike("^b.*7"))
    got = {tuple(r) for r in number_lines(some, lines).select("value", "line_no").collect()}
    assert got == {(v, i) for v, i in want if v.startswith("b") and "7" in v}


def test_head_and_first_lines(spark, write_file, tmp_path, small_splits):
    for name in ("a", "b"):
        write_file(f"h/{name}.txt", "".join(f"{name}{i} {'y' * 50}\n" for i in range(1, 301)))
    lines = read_lines(spark, str(tmp_path / "h"))
    head = head_lines(lines, 12)
    got = rows(head.select(F.substring_index("value", " ", 1), "line_no"))
    assert got == sorted((f"{n}{i}", i) for n in "ab" for i in range(1, 13))
    assert rows(first_lines(lines).select(F.substring_index("first_line", " ", 1))) == [("a1",), ("b1",)]
    plan = head._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[1] + plan.split("Exchange")[-1]


@pytest.mark.parametrize(
    "body,crlf,lf,cr,kind",
    [
        (b"a\r\nb\r\n", 2, 0, 0, "CRLF"),
        (b"a\nb\n", 0, 2, 0, "LF"),
        (b"a\nb", 0, 1, 0, "LF"),
        (b"a\rb\rc", 0, 0, 2, "CR"),
        (b"a\r\nb\nc\r\n", 2, 1, 0, "Mixed"),
        (b"abc", 0, 0, 0, "None"),
        (b"a\r\nb\r", 1, 0, 1, "CRLF"),
        (b"a\rb\nc\n", 0, 2, 1, "LF"),
        (b"\xef\xbb\xbfa\r\nb\r\n", 2, 0, 0, "CRLF"),
        (b"\xef\xbb\xbfa\nb", 0, 1, 0, "LF"),
    ],
)
def test_line_endings(spark, write_file, body, crlf, lf, cr, kind):
    lines = read_lines(spark, write_file("e.txt", body))
    assert rows(structure.line_endings(lines), "crlf", "lf", "cr", "line_ending") == [(crlf, lf, cr, kind)]


@pytest.mark.parametrize(
    "body,bom,invalid",
    [
        (b"plain\n", None, 0),
        ("käse\n".encode(), None, 0),
        ("käse\n".encode("latin-1"), None, 1),
        (b"\xef\xbb\xbfa,b\n1,2\n", "UTF-8", 0),
        (b"\xef\xbb\xbfa,b\n1,2", "UTF-8", 0),
        (b"\xff\xfea\x00\n\x00", "UTF-16LE", 1),
        (b"\xfe\xff\x00a\x00\n", "UTF-16BE", 1),
    ],
)
def test_encoding(spark, write_file, body, bom, invalid):
    lines = read_lines(spark, write_file("c.txt", body))
    assert rows(structure.encoding_evidence(lines), "bom", "invalid_lines") == [(bom, invalid)]


def test_defects_are_found(spark, write_file):
    good = "1\ta\tx\n"
    body = good * 3 + "2\tb\n" + "3\tc\tx\ty\n" + "4\td\tn\x00\n" + "5\te\tc\x01\n" + f"6\tf\t{'z' * 12000}\n" + '7\tg\t"\n'
    lines = read_lines(spark, write_file("d.tsv", body))
    assert rows(structure.ragged_rows(lines, "\t"), "line_no", "columns", "expected") == [(4, 2, 3), (5, 4, 3)]
    got = rows(structure.problem_rows(lines, "\t", expected=3), "kind", "line_no", "measure")
    assert got == [("null_byte", 6, 1), ("too_few", 4, 2), ("too_many", 5, 4), ("very_long", 8, 12004)]
    assert rows(structure.special_characters(lines).drop("file")) == [(1, 2, 0, 0)]
    assert rows(structure.quote_check(lines).drop("file")) == [(1, 0)]
    assert rows(structure.column_counts(lines, "\t").drop("file")) == [(2, 4, False)]


def test_problem_samples_are_the_first_ones(spark, write_file, small_splits):
    body = "".join("a\tb\n" if i % 2 else f"short{'q' * 60}\n" for i in range(1, 401))
    lines = read_lines(spark, write_file("p.tsv", body))
    got = rows(structure.problem_rows(lines, "\t", expected=2, samples=5), "line_no", "kind")
    assert got == sorted(((i, "too_few") for i in (2, 4, 6, 8, 10)), key=lambda r: str(r[0]))


def test_malformed_file_is_cleaned(spark, write_file, tmp_path):
    body = "col1\tcol2\tcol3\nv1\tv2\tv3\nshort\tx\nlong\ta\tb\tc\nnul\t\x00\tb\n"
    lines = read_lines(spark, write_file("m.tsv", body))
    counts = structure.write_clean(lines, str(tmp_path / "clean"), "\t").collect()[0]
    assert (counts["total_lines"], counts["clean_lines"], counts["removed_lines"]) == (5, 2, 3)
    kept = [r[0] for r in spark.read.option("lineSep", "\n").text(str(tmp_path / "clean" / "keep=true")).collect()]
    assert sorted(kept) == ["col1\tcol2\tcol3", "v1\tv2\tv3"]


def test_empty_file(spark, write_file):
    lines = read_lines(spark, write_file("empty.tsv", ""))
    for op in (structure.row_counts, structure.line_endings, structure.file_characteristics, structure.quote_check):
        assert op(lines).count() == 0


def test_compare_pair(spark, write_file, tmp_path):
    write_file("p/a.tsv", "id\tname\n" + "1\tx\n" * 50000)
    write_file("p/b.tsv", "id\tname\n" + "1\tx\n" * 50000)
    write_file("p/c.csv", "id,name,extra\r\n" + "1,x,y\r\n" * 100000)
    lines = read_lines(spark, str(tmp_path / "p"))
    path = {r[0].rsplit("/", 1)[1]: r[0] for r in lines.select("file").distinct().collect()}
    same = structure.compare_pair(lines, path["a.tsv"], path["b.tsv"]).collect()[0]
    assert same["compatible"] and same["differences"] == [] and same["warnings"] == []
    other = structure.compare_pair(lines, path["a.tsv"], path["c.csv"]).collect()[0]
    assert other["differences"] == ["size", "line_ending", "column_count", "delimiter"]
    assert "line count" in other["warnings"] and not other["compatible"]


def test_split_lines_follow_file_rules(spark):
    df = spark.createDataFrame([(1, "a\nb\n"), (2, "a\nb"), (3, ""), (4, "\n"), (5, None)], "k int, t string")
    got = rows(split_lines(df, "k", "t").select("file", "seq", "value"))
    assert got == [(1, 0, "a"), (1, 1, "b"), (2, 0, "a"), (2, 1, "b"), (4, 0, "")]


def test_gzip_copy_and_ratio(spark, write_file, tmp_path):
    body = "".join(f"{i}\tvalue\n" for i in range(5000))
    source = write_file("z/in.tsv", body)
    target = str(tmp_path / "out")
    sinks.compressed_copy(spark, source, target)
    text = b"".join(gzip.open(p).read() for p in sorted((tmp_path / "out").glob("source=*/part-*.gz")))
    assert text.decode() == body
    ratio = sinks.compression_ratio(spark, source, target).collect()[0]
    assert ratio["source_bytes"] == len(body) and 50 < ratio["saved_pct"] < 100


def test_broken_gzip_fails(spark, tmp_path):
    path = tmp_path / "bad.tsv.gz"
    noise = random.Random(1)
    whole = gzip.compress("".join(f"{noise.random()}\n" for _ in range(5000)).encode())
    path.write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception, match="(?i)unexpected end|EOF"):
        read_lines(spark, str(path)).count()


def test_chunks_and_samples(spark, write_file, tmp_path):
    source = write_file("s/in.tsv", "".join(f"{i}\n" for i in range(1, 1001)))
    sinks.split_files(spark, source, str(tmp_path / "chunks"), 300)
    counts = [r[0] for r in structure.row_counts(read_lines(spark, str(tmp_path / "chunks"))).select("row_count").collect()]
    assert sum(counts) == 1000 and max(counts) == 300
    sinks.write_sample(read_lines(spark, source), str(tmp_path / "sample"), 20)
    got = [int(r[0]) for r in spark.read.text(str(tmp_path / "sample")).collect()]
    assert sorted(got) == list(range(1, 21))


def test_inventory_does_not_read_contents(spark, write_file, tmp_path):
    write_file("i/b.csv", "xx")
    write_file("i/sub/a.tsv", "yyyy")
    write_file("i/Data_X.csv.gz", "zzz")
    files = inventory.file_inventory(spark, str(tmp_path / "i"))
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    name = inventory.base_name(F.col("path"))
    assert [r[0] for r in inventory.sort_inventory(files, "name").select(name).collect()] == ["a.tsv", "b.csv", "Data_X.csv.gz"]
    assert [r[0] for r in inventory.sort_inventory(files, "size", True).select(name).collect()][1:] == ["a.tsv", "b.csv"]
    assert rows(inventory.filter_inventory(files, "data GZ").select(name)) == [("Data_X.csv.gz",)]


def test_previous_row_across_chunks(spark):
    data = [(g, i * 3 + (i % 2), f"{g}{i}") for g, n in (("hot", 500), ("cold", 3), ("one", 1)) for i in range(n)]
    df = spark.createDataFrame(data, "g string, o bigint, name string").repartition(7)
    got = structure.with_previous(df, "g", "o", chunks=20).select("g", "o", "was.name")
    want, last = [], {}
    for g, o, name in data:
        want.append((g, o, last.get(g)))
        last[g] = name
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_width_of_the_first_line_rules(spark, write_file, tmp_path, small_splits):
    write_file("w/even.tsv", "a\tb\n" * 900)
    write_file("w/odd.tsv", "a\tb\tc\n" + "a\tb\n" * 899)
    got = structure.ragged_rows(read_lines(spark, str(tmp_path / "w")), "\t")
    assert got.count() == 899 and got.agg({"line_no": "min"}).collect()[0][0] == 2
