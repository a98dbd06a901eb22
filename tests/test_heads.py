"""First lines of files without reading the rest."""

import bz2
import gzip
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from loadlens.operators import profile, sniff
from loadlens.sources import heads
from loadlens.sources.inventory import file_inventory
from loadlens.sources.lines import first_lines, head_lines, read_lines

HEADER = "order_id,customer name,amount\n"


@pytest.fixture(scope="module")
def large(tmp_path_factory):
    """A sparse file of 1 GB that begins with a header and some rows."""
    path = tmp_path_factory.mktemp("large") / "big one.csv"
    with open(path, "wb") as f:
        f.write((HEADER + "".join(f"{i},name {i},{i}.5\n" for i in range(2000))).encode())
        f.truncate(1 << 30)
    return str(path)


def test_a_header_test_reads_under_a_megabyte(spark, large):
    head = heads.read_heads(spark, large, 20)
    assert head.agg(F.max("bytes_read")).first()[0] <= 1 << 20
    got = sniff.header_tests(head, ",").collect()
    assert [tuple(r)[1:] for r in got] == [(True, True, True)]
    assert got[0]["file"].endswith("big%20one.csv")
    before = int(open("/proc/self/io").read().split("rchar: ")[1].split()[0])
    heads.first_lines_of("file:" + large.replace(" ", "%20"), 20)
    assert int(open("/proc/self/io").read().split("rchar: ")[1].split()[0]) - before < 1 << 20


def test_heads_equal_the_full_scan(spark, write_file, tmp_path):
    r = random.Random(2)
    body = lambda n: "".join(f"{k}\t{'y' * r.randrange(900)}\r\n" for k in range(n))
    write_file("h/a.txt", body(400))
    write_file("h/sub folder/b.tsv", body(3) + "no line feed")
    write_file("h/c.csv", "")
    write_file("h/d.csv", "\n\n\nx")
    write_file("h/bom.csv", b"\xef\xbb\xbfa,b\n1,2\n")
    write_file("h/bad.csv", b"caf\xe9,\xff\xfe\n\x00,2\n")
    write_file("h/_skip.csv", "not,seen\n")
    write_file("h/.skip/e.csv", "not,seen\n")
    write_file("h/long.csv", "z" * 3_000_000 + "\nend\n")
    write_file("h/e.csv.gz", body(500))
    (tmp_path / "h" / "two.csv.gz").write_bytes(gzip.compress(b"a,b\n1,") + gzip.compress(b"2\n3,4\n"))
    (tmp_path / "h" / "f.csv.bz2").write_bytes(bz2.compress(body(90).encode()))
    whole = read_lines(spark, str(tmp_path / "h"))
    for count in (1, 7, 10_000):
        head = heads.read_heads(spark, str(tmp_path / "h"), count, files_per_task=3)
        assert head.rdd.getNumPartitions() == 4
        cells = ["file", "file_size", "line_no", F.hex("value")]
        assert rows(head.select(*cells)) == rows(head_lines(whole, count).select(*cells))
    one = heads.read_heads(spark, [str(tmp_path / "h" / "a.txt"), f"file://{tmp_path}/h/d.csv"], 2)
    assert {r["line_no"] for r in one.collect()} == {1, 2} and one.count() == 4
    assert heads.read_heads(spark, str(tmp_path / "h"), glob="*.tsv").count() == 1


def test_operators_take_heads_as_lines(spark, write_file, tmp_path):
    write_file("p/fact_orders_2024-01.csv", HEADER + "1,Ann,2\n" * 500)
    write_file("p/items_2024-02.dat", "id;qty\n" + "1;2\n" * 500)
    write_file("p/empty.csv", "")
    folder = str(tmp_path / "p")
    whole, head = read_lines(spark, folder), heads.read_heads(spark, folder, 100)
    files = file_inventory(spark, folder)
    same = lambda f: rows(f(head)) == rows(f(whole))
    assert same(lambda x: sniff.detect_format(x, files, 100))
    assert same(first_lines)
    assert same(lambda x: sniff.header_tests(x, ","))
    assert same(lambda x: profile.propose_contracts(x, sample_lines=100))


def test_rows_are_estimated_from_the_head(spark, write_file, tmp_path):
    r = random.Random(4)
    body = "".join(f"{k},{r.random()},{'x' * r.randrange(30)}\n" for k in range(120_000))
    write_file("s/plain.csv", body)
    write_file("s/packed.csv.gz", body)
    write_file("s/small.csv", "a\nb\nc")
    write_file("s/empty.csv", "")
    samples = heads.read_samples(spark, str(tmp_path / "s"), 64 << 10)
    got = {os.path.basename(x["file"]): x for x in heads.estimated_rows(samples).collect()}
    assert (got["small.csv"]["estimated_rows"], got["small.csv"]["exact"]) == (3, True)
    assert (got["empty.csv"]["estimated_rows"], got["empty.csv"]["exact"]) == (0, True)
    for name in ("plain.csv", "packed.csv.gz"):
        assert not got[name]["exact"] and got[name]["bytes_read"] <= 128 << 10
        assert abs(got[name]["estimated_rows"] / 120_000 - 1) < 0.05


def test_broken_archives_and_missing_paths_fail(spark, tmp_path):
    (tmp_path / "cut.csv.gz").write_bytes(gzip.compress(os.urandom(100_000))[:50_000])
    with pytest.raises(Exception, match="ends inside"):
        heads.read_heads(spark, str(tmp_path / "cut.csv.gz"), 10**6).collect()
    with pytest.raises(Exception, match="nowhere"):
        heads.read_heads(spark, str(tmp_path / "nowhere")).collect()
