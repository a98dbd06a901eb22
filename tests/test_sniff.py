import pytest

from loadlens.operators import sniff
from loadlens.sources.inventory import file_inventory
from loadlens.sources.lines import read_lines


def detect(spark, path):
    row = sniff.detect_format(read_lines(spark, path)).collect()[0]
    return row.asDict()


@pytest.mark.parametrize(
    "name,body,fmt,delimiter,method",
    [
        ("a.csv", "name,age,city\nJohn,30,NYC\nJane,25,LA\n", "CSV", ",", "extension"),
        ("a.tsv", "name\tage\tcity\nJohn\t30\tNYC\n", "TSV", "\t", "extension"),
        ("a.txt", "id,name,value\n1,a,10\n2,b,20\n3,c,30\n", "CSV", ",", "content"),
        ("b.txt", "id|name|value\n1|a|10\n2|b|20\n3|c|30\n", "CSV", "|", "content"),
        ("c.txt", "id;name;value\n1;a;10\n2;b;20\n3;c;30\n", "CSV", ";", "content"),
        ("d.txt", "id\tname\n1\ta\n", "TSV", "\t", "content"),
        ("a.csv.gz", "name,age\nJohn,30\n", "CSV", ",", "extension"),
        ("plain.txt", "nothing\nhere\n", "CSV", ",", "fallback"),
        ("mixed.txt", "a,b,c\td\n1,2,3\t4\n5,6,7\t8\n", "CSV", ",", "content"),
    ],
)
def test_format(spark, write_file, name, body, fmt, delimiter, method):
    got = detect(spark, write_file(name, body))
    assert (got["format"], got["delimiter"], got["method"]) == (fmt, delimiter, method)
    assert got["quote_char"] == ('"' if fmt == "CSV" else None)
    if method == "extension":
        assert got["confidence"] == 0.9 and got["has_header"]
    if method == "fallback":
        assert got["confidence"] == 0.3 and not got["has_header"]


def test_empty_file_is_known_by_its_listing(spark, write_file):
    path = write_file("empty.csv", "")
    files = file_inventory(spark, path, with_empty=True)
    got = sniff.detect_format(read_lines(spark, path), files).collect()[0]
    assert (got["format"], got["delimiter"], got["method"], got["has_header"]) == ("CSV", ",", "extension", False)


def test_header_is_text_or_numbers(spark, write_file):
    assert detect(spark, write_file("h.txt", "Name,Age,Salary\nJohn,30,5\n"))["has_header"]
    assert not detect(spark, write_file("n.txt", "1,2,3\n4,5,6\n7,8,9\n"))["has_header"]


def test_confidence_is_capped_and_falls_with_variance(spark, write_file):
    even = sniff.detect_delimiter(read_lines(spark, write_file("e.txt", "a,b\nc,d\n"))).collect()[0]
    assert even["confidence"] == 1.0
    uneven = sniff.detect_delimiter(read_lines(spark, write_file("u.txt", "a;b\nc;d;e\n"))).collect()[0]
    assert uneven["confidence"] == pytest.approx(1 / 1.25)


def test_validate_delimiter(spark, write_file):
    lines = read_lines(spark, write_file("v.csv", "a,b,c\n1,2,3\n4,5,6\n"))
    assert sniff.validate_delimiter(lines, ",").collect()[0]["valid"]
    assert not sniff.validate_delimiter(lines, "\t").collect()[0]["valid"]
    ragged = read_lines(spark, write_file("r.csv", "a,b,c\n1,2\n4,5,6,7,8\n"))
    got = sniff.validate_delimiter(ragged, ",").collect()[0]
    assert got["valid"] and got["variance"] == pytest.approx(1.5556, abs=1e-3)


def test_only_the_sampled_lines_count(spark, write_file):
    body = "".join(f"a;b{i}\n" for i in range(10)) + "no separator\n" * 50
    lines = read_lines(spark, write_file("s.txt", body))
    assert sniff.detect_delimiter(lines, 10).count() == 1
    assert sniff.detect_delimiter(lines, None).count() == 0
