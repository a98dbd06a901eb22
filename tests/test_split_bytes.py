import os
import random

from loadlens.sources import sinks


def test_chunks_by_bytes_hold_all_lines_in_order(spark, write_file, tmp_path):
    r = random.Random(3)
    lines = [r.choice("aé") * r.choice([0, 1, 40, 300]) for _ in range(4000)]
    write_file("in/a.tsv", "\n".join(lines) + "\n")
    write_file("in/b.tsv.gz", "x\r\ny\n\n")
    write_file("in/empty.tsv", "")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")  # many splits of one file
    try:
        sinks.split_files_by_bytes(spark, str(tmp_path / "in"), str(tmp_path / "out"), 10_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    made = {}
    for top, _, names in os.walk(tmp_path / "out"):
        for name in names:
            if name.startswith("part-"):
                source, chunk = top.split("/")[-2:]
                key = source[-8:], int(chunk.split("=")[1])
                assert key not in made
                with open(os.path.join(top, name), "rb") as f:
                    made[key] = f.read()
    big = [made[k] for k in sorted(made) if k[0].endswith("a.tsv")]
    assert b"".join(big).decode() == "\n".join(lines) + "\n" and len(big) > 20
    at = 0
    for body in big:  # every chunk begins in its own stretch of bytes and its last line begins there too
        assert at // 10_000 == (at + body[:-1].rfind(b"\n") + 1) // 10_000
        at += len(body)
    assert [v for k, v in made.items() if not k[0].endswith("a.tsv")] == [b"x\r\ny\n\n"]
