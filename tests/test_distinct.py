import datetime as dt

from loadlens.contracts import Contract
from loadlens.streaming.distinct import PROVIDER, ingest_distinct, run_distinct
from tests.conftest import rows

AT = dt.datetime(2024, 1, 1)
SCHEMA = "k string, at timestamp, v int"


def arrive(spark, folder, *made):
    """A file with rows of (key, day, value)."""
    data = [(k, None if day is None else AT + dt.timedelta(days=day), v) for k, day, v in made]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_a_key_of_a_later_file_appears_once_after_a_restart(spark, tmp_path):
    folder, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    before = spark.conf.get(PROVIDER, None)

    def run():
        return run_distinct(spark.readStream.schema(SCHEMA).parquet(folder), ["k"], "at", target, state, "10 days")

    arrive(spark, folder, ("a", 0, 1), ("b", 1, 1), (None, 1, 1), (None, 1, 1), ("x", None, 1))
    first = run()
    assert (first.rows_in, first.kept, first.duplicates, first.late, first.untimed) == (5, 3, 1, 0, 1)
    arrive(spark, folder, ("a", 2, 2), ("c", 2, 2), (None, 2, 2))
    second = run()
    assert (second.kept, second.duplicates, second.late, second.open_keys) == (1, 2, 0, 4)
    # Far ahead: the watermark passes the old keys, which leave the state; what lies behind it is late.
    arrive(spark, folder, ("d", 100, 3))
    assert run().open_keys == 1
    arrive(spark, folder, ("a", 3, 4), ("d", 101, 4), ("e", 95, 4))
    last = run()
    assert (last.kept, last.duplicates, last.late, last.open_keys) == (1, 1, 1, 2)
    assert rows(spark.read.parquet(target), "k", "v") == [(None, 1), ("a", 1), ("b", 1), ("c", 2), ("d", 3), ("e", 4)]
    assert spark.conf.get(PROVIDER, None) == before


def test_a_contracts_files_load_each_key_once(spark, write_file, tmp_path):
    made = Contract("t_*.tsv", "T", ("id", "day"), types={"day": "date"})
    args = (spark, made, str(tmp_path / "land"), str(tmp_path / "table"), str(tmp_path / "state"), ["id"], "day")
    write_file("land/2024-01/t_1.tsv", "1\t2024-01-05\n2\t2024-01-06\n1\t2024-01-05\n")
    assert ingest_distinct(*args).kept == 2
    assert ingest_distinct(*args).rows_in == 0
    write_file("land/2024-02/t_2.tsv", "2\t2024-01-20\n3\t2024-02-01\n")
    run = ingest_distinct(*args)
    assert (run.kept, run.duplicates) == (1, 1)
    got = spark.read.parquet(str(tmp_path / "table")).groupBy("period").count()
    assert [(str(p), n) for p, n in rows(got)] == [("2024-01", 2), ("2024-02", 1)]
