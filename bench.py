"""Timings of the headline operators; prints one JSON line.

BENCH_SF_DIR  folder of the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)

Every query runs twice to warm up and is then timed three times. File operators work on
``lineitem`` written as tab-separated text beforehand; that write is not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from loadlens import queries as registry  # noqa: E402
from loadlens.contracts import Contract  # noqa: E402
from loadlens.operators import profile, structure  # noqa: E402
from loadlens.plans import load  # noqa: E402
from loadlens.session import build_session, scratch  # noqa: E402
from loadlens.sources import sinks  # noqa: E402
from loadlens.sources.lines import read_lines  # noqa: E402

COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)
LINEITEM = Contract(
    "lineitem_{date_range}.tsv", "lineitem", COLUMNS, "l_shipdate", ("l_orderkey", "l_linenumber"), quote_char=None,
    types={
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
        "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
        "l_shipdate": "date",
    },
)
HEADLINE = (
    "classified_days", "volume_anomalies", "missing_dates_calendar", "date_gaps", "text_date_series", "dup_stats",
    "dup_samples", "dup_long_text", "validate_tables", "validate_month", "table_report", "delete_keep_month",
    "delete_impact_multi", "column_profile_texts", "type_guess_dates", "value_classes_dates", "key_candidates",
    "problem_rows", "special_chars", "delimiter_scores", "file_characteristics", "structure_compare", "load_errors_all",
)

# Published single-process rates of the reference, rows (or bytes) per second.
RATES = {"file_row_count": 500_000, "file_quality": 50_000, "file_load": 100_000}


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeats: int = 3) -> float:
    for _ in range(2):
        fn()
    took = []
    for _ in range(repeats):
        started = time.perf_counter()
        fn()
        took.append(time.perf_counter() - started)
    return round(statistics.median(took), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()

    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet")
    rows = lineitem.count()
    text = lineitem.withColumn("l_shipdate", F.to_date("l_shipdate")).repartition(int(cpus))
    landing = scratch(spark, "bench-lineitem")
    sinks.write_delimited(text, landing, "\t")
    size = sum(r[0] for r in spark.read.format("binaryFile").load(landing).select("length").collect())

    def load_once():
        done = load.load_contract(spark, LINEITEM, landing, scratch(spark, "bench-load"))
        assert done.status == "success" and done.rows_loaded == rows, done

    files = {
        "file_row_count": lambda: run(structure.row_counts(read_lines(spark, landing))),
        "file_quality": lambda: run(load.file_quality(spark, LINEITEM, landing, "1995-01-01", "2001-12-31")),
        "file_null_counts": lambda: run(profile.null_counts(load.read_contract(spark, LINEITEM, landing))),
        "file_load": load_once,
        "file_gzip": lambda: sinks.compressed_copy(spark, landing, scratch(spark, "bench-gz")),
        "file_clean": lambda: run(structure.clean_lines(read_lines(spark, landing), "\t", len(COLUMNS))),
    }
    took = {name: timed(fn) for name, fn in files.items()}
    for name in HEADLINE:
        took[name] = timed(lambda n=name: run(registry.QUERIES[n](spark, folder)))
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline operators (median of 3 after two warm-ups)",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "lineitem_rows": rows,
                "lineitem_tsv_mb": round(size / 1e6, 1),
                "rows_per_second": {n: int(rows / took[n]) for n in RATES},
                "times_reference_rate": {n: round(rows / took[n] / rate, 1) for n, rate in RATES.items()},
                "gzip_mb_per_second": round(size / 1e6 / took["file_gzip"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
