"""Load-history analysis over a plain audit table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Error codes that always count as load failures.
FAILURE_CODES = ("000603", "300005")
SLOW_SECONDS = 300

HISTORY_SCHEMA = (
    "query_id string, query_text string, query_type string, error_code string, error_message string, "
    "start_time timestamp, end_time timestamp, elapsed_seconds double, exec_seconds double, "
    "queue_seconds double, compile_seconds double, rows_produced bigint, mb_scanned double, table_name string"
)

# What each class of error suggests.
ADVICE = {
    "incident": "retry after a few minutes; report the incident number if it persists",
    "timeout": "use more executors or load smaller batches",
    "memory": "raise executor memory or split the input; check for malformed rows",
}


def since(history: DataFrame, hours: float, now: Column | None = None) -> Column:
    """Rows that started in the last hours before ``now``."""
    at = F.current_timestamp() if now is None else now
    seconds = F.make_interval(secs=F.lit(hours * 3600.0))
    return (F.col("start_time") >= at - seconds) & (F.col("start_time") <= at)


def load_errors(history: DataFrame, hours: float = 24, now: Column | None = None, limit: int | None = None) -> DataFrame:
    """Failed loads in the window; with a limit the newest."""
    failed = (
        F.col("error_code").isin(*FAILURE_CODES)
        | F.contains("error_message", F.lit("incident"))
        | ((F.col("query_type") == "COPY") & F.col("error_code").isNotNull())
    )
    found = history.filter(since(history, hours, now) & failed)
    if limit is None:
        return found
    return found.orderBy(F.col("start_time").desc(), "query_id").limit(limit)


def error_classes(errors: DataFrame) -> DataFrame:
    """Errors per class with the advice that goes with it."""
    message = F.lower("error_message")
    classes = F.array_compact(
        F.array(*[F.when(F.contains(message, F.lit(word)), F.lit(word)) for word in ADVICE])
    )
    advice = F.create_map(*[F.lit(x) for pair in ADVICE.items() for x in pair])
    return (
        errors.select(F.explode(classes).alias("error_class"))
        .groupBy("error_class")
        .agg(F.count("*").alias("errors"))
        .withColumn("advice", F.element_at(advice, F.col("error_class")))
    )


def load_performance(
    history: DataFrame, hours: float = 24, now: Column | None = None, limit: int | None = None
) -> DataFrame:
    """Timing, rows and volume of recent loads, slow ones marked; with a limit the newest."""
    loads = (
        history.filter(since(history, hours, now) & (F.col("query_type") == "COPY"))
        .filter(F.contains("query_text", F.lit("COPY INTO")))
        .select(
            "query_id",
            "start_time",
            "elapsed_seconds",
            "exec_seconds",
            "queue_seconds",
            "compile_seconds",
            "rows_produced",
            "mb_scanned",
            (F.col("elapsed_seconds") > SLOW_SECONDS).alias("slow"),
        )
    )
    if limit is None:
        return loads
    return loads.orderBy(F.col("start_time").desc(), "query_id").limit(limit)


def load_throughput(history: DataFrame) -> DataFrame:
    """Observed rows per second and load times per table."""
    return (
        history.filter((F.col("query_type") == "COPY") & F.col("error_code").isNull())
        .groupBy("table_name")
        .agg(
            F.count("*").alias("loads"),
            F.sum("rows_produced").alias("rows_loaded"),
            F.sum("elapsed_seconds").alias("seconds"),
            F.avg("elapsed_seconds").alias("avg_seconds"),
            F.count(F.when(F.col("elapsed_seconds") > SLOW_SECONDS, 1)).alias("slow_loads"),
        )
        .withColumn("rows_per_second", F.try_divide(F.col("rows_loaded"), F.col("seconds")))
    )


def estimate_load_seconds(throughput: DataFrame, files: DataFrame) -> DataFrame:
    """Expected load time of files ``(table_name, row_count)`` from past throughput."""
    return files.join(throughput.select("table_name", "rows_per_second"), "table_name", "left").select(
        *files.columns, F.try_divide(F.col("row_count"), F.col("rows_per_second")).alias("estimated_seconds")
    )
