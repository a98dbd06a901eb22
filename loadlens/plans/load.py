"""Loading: check files, cast, append, keep an audit trail."""

from __future__ import annotations

import datetime as dt
import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from loadlens.contracts import Contract
from loadlens.functions import dates
from loadlens.functions.text import field_at, field_count, strip
from loadlens.operators.history import HISTORY_SCHEMA
from loadlens.operators.series import daily_series, days, first_of_each
from loadlens.session import literal_frame
from loadlens.sources import delimited, inventory
from loadlens.sources.delimited import RAGGED, SOURCE
from loadlens.sources.lines import number_lines, read_lines

REJECTED = "_rejected_columns"


@dataclass
class LoadResult:
    """What one load did."""

    table_name: str
    source: str
    status: str
    rows_loaded: int = 0
    rows_rejected: int = 0
    seconds: float = 0.0
    error: str | None = None


def read_contract(
    spark: SparkSession, contract: Contract, paths, ragged: bool = False, source: bool = False, flag_open: bool = False
) -> DataFrame:
    """A contract's files as text columns with null tokens applied."""
    return delimited.scan_delimited(
        spark,
        paths,
        contract.expected_columns,
        delimiter=contract.separator,
        quote=contract.quote_char,
        header=contract.header,
        flag_ragged=ragged,
        with_source=source,
        multiline=contract.multiline,
        flag_open=flag_open,
    )


def judge_rows(rows: DataFrame, contract: Contract, reject_ragged: bool = False) -> DataFrame:
    """Add the columns whose text does not fit their type; empty means loadable."""
    bad = delimited.bad_cells(rows, contract.types)
    if reject_ragged and RAGGED in rows.columns:
        bad = F.concat(bad, F.array_compact(F.array(F.when(F.col(RAGGED).isNotNull(), F.lit("row width")))))
    return rows.withColumn(REJECTED, bad)


def load_contract(
    spark: SparkSession,
    contract: Contract,
    paths,
    target: str,
    on_error: str = "abort",
    partition_by: str | None = None,
    quarantine: str | None = None,
    spread: bool = False,
    reject_ragged: bool = False,
) -> LoadResult:
    """Append files to a Parquet table.

    ``abort`` casts strictly, so one bad value fails the whole load and nothing
    becomes visible. ``quarantine`` loads the rows that cast and, only if there
    are others, writes those to their own folder with a second read. Rows are
    counted while they are written. Rows of the wrong width are padded or cut,
    or with ``reject_ragged`` quarantined too. ``spread`` evens out the written files when
    the input is a few large archives, each of which is one task.
    """
    started = time.monotonic()
    label = paths if isinstance(paths, str) else ",".join(paths)
    try:
        rows = read_contract(spark, contract, paths, ragged=on_error == "quarantine", source=bool(partition_by))
        refused, written = Observation(), Observation()
        if on_error == "quarantine":
            judged = judge_rows(rows, contract, reject_ragged)
            bad = F.size(REJECTED) > 0
            judged = judged.observe(refused, F.count_if(bad).alias("n"))
            out = delimited.apply_types(judged.filter(~bad).drop(REJECTED, RAGGED), contract.types, strict=False)
        else:
            out = delimited.apply_types(rows, contract.types, strict=True)
        if partition_by:
            out = out.withColumn(partition_by, inventory.period_of_path(F.col(SOURCE))).drop(SOURCE)
            # Even out file sizes: a month with most rows is cut up, small months share tasks.
            out = out.hint("rebalance", partition_by)
        elif spread:
            out = out.hint("rebalance")
        # Counted in the writing stage: its tasks count once even if executors are lost before it.
        writer = out.observe(written, F.count(F.lit(1)).alias("n")).write.mode("append")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(target)
        loaded = written.get["n"]
        rejected = refused.get["n"] if on_error == "quarantine" else 0
        if rejected and quarantine:
            again = read_contract(spark, contract, paths, ragged=True, source=True)
            kept_back = Observation()
            judge_rows(again, contract, reject_ragged).filter(F.size(REJECTED) > 0).observe(
                kept_back, F.count(F.lit(1)).alias("n")
            ).write.mode("append").parquet(quarantine)
            rejected = kept_back.get["n"]
        return LoadResult(contract.table_name, label, "success", loaded, rejected, time.monotonic() - started)
    except Exception as error:  # noqa: BLE001 - reported per load
        text = str(error).splitlines()[0]
        return LoadResult(contract.table_name, label, "failed", 0, 0, time.monotonic() - started, text)


def date_cells(spark: SparkSession, contract: Contract, paths) -> DataFrame:
    """Lines of a contract's files, or records if these may span lines, with their date cell.

    The cell is null where the row is too short to have one. Only the date
    cell of a line is kept.
    """
    index = contract.expected_columns.index(contract.date_column)
    spanning = contract.multiline and contract.quote_char
    lines = delimited.read_records(spark, paths, contract.quote_char) if spanning else read_lines(spark, paths)
    line = F.rtrim(F.col("value"), F.lit("\r"))
    cell = F.when(F.octet_length(line) > 0, strip(field_at(line, contract.separator, index, contract.quote_char)))
    return lines.withColumn("cell", cell)


def file_quality(
    spark: SparkSession, contract: Contract, paths, start=None, end=None, listed: int | None = None
) -> DataFrame:
    """Schema width and date completeness of every file, one row per file.

    The expected days come from the arguments, else from the file's name. One
    scan reduces each file to rows per day; what follows has at most one row
    per file and day. The list of missing days is whole unless ``listed`` cuts
    it, which ``truncated`` then tells. A header is the first line or record of
    a file, whatever it says.
    """
    cells = date_cells(spark, contract, paths)
    columns = field_count(F.col("value"), contract.separator, contract.quote_char)
    at_start = F.when(F.col("block") == 0, F.col("seq"))
    day = dates.parse_file_date(F.col("cell"))
    per_day = (
        cells.select("file", day.alias("d"), F.col("cell").isNotNull().alias("has_cell"), columns.alias("w"), at_start.alias("s"))
        .groupBy("file", "d", (F.col("has_cell") & F.col("d").isNull()).alias("bad"))
        .agg(F.count("*").alias("n"), F.min_by("w", "s").alias("w"), F.min("s").alias("s"))
    )
    if contract.header:
        is_first = F.col("s") == F.min("s").over(Window.partitionBy("file"))
        per_day = per_day.withColumn("n", F.col("n") - F.coalesce(is_first.cast("int"), F.lit(0)))
    if start is not None and end is not None:
        lo, hi = F.lit(dates.to_day(start)), F.lit(dates.to_day(end))
    else:
        lo, hi = inventory.period_from_name(F.col("file"))
    inside = F.col("d").between(F.col("lo"), F.col("hi")) & (F.col("n") > 0)
    nothing = F.array().cast("array<date>")
    missing = F.when(F.col("lo") <= F.col("hi"), F.array_except(F.sequence("lo", "hi"), "present"))
    dated = (F.col("expected_dates") > 0) & (F.col("missing_dates") == 0) & (F.col("invalid_dates") == 0)
    return (
        per_day.withColumn("lo", lo)
        .withColumn("hi", hi)
        .groupBy("file")
        .agg(
            F.sum("n").alias("total_rows"),
            F.min_by("w", "s").alias("actual_columns"),
            F.count(F.when(inside, 1)).alias("unique_dates"),
            F.coalesce(F.sum(F.when(F.col("bad"), F.col("n"))), F.lit(0)).alias("invalid_dates"),
            F.first("lo").alias("lo"),
            F.first("hi").alias("hi"),
            F.collect_list(F.when(inside, F.col("d"))).alias("present"),
        )
        .withColumn("expected_dates", dates.expected_days(F.col("lo"), F.col("hi")))
        .withColumn("missing_dates", F.col("expected_dates") - F.col("unique_dates"))
        .withColumn("missing_date_list", F.array_sort(F.coalesce(missing, nothing)))
        .withColumn("truncated", F.lit(False) if listed is None else F.size("missing_date_list") > listed)
        .withColumn("missing_date_list", F.col("missing_date_list") if listed is None else F.slice("missing_date_list", 1, listed))
        .withColumn("schema_match", F.col("actual_columns") == len(contract.expected_columns))
        .withColumn("dates_passed", dated)
        .withColumn("passed", F.coalesce(F.col("schema_match") & F.col("dates_passed"), F.lit(False)))
        .drop("lo", "hi", "present")
    )


def invalid_file_dates(spark: SparkSession, contract: Contract, paths, limit: int | None = None) -> DataFrame:
    """The cells that hold no valid date, with their row numbers; a header line has none.

    ``limit`` asks for the first ones of each file only; ``truncated`` then
    tells whether there are more.
    """
    cells = date_cells(spark, contract, paths)
    bad = cells.filter(F.col("cell").isNotNull() & dates.parse_file_date(F.col("cell")).isNull())
    numbered = number_lines(bad, cells).select("file", "line_no", F.col("cell").alias("value"))
    if contract.header:
        numbered = numbered.filter("line_no > 1")
    return numbered if limit is None else first_of_each(numbered, "file", ["line_no"], limit)


@dataclass
class Verdict:
    """What the gate found out about one of the given paths."""

    passed: bool = True
    rows: int = 0
    refused: int = 0
    open_quotes: int = 0
    example: str | None = None
    error: str | None = None


def file_gate(
    spark: SparkSession, contract: Contract, paths: list[str], quality: bool = True, reject_ragged: bool = False
) -> dict[str, Verdict]:
    """Quality and castability of any number of files or folders, in one query.

    Rows are judged where they are read and counted per file before anything is
    shuffled; what comes back has one row per given path. A file that cannot be
    read fails the query, which is then asked again for either half of the
    paths, so further queries are spent on such files only.
    """
    known = _existing(spark, paths)
    verdicts = {p: Verdict(passed=False, error=f"path does not exist: {p}") for p in paths if p not in known}
    verdicts |= _judged(spark, contract, [p for p in paths if p in known], known, quality, reject_ragged)
    return verdicts


def _existing(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The paths that exist, with their names as the readers give them."""
    java, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsparkSession.sessionState().newHadoopConf()

    def named(path: str) -> str | None:
        at = java(path)
        system = at.getFileSystem(conf)
        if not system.exists(at):
            return None
        # Local files are named with three slashes and read with one.
        return re.sub("^file:/+", "file:/", at.makeQualified(system.getUri(), system.getWorkingDirectory()).toUri().toString())

    with ThreadPoolExecutor(max_workers=8) as pool:
        return {p: n for p, n in zip(paths, pool.map(named, paths), strict=True) if n is not None}


def _judged(spark, contract: Contract, paths: list[str], names: dict[str, str], quality: bool, reject_ragged: bool) -> dict[str, Verdict]:
    if not paths:
        return {}
    try:
        return _verdicts(spark, contract, paths, names, quality, reject_ragged)
    except (CapturedException, Py4JJavaError) as error:
        if len(paths) == 1:
            return {paths[0]: Verdict(passed=False, error=str(error).splitlines()[0])}
        half = len(paths) // 2
        ask = lambda some: _judged(spark, contract, some, names, quality, reject_ragged)
        return {**ask(paths[:half]), **ask(paths[half:])}


def _verdicts(spark, contract: Contract, paths: list[str], names: dict[str, str], quality: bool, reject_ragged: bool) -> dict[str, Verdict]:
    rows = read_contract(spark, contract, paths, ragged=True, source=True, flag_open=True)
    judged = judge_rows(rows, contract, reject_ragged).withColumn("_bad", F.size(REJECTED) > 0)
    first_bad = F.min(F.when(F.col("_bad"), F.array_join(REJECTED, ", ")))
    per_file = judged.groupBy(F.col(SOURCE).alias("file")).agg(
        F.count("*").alias("n"), F.count_if("_bad").alias("n_bad"), F.count_if(delimited.OPEN_QUOTE).alias("n_open"), first_bad.alias("example")
    )
    if quality:
        passed = file_quality(spark, contract, paths).select("file", "passed")
        per_file = per_file.join(passed, "file", "full")
    else:
        per_file = per_file.withColumn("passed", F.lit(True))
    # A file belongs to the path given for it or for one of its folders.
    parts = F.split("file", "/")
    above = F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/")))
    given = spark.createDataFrame([(p, names[p]) for p in paths], "path string, name string")
    found = per_file.withColumn("name", above).join(given, "name").groupBy("path").agg(
        F.bool_and("passed").alias("passed"), F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad"), F.sum("n_open").alias("n_open"),
        F.min("example").alias("example"),
    )
    # A path without any line has not shown its width, so it fails the quality check only.
    verdicts = {p: Verdict(passed=not quality) for p in paths}
    for r in found.collect():
        verdicts[r["path"]] = Verdict(bool(r["passed"]), r["n"] or 0, r["n_bad"] or 0, r["n_open"] or 0, r["example"])
    return verdicts


def load_files(
    spark: SparkSession,
    contract: Contract,
    paths: list[str],
    target: str,
    skip_qc: bool = False,
    validate_only: bool = False,
    validate_after: bool = False,
    on_error: str = "abort",
    reject_ragged: bool = False,
    **options,
) -> DataFrame:
    """Check and load any number of files, each on its own merits; one result row per given path.

    Two queries do the work however many files there are: ``file_gate`` judges
    all of them, and one load takes those that passed. A file that fails stops
    no other: under ``abort`` one bad value keeps the whole file out, under
    ``quarantine`` its bad rows. ``validate_after`` judges the loaded table
    instead of the files. The seconds of the load are dealt out by rows.
    """
    checks = not skip_qc and not validate_after
    ragged = reject_ragged and on_error == "quarantine"
    verdicts = file_gate(spark, contract, paths, checks, ragged)
    results, good = [], []
    for path in paths:
        v = verdicts[path]
        result = LoadResult(contract.table_name, path, "failed", error=v.error)
        if v.error is None and not v.passed:
            result.status = "qc_failed"
        elif v.error is None and validate_only:
            result.status = "qc_passed"
        elif v.open_quotes:
            result.error = f"a quote is not closed on its line: {v.open_quotes} lines"
        elif on_error == "abort" and v.refused:
            result.error = f"{v.refused} rows do not fit their types: {v.example}"
        elif v.error is None:
            result.status = "success"
            result.rows_rejected = v.refused if on_error == "quarantine" else 0
            result.rows_loaded = v.rows - result.rows_rejected
            good.append(result)
        results.append(result)
    if good:
        whole = load_contract(
            spark, contract, [r.source for r in good], target, on_error=on_error, reject_ragged=reject_ragged, **options
        )
        expected = sum(r.rows_loaded for r in good)
        for r in good:
            r.seconds = whole.seconds * (r.rows_loaded / expected if expected else 1 / len(good))
            if whole.status != "success":
                r.status, r.error, r.rows_loaded, r.rows_rejected = whole.status, whole.error, 0, 0
        if whole.status == "success" and whole.rows_loaded != expected:
            raise RuntimeError(f"{whole.rows_loaded} rows were loaded where {expected} had been judged: files changed meanwhile")
    loaded = [r for r in results if r.status == "success"]
    if validate_after and loaded:
        complete = complete_periods(spark, contract, [r.source for r in loaded], target)
        for result in loaded:
            result.status = "success" if result.source in complete else "loaded_with_issues"
    return results_frame(spark, results)


def complete_periods(spark: SparkSession, contract: Contract, paths: list[str], target: str) -> set[str]:
    """Those of the paths whose period, as in their name, the table has rows for on every day.

    One scan of the table's date column answers for all paths; what is joined
    has one row per path and day.
    """
    named = spark.createDataFrame([(p,) for p in paths], "path string")
    lo, hi = inventory.period_from_name(F.col("path"))
    wanted = named.select("path", lo.alias("lo"), hi.alias("hi")).filter("lo <= hi")
    wanted = wanted.select("path", F.explode(F.sequence("lo", "hi")).alias("d"))
    held = days(daily_series(spark.read.parquet(target), contract.date_column)).select("d", "n")
    judged = wanted.join(held, "d", "left").groupBy("path").agg(F.bool_and(F.col("n").isNotNull()).alias("whole"))
    return {r["path"] for r in judged.filter("whole").collect()}


def results_frame(spark: SparkSession, results: list[LoadResult]) -> DataFrame:
    return spark.createDataFrame(
        [
            (r.table_name, r.source, r.status, r.rows_loaded, r.rows_rejected, r.seconds, r.error)
            for r in results
        ],
        "table_name string, source string, status string, rows_loaded bigint, rows_rejected bigint, "
        "seconds double, error string",
    )


def load_totals(results: DataFrame) -> DataFrame:
    """Loads and rows per table and status."""
    return results.groupBy("table_name", "status").agg(
        F.count("*").alias("loads"), F.sum("rows_loaded").alias("rows_loaded"), F.sum("seconds").alias("seconds")
    )


def month_paths(spark: SparkSession, folder: str, months: list[str] | None = None) -> list[tuple[str, str]]:
    """Month folders under a folder as ``(month, path)``, all of them or the listed ones."""
    files = inventory.file_inventory(spark, folder)
    found = files.select(
        inventory.period_of_path(F.col("path")).alias("period"),
        F.regexp_replace("path", r"/[^/]*$", "").alias("folder"),
    ).filter(F.col("period").isNotNull())
    if months is not None:
        found = found.filter(F.col("period").isin(*months))
    pairs = sorted((r["period"], r["folder"]) for r in found.distinct().collect())
    if not pairs:
        raise ValueError(f"no month folders under {folder}")
    return pairs


def load_each_month(
    spark: SparkSession,
    contract: Contract,
    folder: str,
    target: str,
    months: list[str] | None = None,
    partition_by: str = "period",
    **options,
) -> DataFrame:
    """Load month folders one after another, one result row each; a bad month does not stop the others."""
    results = [
        load_contract(spark, contract, path, target, partition_by=partition_by, **options)
        for _, path in month_paths(spark, folder, months)
    ]
    return results_frame(spark, results)


def load_months(
    spark: SparkSession,
    contract: Contract,
    folder: str,
    target: str,
    months: list[str] | None = None,
    partition_by: str = "period",
    **options,
) -> tuple[LoadResult, DataFrame]:
    """Load all month folders, or the listed ones, as one partitioned job.

    Returns the load's result and the table's rows per month after it.
    """
    paths = [path for _, path in month_paths(spark, folder, months)]
    result = load_contract(spark, contract, paths, target, partition_by=partition_by, **options)
    if result.status != "success":
        return result, literal_frame(spark, [], "period string, rows_loaded bigint")
    table = spark.read.parquet(target)
    return result, table.groupBy(F.col(partition_by).cast("string").alias("period")).agg(
        F.count("*").alias("rows_loaded")
    )


def audit_rows(spark: SparkSession, results: list[LoadResult], at: dt.datetime | None = None) -> DataFrame:
    """Load results in the shape of the load-history table."""
    end = at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [
        (
            uuid.uuid4().hex,
            f"COPY INTO {r.table_name} FROM {r.source}",
            "COPY",
            None if r.status == "success" else "LOAD_FAILED",
            r.error,
            end - dt.timedelta(seconds=r.seconds),
            end,
            r.seconds,
            r.seconds,
            0.0,
            0.0,
            r.rows_loaded,
            0.0,
            r.table_name,
        )
        for r in results
    ]
    return spark.createDataFrame(rows, HISTORY_SCHEMA)


def append_audit(spark: SparkSession, results: list[LoadResult], path: str) -> None:
    audit_rows(spark, results).coalesce(1).write.mode("append").parquet(path)


