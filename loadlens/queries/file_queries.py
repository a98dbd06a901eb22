"""Discovery, scan, load and rewrite queries over files made from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.contracts import Contract
from loadlens.functions.dates import parse_file_date
from loadlens.operators import profile, structure
from loadlens.plans import load as op
from loadlens.queries import query, table
from loadlens.queries.line_queries import rendered_lines
from loadlens.queries.profile_queries import TEXT_SQL, customer_text
from loadlens.session import scratch
from loadlens.sources import delimited, inventory, lines, sinks

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
ORDERS = Contract(
    "orders_{month}.tsv",
    "orders",
    ORDER_COLUMNS,
    "o_orderdate",
    ("o_custkey", "o_orderdate"),
    quote_char=None,
    types={
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderdate": "date",
    },
)
_DAY = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"


def order_rows(spark, folder):
    """Orders with the date as a day and the month as a folder key."""
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM").alias("period"),
    )


def month_landing(spark, folder, compression=None) -> str:
    """Orders written as tab-separated files, one folder per month."""
    target = scratch(spark, "orders-landing")
    sinks.write_delimited(order_rows(spark, folder), target, "\t", partition_by="period", compression=compression)
    return target


# A listing of period files, one per month or quarter of orders; length is the orders' bytes.
LISTING_SQL = """
listing AS (
  SELECT 'landing/orders_' || strftime(o_orderdate, '%Y-%m') || CASE WHEN month(min(o_orderdate)) % 2 = 0 THEN '.tsv.gz' ELSE '.tsv' END AS path,
         CAST(sum(length(o_orderpriority)) AS BIGINT) AS length FROM orders GROUP BY strftime(o_orderdate, '%Y-%m')
  UNION ALL
  SELECT 'landing/ship_' || strftime(date_trunc('month', l_shipdate), '%Y%m%d') || '-' || strftime(last_day(l_shipdate), '%Y%m%d') || '.csv',
         CAST(sum(length(l_returnflag)) AS BIGINT) FROM lineitem GROUP BY 1
  UNION ALL
  SELECT 'landing/' || event_type || '.dat', CAST(sum(length(props)) AS BIGINT) FROM events GROUP BY event_type
)"""


def listing(spark, folder):
    orders, lineitem, events = (table(spark, folder, n) for n in ("orders", "lineitem", "events"))
    month = F.date_format("o_orderdate", "yyyy-MM")
    suffix = F.when(F.month(F.min("o_orderdate")) % 2 == 0, ".tsv.gz").otherwise(".tsv")
    by_month = orders.groupBy(month.alias("m")).agg(suffix.alias("s"), F.sum(F.char_length("o_orderpriority")).alias("length"))
    a = by_month.select(F.concat(F.lit("landing/orders_"), "m", "s").alias("path"), "length")
    day = F.to_date("l_shipdate")
    span = F.concat(F.date_format(F.trunc(day, "month"), "yyyyMMdd"), F.lit("-"), F.date_format(F.last_day(day), "yyyyMMdd"))
    b = lineitem.groupBy(F.concat(F.lit("landing/ship_"), span, F.lit(".csv")).alias("path")).agg(
        F.sum(F.char_length("l_returnflag")).alias("length")
    )
    c = events.groupBy(F.concat(F.lit("landing/"), "event_type", F.lit(".dat")).alias("path")).agg(
        F.sum(F.char_length("props")).alias("length")
    )
    return a.unionByName(b).unionByName(c)


CONTRACTS = [
    Contract("orders_{month}.tsv", "orders"),
    Contract("ship_{date_range}.csv", "lineitem"),
    Contract("orders_1996-03.tsv", "orders_fixed"),
]


@query("inventory_sorted", f"WITH {LISTING_SQL} SELECT path, length FROM listing ORDER BY length DESC, path")
def inventory_sorted(spark, folder):
    files = listing(spark, folder).withColumn("modification_time", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return inventory.sort_inventory(files, "size", descending=True).select("path", "length")


@query("inventory_filtered", f"WITH {LISTING_SQL} SELECT path, length FROM listing WHERE lower(path) LIKE '%orders%' AND lower(path) LIKE '%.gz%'")
def inventory_filtered(spark, folder):
    return inventory.filter_inventory(listing(spark, folder), "ORDERS .gz").select("path", "length")


@query(
    "month_files",
    f"""WITH {LISTING_SQL} SELECT path, length, CASE WHEN path LIKE '%orders%' THEN 'orders' ELSE 'lineitem' END AS table_name,
      '1996-03-01' AS period_start, '1996-03-31' AS period_end FROM listing
    WHERE path LIKE 'landing/orders_1996-03.tsv%' OR path = 'landing/ship_19960301-19960331.csv'""",
)
def month_files(spark, folder):
    found = inventory.month_files(listing(spark, folder), CONTRACTS[:2], "1996-03")
    return found.drop("file_pattern").withColumns(
        {c: F.date_format(c, "yyyy-MM-dd") for c in ("period_start", "period_end")}
    )


@query(
    "contract_match",
    f"""WITH {LISTING_SQL}
    SELECT path, 'orders_{{month}}.tsv' AS file_pattern, 'orders' AS table_name, 'month' AS period_kind, regexp_extract(path, 'orders_(\\d{{4}}-\\d{{2}})', 1) AS period FROM listing
      WHERE regexp_matches(path, 'orders_\\d{{4}}-\\d{{2}}\\.tsv(\\.gz)?$')
    UNION ALL SELECT path, 'ship_{{date_range}}.csv', 'lineitem', 'range', regexp_extract(path, '(\\d{{8}}-\\d{{8}})', 1) FROM listing WHERE regexp_matches(path, 'ship_\\d{{8}}-\\d{{8}}\\.csv$')
    UNION ALL SELECT path, 'orders_1996-03.tsv', 'orders_fixed', NULL, NULL FROM listing WHERE path LIKE '%/orders_1996-03.tsv%'""",
)
def contract_match(spark, folder):
    return inventory.match_contracts(listing(spark, folder), CONTRACTS).select(
        "path", "file_pattern", "table_name", "period_kind", "period"
    )


@query(
    "contract_match_many",
    """SELECT 'landing/' || lower(replace(p_brand, '#', '')) || '_' || strftime(l_shipdate, '%Y-%m') || '.tsv.gz' AS path, count(*) AS length,
      CASE WHEN n <= 20 THEN 'brand' || n || '_{month}.tsv' END AS file_pattern, CASE WHEN n <= 20 THEN 'brand_' || n END AS table_name,
      CASE WHEN n <= 20 THEN strftime(l_shipdate, '%Y-%m') END AS period, n <= 20 AS matched
    FROM (SELECT p_brand, l_shipdate, CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS n FROM lineitem JOIN part ON l_partkey = p_partkey)
    GROUP BY p_brand, strftime(l_shipdate, '%Y-%m'), n""",
)
def contract_match_many(spark, folder):
    """Files of brands and months against two thousand contracts, most of which no file fits."""
    contracts = [Contract(f"brand{n}_{{month}}.tsv", f"brand_{n}") for n in range(1, 21)]
    contracts += [Contract(f"region{n}_{{date_range}}.csv", f"region_{n}") for n in range(1980)]
    lines = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.expr("l_partkey = p_partkey"))
    brand, month = F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), F.date_format("l_shipdate", "yyyy-MM")
    path = F.concat(F.lit("landing/"), brand, F.lit("_"), month, F.lit(".tsv.gz"))
    files = lines.groupBy(path.alias("path")).agg(F.count("*").alias("length"))
    return inventory.match_many_contracts(files, contracts, keep_unmatched=True).drop("period_kind")


@query(
    "contract_unmatched",
    f"WITH {LISTING_SQL} SELECT path, length FROM listing WHERE path LIKE '%.dat'",
)
def contract_unmatched(spark, folder):
    found = inventory.match_contracts(listing(spark, folder), CONTRACTS, keep_unmatched=True)
    return found.filter(~F.col("matched")).select("path", "length")


@query(
    "period_from_name",
    f"""WITH {LISTING_SQL} SELECT path,
      CASE WHEN path LIKE '%orders%' THEN regexp_extract(path, '(\\d{{4}}-\\d{{2}})', 1) || '-01'
        WHEN path LIKE '%ship%' THEN CAST(CAST(strptime(regexp_extract(path, '(\\d{{8}})-', 1), '%Y%m%d') AS DATE) AS VARCHAR) END AS period_start,
      CASE WHEN path LIKE '%orders%' THEN CAST(last_day(CAST(regexp_extract(path, '(\\d{{4}}-\\d{{2}})', 1) || '-01' AS DATE)) AS VARCHAR)
        WHEN path LIKE '%ship%' THEN CAST(CAST(strptime(regexp_extract(path, '-(\\d{{8}})', 1), '%Y%m%d') AS DATE) AS VARCHAR) END AS period_end
    FROM listing""",
)
def period_from_name(spark, folder):
    out = inventory.with_period(listing(spark, folder))
    return out.select("path", *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("period_start", "period_end")])


@query(
    "file_patterns",
    f"""WITH {LISTING_SQL}, named AS (SELECT string_split(path, '/')[-1] AS name, length FROM listing)
    SELECT CASE WHEN name LIKE 'orders%' THEN regexp_replace(name, '\\d{{4}}-\\d{{2}}', '{{month}}') ELSE regexp_replace(name, '\\d{{8}}-\\d{{8}}', '{{date_range}}') END AS file_pattern,
      CASE WHEN name LIKE 'orders%' THEN 'ORDERS' WHEN name LIKE 'ship%' THEN 'SHIP' ELSE upper(string_split(name, '.')[1]) END AS table_name,
      count(*) AS files, CAST(sum(length) AS BIGINT) AS bytes FROM named GROUP BY 1, 2""",
)
def file_patterns(spark, folder):
    name = inventory.base_name(F.col("path"))
    return listing(spark, folder).groupBy(
        profile.file_pattern(name).alias("file_pattern"), profile.table_name_of(name).alias("table_name")
    ).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


@query(
    "listing_summary",
    f"WITH {LISTING_SQL} SELECT count(*) AS file_count, CAST(sum(length) AS BIGINT) AS total_bytes FROM listing WHERE path LIKE '%orders%'",
)
def listing_summary(spark, folder):
    files = listing(spark, folder).withColumn("modification_time", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return inventory.listing_summary(files, ".*orders.*").select("file_count", "total_bytes")


_LINE_BYTES = f"""strlen(concat_ws(chr(9), CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
  CAST(o_totalprice AS VARCHAR), {_DAY}, o_orderpriority)) + 1"""


@query(
    "month_folders",
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS period, CAST(sum({_LINE_BYTES}) AS BIGINT) AS total_bytes FROM orders GROUP BY 1""",
)
def month_folders(spark, folder):
    files = inventory.file_inventory(spark, month_landing(spark, folder))
    return inventory.month_folders(files).select("period", "total_bytes")


@query(
    "row_counts_by_month",
    "SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS row_count FROM orders GROUP BY 1",
)
def row_counts_by_month(spark, folder):
    counts = structure.row_counts(lines.read_lines(spark, month_landing(spark, folder)))
    return counts.groupBy(inventory.period_of_path(F.col("file")).alias("period")).agg(
        F.sum("row_count").alias("row_count")
    )


@query(
    "csv_roundtrip",
    f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_DAY} AS o_orderdate, o_orderpriority FROM orders",
)
def csv_roundtrip(spark, folder):
    rows = op.read_contract(spark, ORDERS, month_landing(spark, folder))
    return delimited.apply_types(rows, ORDERS.types).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query(
    "gzip_roundtrip",
    f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_DAY} AS o_orderdate, o_orderpriority FROM orders",
)
def gzip_roundtrip(spark, folder):
    target = scratch(spark, "orders-gz")
    sinks.compressed_copy(spark, month_landing(spark, folder), target)
    rows = op.read_contract(spark, ORDERS, target)
    return delimited.apply_types(rows, ORDERS.types).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query(
    "null_token_scan",
    f"""WITH {TEXT_SQL} SELECT CAST(c_custkey AS BIGINT) AS c_custkey,
      CASE WHEN c_name IN ('', 'NULL', 'null', chr(92) || 'N') THEN NULL ELSE c_name END AS c_name,
      CASE WHEN c_acctbal = '' THEN NULL ELSE CAST(c_acctbal AS DOUBLE) END AS c_acctbal, c_comment FROM customer_text""",
)
def null_token_scan(spark, folder):
    target = scratch(spark, "customer-pipe")
    text = customer_text(spark, folder)
    sinks.write_delimited(text, target, "|")
    rows = delimited.scan_delimited(spark, target, text.columns, delimiter="|", quote=None)
    typed = delimited.apply_types(rows, {"c_custkey": "bigint", "c_acctbal": "double"})
    return typed.select("c_custkey", "c_name", "c_acctbal", "c_comment")


@query(
    "split_files",
    "SELECT count(*) AS row_count, 500 AS largest FROM orders",
)
def split_files(spark, folder):
    target = scratch(spark, "orders-chunks")
    sinks.split_files(spark, month_landing(spark, folder), target, lines_per_file=500)
    counts = structure.row_counts(lines.read_lines(spark, target))
    return counts.agg(
        F.sum("row_count").alias("row_count"), F.greatest(F.max("row_count"), F.lit(500)).cast("int").alias("largest")
    )


@query(
    "split_files_bytes",
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS row_count, CAST(sum({_LINE_BYTES}) AS BIGINT) AS bytes, true AS fitting
    FROM orders GROUP BY 1""",
)
def split_files_bytes(spark, folder):
    """Chunks of 20 000 bytes: all lines and bytes are there, and no chunk is larger than that before its last line."""
    target = scratch(spark, "orders-byte-chunks")
    sinks.split_files_by_bytes(spark, month_landing(spark, folder), target, 20_000)
    size = F.octet_length("value") + 1
    rows = spark.read.option("lineSep", "\n").text(target).withColumn("month", F.regexp_extract("source", r"(\d{4}-\d{2})", 1))
    chunks = rows.groupBy("month", "source", "chunk").agg(F.count("*").alias("n"), F.sum(size).alias("b"), F.max(size).alias("longest"))
    fitting = F.bool_and(F.col("b") - F.col("longest") < 20_000)
    return chunks.groupBy("month").agg(F.sum("n").alias("row_count"), F.sum("b").alias("bytes"), fitting.alias("fitting"))


@query(
    "compression_ratio",
    f"SELECT CAST(sum({_LINE_BYTES}) AS BIGINT) AS source_bytes, true AS smaller FROM orders",
)
def compression_ratio(spark, folder):
    source, target = month_landing(spark, folder), scratch(spark, "orders-gz")
    sinks.compressed_copy(spark, source, target)
    out = sinks.compression_ratio(spark, source, target)
    return out.select("source_bytes", (F.col("target_bytes") < F.col("source_bytes")).alias("smaller"))


@query(
    "sample_extract",
    """SELECT strftime(o_orderdate, '%Y-%m') AS period, least(count(*), 20) AS row_count FROM orders GROUP BY 1""",
)
def sample_extract(spark, folder):
    """First lines of each month, written and read back; months are made one file each."""
    by_month = scratch(spark, "orders-months")
    rows = order_rows(spark, folder)
    body = sinks.render_line(rows.drop("period"), "\t")
    months = rows.select("period", body.alias("value"), "o_orderkey").select(
        F.col("period").alias("file"),
        F.lit(None).cast("bigint").alias("file_size"),
        F.lit(0).cast("bigint").alias("block"),
        F.col("o_orderkey").alias("seq"),
        F.concat_ws("\t", "period", "value").alias("value"),
    )
    sinks.write_sample(months, by_month, 20)
    back = lines.read_lines(spark, by_month)
    return back.groupBy(F.substring_index("value", "\t", 1).alias("period")).agg(F.count("*").alias("row_count"))


@query(
    "clean_rewrite",
    """SELECT count(*) AS total_lines, count(*) FILTER (WHERE c_custkey % 50 NOT IN (7, 9)) AS clean_lines,
      count(*) FILTER (WHERE c_custkey % 50 IN (7, 9)) AS removed_lines FROM customer""",
)
def clean_rewrite(spark, folder):
    source = scratch(spark, "customer-rendered")
    rendered_lines(spark, folder).select("value").write.text(source)
    return structure.write_clean(lines.read_lines(spark, source), scratch(spark, "customer-clean"), "|", expected=4)


@query(
    "numbered_lines",
    """WITH ranked AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (ORDER BY o_orderkey, o_custkey, o_totalprice) AS line_no FROM orders)
    SELECT o_orderkey, line_no FROM ranked WHERE o_orderpriority = '1-URGENT'""",
)
def numbered_lines(spark, folder):
    """Line numbers within one logical file that is spread over several parts."""
    target = scratch(spark, "orders-sorted")
    ordered = table(spark, folder, "orders").orderBy("o_orderkey", "o_custkey", "o_totalprice")
    ordered.select(F.concat_ws("\t", F.col("o_orderkey").cast("string"), "o_orderpriority").alias("value")).write.text(target)
    # Parts are named in order, so the part's name serves as the block of one file.
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("bigint")
    one = lines.read_lines(spark, target).withColumn("block", part).withColumn("file", F.lit("orders"))
    urgent = one.filter(F.endswith("value", F.lit("1-URGENT")))
    return lines.number_lines(urgent, one).select(
        F.substring_index("value", "\t", 1).cast("bigint").alias("o_orderkey"), "line_no"
    )


@query(
    "file_quality",
    """WITH days AS (SELECT strftime(o_orderdate, '%Y-%m') AS period, CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY ALL)
    SELECT period, CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS unique_dates,
      CAST(day(last_day(min(d))) - count(*) AS BIGINT) AS missing_dates, CAST(0 AS BIGINT) AS invalid_dates, true AS schema_match
    FROM days GROUP BY period""",
)
def file_quality(spark, folder):
    """File checks over every month's files, which are merged per month first."""
    landing = month_landing(spark, folder)
    per_file = op.file_quality(spark, ORDERS, landing, "1995-01-01", "2001-12-31")
    # A month may be several part files: join their days before judging the month.
    cells = op.date_cells(spark, ORDERS, landing)
    day = parse_file_date(F.col("cell"))
    period = inventory.period_of_path(F.col("file"))
    days = cells.groupBy(period.alias("period"), day.alias("d")).agg(F.count("*").alias("n"))
    months = days.groupBy("period").agg(
        F.sum("n").alias("total_rows"),
        F.count("d").alias("unique_dates"),
        F.dayofmonth(F.last_day(F.min("d"))).alias("month_days"),
        F.coalesce(F.sum(F.when(F.col("d").isNull(), F.col("n"))), F.lit(0)).alias("invalid_dates"),
    )
    widths = per_file.groupBy(period.alias("period")).agg(F.bool_and("schema_match").alias("schema_match"))
    return months.join(widths, "period").select(
        "period", "total_rows", "unique_dates",
        (F.col("month_days") - F.col("unique_dates")).alias("missing_dates"), "invalid_dates", "schema_match",
    )


@query(
    "invalid_file_dates",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN 'bad' ELSE '' END AS value FROM orders WHERE o_orderkey % 3 IN (1, 2)",
)
def invalid_file_dates(spark, folder):
    """Every unusable date cell of files in which two rows of three have one."""
    turn = F.col("o_orderkey") % 3
    cell = F.when(turn == 1, "bad").when(turn == 2, "").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    target = scratch(spark, "orders-bad-dates")
    contract = Contract("x.tsv", "orders", ("o_orderkey", "day"), "day", quote_char=None)
    rows = table(spark, folder, "orders").select(F.concat_ws("\t", F.col("o_orderkey").cast("string"), cell).alias("value"))
    rows.write.text(target)
    found = op.invalid_file_dates(spark, contract, target, limit=None)
    raw = lines.read_lines(spark, target)
    numbered = lines.number_lines(raw, raw).select(
        "file", "line_no", F.substring_index("value", "\t", 1).cast("bigint").alias("o_orderkey")
    )
    return found.join(numbered, ["file", "line_no"]).select("o_orderkey", "value")


@query(
    "load_months",
    """SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS rows_loaded, (SELECT count(*) FROM orders) AS reported FROM orders GROUP BY 1""",
)
def load_months(spark, folder):
    result, counts = op.load_months(spark, ORDERS, month_landing(spark, folder), scratch(spark, "orders-table"))
    if result.status != "success":
        raise RuntimeError(result.error)
    return counts.withColumn("reported", F.lit(result.rows_loaded).cast("bigint"))


@query(
    "load_selected_months",
    """SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS rows_loaded FROM orders
    WHERE strftime(o_orderdate, '%Y-%m') IN ('1996-03', '1997-01') GROUP BY 1""",
)
def load_selected_months(spark, folder):
    result, counts = op.load_months(
        spark, ORDERS, month_landing(spark, folder), scratch(spark, "orders-table"), months=["1996-03", "1997-01"]
    )
    if result.status != "success":
        raise RuntimeError(result.error)
    return counts


@query(
    "load_quarantine",
    """SELECT 'loaded' AS outcome, count(*) AS rows FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT 'rejected', count(*) FROM orders WHERE o_orderstatus = 'P'""",
)
def load_quarantine(spark, folder):
    """Rows whose price is not a number go to quarantine, the rest is loaded."""
    landing, target, rejects = (scratch(spark, f"orders-{n}") for n in ("dirty", "good", "rejects"))
    price = F.when(F.col("o_orderstatus") == "P", F.lit("12,50")).otherwise(F.col("o_totalprice").cast("string"))
    dirty = order_rows(spark, folder).drop("period").withColumn("o_totalprice", price)
    sinks.write_delimited(dirty, landing, "\t")
    result = op.load_contract(spark, ORDERS, landing, target, on_error="quarantine", quarantine=rejects)
    if result.status != "success":
        raise RuntimeError(result.error)
    good = spark.read.parquet(target).agg(F.count("*").alias("rows")).select(F.lit("loaded").alias("outcome"), "rows")
    bad = spark.read.parquet(rejects).agg(F.count("*").alias("rows")).select(F.lit("rejected").alias("outcome"), "rows")
    return good.unionByName(bad)


@query("load_abort", "SELECT 'failed' AS status, CAST(0 AS BIGINT) AS rows_loaded, count(*) > 0 AS has_bad FROM orders WHERE o_orderstatus = 'P'")
def load_abort(spark, folder):
    """One bad value fails a strict load and nothing is loaded."""
    landing, target = scratch(spark, "orders-dirty"), scratch(spark, "orders-strict")
    price = F.when(F.col("o_orderstatus") == "P", F.lit("12,50")).otherwise(F.col("o_totalprice").cast("string"))
    dirty = order_rows(spark, folder).drop("period").withColumn("o_totalprice", price)
    sinks.write_delimited(dirty, landing, "\t")
    result = op.load_contract(spark, ORDERS, landing, target)
    bad = dirty.agg((F.count(F.when(F.col("o_totalprice") == "12,50", 1)) > 0).alias("has_bad"))
    return bad.select(
        F.lit(result.status).alias("status"), F.lit(result.rows_loaded).cast("bigint").alias("rows_loaded"), "has_bad"
    )


@query(
    "load_files",
    """SELECT status, count(*) AS loads, CAST(sum(n) AS BIGINT) AS rows_loaded FROM
    (SELECT 'success' AS status, count(*) AS n FROM orders GROUP BY o_orderpriority) GROUP BY status""",
)
def load_files(spark, folder):
    """One folder per priority, each loaded as its own job."""
    landing, target = scratch(spark, "orders-priorities"), scratch(spark, "orders-table")
    rows = order_rows(spark, folder).drop("period").withColumn("p", F.substring("o_orderpriority", 1, 1))
    sinks.write_delimited(rows, landing, "\t", partition_by="p")
    paths = sorted({r["f"] for r in inventory.file_inventory(spark, landing).select(
        F.regexp_replace("path", r"/[^/]*$", "").alias("f")).distinct().collect()})
    results = op.load_files(spark, ORDERS, paths, target, skip_qc=True)
    return op.load_totals(results).select("status", "loads", "rows_loaded")


@query(
    "contract_proposals",
    """SELECT 'CSV' AS file_format, ',' AS delimiter, 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS columns
    FROM customer HAVING count(*) > 0""",
)
def contract_proposals(spark, folder):
    """Contract proposals from files written with a header line."""
    target = scratch(spark, "customer-headed")
    table(spark, folder, "customer").write.option("header", "true").option("sep", ",").csv(target)
    out = profile.propose_contracts(lines.read_lines(spark, target), date_column="recordDate")
    return out.select("file_format", "delimiter", F.concat_ws(",", "expected_columns").alias("columns")).distinct()


NOTES = Contract(
    "notes.csv", "notes", ("c_custkey", "c_note", "c_acctbal"), None, ("c_custkey",), delimiter=",", quote_char='"',
    types={"c_custkey": "bigint", "c_acctbal": "double"}, multiline=True,
)


def notes_landing(spark, folder) -> str:
    """Customers with a quoted note of one to four lines that holds separators and quotes."""
    target = scratch(spark, "customer-notes")
    quote = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    note = F.concat(F.col("c_name"), F.repeat(F.lit('\n"so", '), F.pmod("c_custkey", F.lit(4)).cast("int")))
    rows = table(spark, folder, "customer").select(F.concat_ws(",", F.col("c_custkey").cast("string"), quote(note), F.col("c_acctbal").cast("string")).alias("value"))
    rows.write.text(target)
    return target


@query(
    "quoted_records",
    """SELECT c_custkey, c_name || repeat(chr(10) || '"so", ', CAST(c_custkey % 4 AS INT)) AS c_note, c_acctbal FROM customer""",
)
def quoted_records_query(spark, folder):
    """Records over several lines, read back as typed rows."""
    rows = op.read_contract(spark, NOTES, notes_landing(spark, folder))
    return delimited.apply_types(rows, NOTES.types)


@query(
    "quoted_record_widths",
    """SELECT CAST(c_custkey % 4 + 1 AS BIGINT) AS lines, 3 AS columns, count(*) AS records FROM customer GROUP BY ALL""",
)
def quoted_record_widths(spark, folder):
    """Records by the lines they span and their width."""
    records = delimited.read_records(spark, notes_landing(spark, folder), '"')
    breaks = F.char_length("value") - F.char_length(F.replace("value", F.lit("\n"), F.lit("")))
    told = records.select((breaks + 1).cast("bigint").alias("lines"), structure.width(",", '"').cast("int").alias("columns"))
    return told.groupBy("lines", "columns").agg(F.count("*").alias("records"))
