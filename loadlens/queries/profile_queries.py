"""Column-profile and schema queries over tables seen as delimited text."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.contracts import Contract, contracts_frame
from loadlens.functions.text import SAMPLER_NULLS, null_if
from loadlens.operators import profile as op
from loadlens.queries import query, table
from loadlens.queries.line_queries import RENDERED, RENDERED_LINES_SQL, rendered_lines
from loadlens.queries.series_queries import SPELLED_SQL, spelled_orders

# Customers as text, with every null token planted.
TEXT_SQL = """
customer_text AS (
  SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
    CASE WHEN c_custkey % 10 = 3 THEN '' WHEN c_custkey % 10 = 4 THEN 'NULL' WHEN c_custkey % 10 = 5 THEN 'null'
         WHEN c_custkey % 10 = 6 THEN chr(92) || 'N' WHEN c_custkey % 10 = 7 THEN 'na' WHEN c_custkey % 10 = 8 THEN 'None'
         WHEN c_custkey % 10 = 9 THEN NULL ELSE c_name END AS c_name,
    CAST(c_nationkey AS VARCHAR) AS c_nationkey,
    CASE WHEN c_acctbal < 0 THEN '' ELSE CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS VARCHAR) END AS c_acctbal,
    c_mktsegment, CAST(NULL AS VARCHAR) AS c_comment
  FROM customer
)"""
TEXT_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "c_comment")


def customer_text(spark, folder):
    turn = F.col("c_custkey") % 10
    name = F.col("c_name")
    for value, token in ((3, ""), (4, "NULL"), (5, "null"), (6, "\\N"), (7, "na"), (8, "None")):
        name = F.when(turn == value, token).otherwise(name)
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.when(turn != 9, name).alias("c_name"),
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_acctbal").cast("decimal(12,2)").cast("string")).alias("c_acctbal"),
        "c_mktsegment",
        F.lit(None).cast("string").alias("c_comment"),
    )


def _long(source: str, columns) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {source}" for c in columns)


CELLS_SQL = f"{TEXT_SQL}, cells AS ({_long('customer_text', TEXT_COLUMNS)})"
_IS_NULL = "(value IS NULL OR value IN ('', 'NULL', 'null', chr(92) || 'N'))"


@query(
    "null_counts",
    f"""WITH {CELLS_SQL} SELECT column_name, count(*) FILTER (WHERE {_IS_NULL}) AS null_count, count(*) AS row_count
    FROM cells GROUP BY column_name""",
)
def null_counts(spark, folder):
    return op.null_counts(customer_text(spark, folder))


@query(
    "null_counts_sampler",
    f"""WITH {CELLS_SQL} SELECT column_name, count(*) FILTER (WHERE value IS NULL OR upper(value) IN ('', 'NULL', 'NONE', 'NA')) AS null_count,
      count(*) AS row_count FROM cells GROUP BY column_name""",
)
def null_counts_sampler(spark, folder):
    return op.null_counts(customer_text(spark, folder), SAMPLER_NULLS, any_case=True)


@query(
    "null_normalised",
    f"""WITH {TEXT_SQL} SELECT CAST(c_custkey AS BIGINT) AS c_custkey,
      CASE WHEN c_name IN ('', 'NULL', 'null', chr(92) || 'N') THEN NULL ELSE c_name END AS c_name,
      CASE WHEN c_acctbal = '' THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer_text""",
)
def null_normalised(spark, folder):
    text = customer_text(spark, folder)
    return text.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        *[null_if(F.col(c)).alias(c) for c in ("c_name", "c_acctbal")],
    )


_TYPED = """
typed AS (
  SELECT column_name, count(value) AS values,
    bool_and(regexp_matches(value, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') OR regexp_matches(value, '^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$')
      OR (regexp_matches(value, '^[0-9]{8}$') AND TRY_CAST(value[1:4] AS INT) BETWEEN 1900 AND 2100
          AND TRY_CAST(value[5:6] AS INT) BETWEEN 1 AND 12 AND TRY_CAST(value[7:8] AS INT) BETWEEN 1 AND 31)) AS dates,
    bool_and(regexp_matches(value, '^-?[0-9]+$')) AS integers, bool_and(regexp_matches(value, '^-?[0-9]+\\.?[0-9]*$')) AS numbers
  FROM (SELECT column_name, CASE WHEN value IN ('', 'NULL', 'null', chr(92) || 'N') THEN NULL ELSE value END AS value FROM cells)
  GROUP BY column_name)
SELECT column_name, CASE WHEN values = 0 THEN 'UNKNOWN' WHEN dates THEN 'DATE' WHEN integers THEN 'INTEGER'
  WHEN numbers THEN 'FLOAT' ELSE 'VARCHAR' END AS type FROM typed"""


@query("type_guess", f"WITH {CELLS_SQL}, {_TYPED}")
def type_guess(spark, folder):
    return op.guess_types(customer_text(spark, folder))


_DATE_TEXT = """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%Y%m%d') AS digits,
  strftime(o_orderdate, '%m/%d/%Y') AS us, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS price FROM orders"""


def order_text(spark, folder):
    day = F.col("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.date_format(day, "yyyy-MM-dd").alias("iso"),
        F.date_format(day, "yyyyMMdd").alias("digits"),
        F.date_format(day, "MM/dd/yyyy").alias("us"),
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"),
    )


_ORDER_COLUMNS = ("o_orderkey", "iso", "digits", "us", "o_orderstatus", "price")


@query(
    "type_guess_dates",
    f"WITH order_text AS ({_DATE_TEXT}), cells AS ({_long('order_text', _ORDER_COLUMNS)}), {_TYPED}",
)
def type_guess_dates(spark, folder):
    return op.guess_types(order_text(spark, folder))


@query(
    "type_guess_first",
    f"""WITH order_text AS ({_DATE_TEXT}), cells AS ({_long('(SELECT * FROM order_text ORDER BY o_orderkey LIMIT 1)', _ORDER_COLUMNS)})
    SELECT column_name, CASE WHEN regexp_matches(value, '^[0-9]+$') THEN 'INTEGER'
      WHEN regexp_matches(replace(replace(value, '.', ''), '-', ''), '^[0-9]+$') THEN 'FLOAT'
      WHEN try_strptime(value, '%m/%d/%Y') IS NOT NULL THEN 'DATE' ELSE 'VARCHAR' END AS type FROM cells""",
)
def type_guess_first(spark, folder):
    return op.guess_types_first_value(order_text(spark, folder), ["o_orderkey"])


_CLASS = """CASE WHEN value IS NULL OR upper(value) IN ('', 'NULL', chr(92) || 'N', 'NA') THEN 'NULL'
  WHEN regexp_matches(trim(value), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$')
    THEN CASE WHEN contains(value, '.') THEN 'FLOAT' ELSE 'INTEGER' END
  WHEN regexp_matches(value, '^[0-9]{8}$') THEN 'DATE(YYYYMMDD)' WHEN regexp_matches(value, '^.{4}-.{2}-.{2}$') THEN 'DATE(YYYY-MM-DD)'
  WHEN contains(value, ' - ') THEN 'CODE/CATEGORY' ELSE 'STRING' END"""


@query(
    "value_classes",
    f"WITH {CELLS_SQL} SELECT column_name, {_CLASS} AS value_class, count(*) AS cells FROM cells GROUP BY ALL",
)
def value_classes(spark, folder):
    return op.value_classes(customer_text(spark, folder))


@query(
    "value_classes_dates",
    f"""WITH order_text AS ({_DATE_TEXT}), cells AS ({_long('order_text', _ORDER_COLUMNS)})
    SELECT column_name, {_CLASS} AS value_class, count(*) AS cells FROM cells GROUP BY ALL""",
)
def value_classes_dates(spark, folder):
    return op.value_classes(order_text(spark, folder))


_PROFILE = f"""SELECT column_name, count(*) AS row_count, count(*) FILTER (WHERE {_IS_NULL}) AS null_count,
  round(count(*) FILTER (WHERE {_IS_NULL}) * 100 / count(*), 1) AS null_pct, count(DISTINCT value) AS distinct_count,
  max(length(value)) AS max_width FROM cells GROUP BY column_name"""


@query("column_profile", f"WITH {CELLS_SQL} {_PROFILE}")
def column_profile(spark, folder):
    return op.column_profile(customer_text(spark, folder))


_PART = ("p_partkey", "p_name", "p_brand", "p_type", "p_size")


@query("column_profile_part", f"WITH cells AS ({_long('part', _PART)}) {_PROFILE}")
def column_profile_part(spark, folder):
    return op.column_profile(table(spark, folder, "part").select(*_PART))


_TEXTS = {"documents": ("text", "lang", "source"), "pages": ("url", "html"), "conversations": ("role", "text"), "benchmark": ("text",)}


@query(
    "column_profile_texts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, * FROM (WITH cells AS ({_long(t, c)}) {_PROFILE})" for t, c in _TEXTS.items()
    ),
)
def column_profile_texts(spark, folder):
    out = None
    for name, columns in _TEXTS.items():
        one = op.column_profile(table(spark, folder, name).select(*columns)).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "column_profile_labels",
    f"WITH cells AS ({_long('labels', ('doc_id', 'quality', 'toxic'))}) {_PROFILE}",
)
def column_profile_labels(spark, folder):
    return op.column_profile(table(spark, folder, "labels"))


@query("column_profile_approx")
def column_profile_approx(spark, folder):
    """Distinct counts from sketches: an estimate, so there is no SQL to equal it."""
    return op.column_profile(table(spark, folder, "lineitem"), exact=False)


@query(
    "vector_profile",
    """SELECT 'embedding' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE embedding IS NULL) AS null_count,
      min(len(embedding)) AS min_length, max(len(embedding)) AS max_length FROM embeddings""",
)
def vector_profile(spark, folder):
    size = F.size("embedding").cast("bigint")
    return table(spark, folder, "embeddings").agg(
        F.count("*").alias("row_count"),
        F.count(F.when(F.col("embedding").isNull(), 1)).alias("null_count"),
        F.min(size).alias("min_length"),
        F.max(size).alias("max_length"),
    ).select(F.lit("embedding").alias("column_name"), "*")


@query(
    "sample_values",
    f"""WITH cells AS ({_long('part', _PART)}), counts AS (SELECT column_name, value, count(*) AS n FROM cells WHERE value IS NOT NULL GROUP BY ALL)
    SELECT column_name, value, n, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rank FROM counts
    QUALIFY rank <= 5""",
)
def sample_values(spark, folder):
    return op.sample_values(table(spark, folder, "part").select(*_PART))


@query(
    "date_format_profile",
    f"""WITH order_text AS ({_DATE_TEXT}), {SPELLED_SQL},
    cells AS ({_long('order_text', _ORDER_COLUMNS)} UNION ALL SELECT 'cell', cell FROM spelled),
    kinds AS (SELECT column_name, CASE WHEN regexp_matches(trim(value), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN 'YYYY-MM-DD'
      WHEN regexp_matches(trim(value), '^[0-9]{{8}}$') THEN 'YYYYMMDD' WHEN regexp_matches(trim(value), '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$') THEN 'MM/DD/YYYY'
      WHEN regexp_matches(trim(value), '^[0-9]{{2}}-[A-Za-z]{{3}}-[0-9]{{4}}$') THEN 'DD-MON-YYYY'
      WHEN regexp_matches(trim(value), '^[A-Za-z]{{3}}\\s+[0-9]{{1,2}}\\s+[0-9]{{4}}$') THEN 'Mon DD YYYY' END AS spelling FROM cells)
    SELECT column_name, spelling, count(*) AS cells, count(*) OVER (PARTITION BY column_name) > 1 AS mixed
    FROM kinds WHERE spelling IS NOT NULL GROUP BY column_name, spelling""",
)
def date_format_profile(spark, folder):
    spelled = op.as_text(spelled_orders(spark, folder).select("o_orderkey", "cell")).select("cell")
    plain = order_text(spark, folder)
    return op.date_format_profile(plain).unionByName(op.date_format_profile(spelled))


_CANDIDATES = (("l_orderkey",), ("l_orderkey", "l_linenumber"), ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"))


def _candidates_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{",".join(k)}' AS key_columns, CAST({len(k)} AS BIGINT) AS key_size, CAST(sum(n) AS BIGINT) AS row_count,
        count(*) AS distinct_keys, round(count(*) / sum(n), 6) AS uniqueness, count(*) = sum(n) AS is_unique
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY {", ".join(k)})"""
        for k in _CANDIDATES
    )


@query("key_candidates", _candidates_sql())
def key_candidates(spark, folder):
    return op.key_candidates(table(spark, folder, "lineitem"), [list(k) for k in _CANDIDATES])


@query(
    "best_key",
    """SELECT 'o_orderkey' AS key_columns, CAST(1 AS BIGINT) AS key_size FROM
    (SELECT count(*) AS n FROM orders GROUP BY o_orderkey) HAVING max(n) = 1""",
)
def best_key(spark, folder):
    found = op.key_candidates(
        table(spark, folder, "orders"), [["o_custkey"], ["o_orderkey"], ["o_orderkey", "o_custkey"]]
    )
    return op.best_key(found).select("key_columns", "key_size")


@query(
    "column_names",
    f"""WITH {RENDERED_LINES_SQL} SELECT file, position, 'COLUMN_' || position AS column_name FROM
    (SELECT file, unnest(range(1, len(string_split(value, '|')) + 1)) AS position FROM lines WHERE seq = 0)""",
)
def column_names(spark, folder):
    return op.column_names(rendered_lines(spark, folder), "|", quote=None)


_DRIFT_SQL = """
headers AS (
  SELECT o_orderpriority AS file, unnest(CASE WHEN o_orderpriority < '3' THEN ['O_ORDERKEY', 'o_custkey', 'o_note']
    ELSE ['o_orderkey', 'o_custkey', 'o_orderdate', 'o_totalprice'] END) AS column_name
  FROM (SELECT DISTINCT o_orderpriority FROM orders)
)"""


@query(
    "schema_drift",
    f"""WITH {_DRIFT_SQL}, files AS (SELECT DISTINCT file FROM headers),
    wanted AS (SELECT unnest(['O_ORDERKEY', 'O_CUSTKEY', 'O_ORDERDATE', 'O_TOTALPRICE']) AS c),
    required AS (SELECT unnest(['O_ORDERKEY', 'O_ORDERDATE']) AS c)
    SELECT f.file, 'missing' AS violation, w.c AS column_name FROM files f JOIN wanted w ON true
      WHERE NOT EXISTS (SELECT 1 FROM headers h WHERE h.file = f.file AND upper(h.column_name) = w.c)
    UNION ALL SELECT f.file, 'required_missing', w.c FROM files f JOIN required w ON true
      WHERE NOT EXISTS (SELECT 1 FROM headers h WHERE h.file = f.file AND upper(h.column_name) = w.c)
    UNION ALL SELECT DISTINCT file, 'extra', upper(column_name) FROM headers WHERE upper(column_name) NOT IN (SELECT c FROM wanted)""",
)
def schema_drift(spark, folder):
    names = F.when(F.col("o_orderpriority") < "3", F.array(*map(F.lit, ("O_ORDERKEY", "o_custkey", "o_note")))).otherwise(
        F.array(*map(F.lit, ("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")))
    )
    headers = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("file"), F.explode(names).alias("column_name"))
    contract = Contract(
        "orders_{month}.tsv", "orders", ("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"), "o_orderdate", ("o_orderkey",)
    )
    return op.schema_drift(headers.distinct(), contract)


@query(
    "column_match",
    """SELECT 'customer' AS table_name, c AS column_name, t AS table_column, t IS NOT NULL AS found, n AS row_count
    FROM (VALUES ('C_CUSTKEY', 'c_custkey'), ('C_Name', 'c_name'), ('C_PHONE', NULL)) v(c, t), (SELECT count(*) AS n FROM customer)""",
)
def column_match(spark, folder):
    contract = Contract("customer.tsv", "customer", ("C_CUSTKEY", "C_Name", "C_PHONE"))
    columns = op.schema_inventory({"customer": table(spark, folder, "customer")})
    matched = op.match_columns(contracts_frame(spark, [contract]), columns)
    counts = columns.groupBy("table_name").agg(F.max("row_count").alias("row_count"))
    return matched.join(counts, "table_name")


@query(
    "width_against_table",
    f"""WITH {RENDERED_LINES_SQL} SELECT file, len(string_split(value, '|')) AS file_columns, CAST(5 AS BIGINT) AS table_columns,
      greatest(len(string_split(value, '|')) - 5, 0) AS extra_columns, greatest(5 - len(string_split(value, '|')), 0) AS missing_columns
    FROM lines WHERE seq = 0""",
)
def width_against_table(spark, folder):
    out = op.width_against_table(rendered_lines(spark, folder), table(spark, folder, "customer"), "|")
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("extra_columns", "missing_columns")})


@query(
    "schema_width",
    f"""WITH {RENDERED_LINES_SQL} SELECT file, len(string_split(value, '|')) AS actual_columns, CAST(4 AS BIGINT) AS expected_columns,
      len(string_split(value, '|')) = 4 AS schema_match FROM lines WHERE seq = 0""",
)
def schema_width(spark, folder):
    return op.schema_width(rendered_lines(spark, folder), RENDERED)
