"""Table validation and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.operators import profile
from loadlens.plans import audit, report
from loadlens.queries import query, table
from loadlens.queries.common import (
    AUDIT_SQL,
    GAPS_SQL,
    MONTH,
    MONTH_END,
    MONTH_START,
    SERIES_SQL,
    audited,
    day_text,
    reported,
)
from loadlens.session import scratch
from loadlens.sources import sinks

_VALIDATION = (
    "total_rows", "unique_dates", "expected_dates", "missing_dates", "gap_count", "anomaly_count", "severely_low",
    "outlier_low", "low", "outlier_high", "duplicate_keys", "excess_rows", "max_duplicates", "duplicate_severity",
    "valid",
)


@query(
    "validate_tables",
    f"""WITH {AUDIT_SQL} SELECT table_name, actual_start, actual_end, {", ".join(_VALIDATION)},
    round(avg_rows_per_day, 4) AS avg_rows_per_day FROM audit""",
)
def validate_tables(spark, folder):
    out = audit.validate_tables(spark, audited(spark, folder))
    return out.select(
        "table_name",
        *[v.alias(k) for k, v in day_text("actual_start", "actual_end").items()],
        *_VALIDATION,
        F.round("avg_rows_per_day", 4).alias("avg_rows_per_day"),
    )


@query(
    "validate_month",
    f"""WITH {SERIES_SQL}, {GAPS_SQL},
    names AS (SELECT DISTINCT table_name FROM series),
    inside AS (SELECT * FROM series WHERE d BETWEEN DATE '{MONTH_START}' AND DATE '{MONTH_END}'),
    stats AS (SELECT table_name, avg(n) AS a, quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.75) AS q3
      FROM inside GROUP BY table_name),
    odd AS (SELECT i.table_name, count(*) AS anomaly_count FROM inside i JOIN stats s USING (table_name)
      WHERE n < a * 0.5 OR n < a * 0.1 OR n < q1 - 1.5 * (q3 - q1) OR n > q3 + 1.5 * (q3 - q1) GROUP BY 1),
    month_gaps AS (SELECT table_name, count(*) AS c FROM gaps
      WHERE prev >= DATE '{MONTH_START}' AND d <= DATE '{MONTH_END}' GROUP BY table_name),
    keys AS (
      SELECT 'orders' AS table_name, count(*) AS n FROM orders
        WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{MONTH_START}' AND DATE '{MONTH_END}'
        GROUP BY o_custkey, CAST(o_orderdate AS DATE)
      UNION ALL SELECT 'lineitem', count(*) FROM lineitem
        WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{MONTH_START}' AND DATE '{MONTH_END}' GROUP BY l_orderkey, l_linenumber
      UNION ALL SELECT 'events', count(*) FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '{MONTH_START}' AND DATE '{MONTH_END}' GROUP BY user_id, event_type, CAST(ts AS DATE)),
    dups AS (SELECT table_name, count(*) FILTER (WHERE n > 1) AS duplicate_keys FROM keys GROUP BY 1)
    SELECT t.table_name, '{MONTH_START}' AS requested_start, '{MONTH_END}' AS requested_end,
           CAST(coalesce(sum(i.n), 0) AS BIGINT) AS total_rows, count(i.d) AS unique_dates, CAST(31 AS BIGINT) AS expected_dates,
           31 - count(i.d) AS missing_dates, coalesce(max(g.c), 0) AS gap_count,
           coalesce(max(o.anomaly_count), 0) AS anomaly_count, coalesce(max(d.duplicate_keys), 0) AS duplicate_keys
    FROM names t LEFT JOIN inside i USING (table_name) LEFT JOIN month_gaps g ON g.table_name = t.table_name
    LEFT JOIN odd o ON o.table_name = t.table_name LEFT JOIN dups d ON d.table_name = t.table_name
    GROUP BY t.table_name""",
)
def validate_month(spark, folder):
    out = audit.validate_month(spark, audited(spark, folder), MONTH)
    return out.select(
        "table_name",
        *[v.alias(k) for k, v in day_text("requested_start", "requested_end").items()],
        "total_rows", "unique_dates", "expected_dates", "missing_dates", "gap_count", "anomaly_count", "duplicate_keys",
    )


@query(
    "quick_validate",
    f"WITH {AUDIT_SQL} SELECT table_name, total_rows, missing_dates, gap_count, anomaly_count FROM audit WHERE table_name = 'orders'",
)
def quick_validate(spark, folder):
    out = audit.quick_validate(spark, table(spark, folder, "orders"), "o_orderdate", table_name="orders")
    return out.select("table_name", "total_rows", "missing_dates", "gap_count", "anomaly_count")


@query(
    "validation_rollup",
    f"""WITH {AUDIT_SQL} SELECT count(*) AS tables, count(*) FILTER (WHERE NOT valid) AS tables_with_issues,
      CAST(sum(total_rows) AS BIGINT) AS total_rows, CAST(sum(missing_dates) AS BIGINT) AS total_missing_dates,
      CAST(sum(gap_count) AS BIGINT) AS total_gaps, CAST(sum(anomaly_count) AS BIGINT) AS total_anomalies,
      CAST(sum(duplicate_keys) AS BIGINT) AS total_duplicate_keys FROM audit""",
)
def validation_rollup(spark, folder):
    return audit.validation_rollup(audit.validate_tables(spark, audited(spark, folder)))


@query(
    "failure_reasons",
    f"""WITH {AUDIT_SQL}
    SELECT table_name, missing_dates || ' missing dates' AS reason FROM audit WHERE missing_dates > 0
    UNION ALL SELECT table_name, gap_count || ' gaps between dates' FROM audit WHERE gap_count > 0
    UNION ALL SELECT table_name, severely_low || ' dates under a tenth of the average rows' FROM audit WHERE severely_low > 0
    UNION ALL SELECT table_name, outlier_low || ' dates with outlying few rows' FROM audit WHERE outlier_low > 0
    UNION ALL SELECT table_name, duplicate_keys || ' duplicated keys' FROM audit WHERE duplicate_keys > 0""",
)
def failure_reasons(spark, folder):
    return audit.tables_with_issues(audit.validate_tables(spark, audited(spark, folder)))


@query(
    "issues_flat",
    f"""WITH {AUDIT_SQL}
    SELECT table_name, 'missing_date' AS kind, CAST(CAST(x AS DATE) AS VARCHAR) AS detail
    FROM (SELECT table_name, unnest(generate_series(prev + 1, d - 1, INTERVAL 1 DAY)) AS x FROM gaps)
    UNION ALL
    SELECT table_name, 'gap', prev || ' to ' || d || ' (' || missing_days || ' days missing)' FROM gaps
    UNION ALL
    SELECT table_name, 'anomaly', d || ': ' || row_count || ' rows (' || severity || ')' FROM classified WHERE severity <> 'NORMAL'
    UNION ALL
    SELECT table_name, 'duplicates', duplicate_keys || ' keys, ' || excess_rows || ' excess rows' FROM audit WHERE duplicate_keys > 0""",
)
def issues_flat(spark, folder):
    return report.issues_flat(audit.validate_tables(spark, audited(spark, folder), listed=None))


@query(
    "table_info",
    """SELECT 'orders' AS table_name, count(*) AS row_count, CAST(6 AS BIGINT) AS column_count,
      CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS min_date, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS max_date FROM orders
    UNION ALL SELECT 'lineitem', count(*), 11, CAST(min(CAST(l_shipdate AS DATE)) AS VARCHAR), CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) FROM lineitem
    UNION ALL SELECT 'events', count(*), 6, CAST(min(CAST(ts AS DATE)) AS VARCHAR), CAST(max(CAST(ts AS DATE)) AS VARCHAR) FROM events
    UNION ALL SELECT 'region', count(*), 2, NULL, NULL FROM region
    UNION ALL SELECT 'orders_archive', 0, 6, NULL, NULL""",
)
def table_info(spark, folder):
    return report.table_info(reported(spark, folder)).withColumns(day_text("min_date", "max_date"))


_REPORT = f"""{AUDIT_SQL},
graded AS (
  SELECT *, CASE WHEN severely_low > 0 THEN 'CRITICAL' WHEN outlier_low + outlier_high > 0 THEN 'HIGH'
                 WHEN anomaly_count > 0 THEN 'MEDIUM' END AS anomaly_severity FROM audit
),
report AS (
  SELECT table_name, 'SUCCESS' AS status,
    CASE WHEN valid THEN 'PASSED' WHEN anomaly_severity = 'CRITICAL' OR duplicate_severity = 'CRITICAL' THEN 'FAILED'
         ELSE 'WARNING' END AS validation_status,
    row_count, CASE table_name WHEN 'lineitem' THEN 11 ELSE 6 END AS column_count,
    actual_start AS date_range_start, actual_end AS date_range_end, unique_dates, expected_dates, missing_dates, gap_count,
    anomaly_count, anomaly_severity, duplicate_keys, excess_rows AS duplicate_rows, duplicate_severity,
    round(avg_rows_per_day, 4) AS avg_rows_per_day,
    concat_ws('; ', CASE WHEN missing_dates > 0 THEN missing_dates || ' missing dates' END,
      CASE WHEN gap_count > 0 THEN gap_count || ' gaps between dates' END,
      CASE WHEN anomaly_count > 0 THEN anomaly_count || ' anomalous dates (' || anomaly_severity || ')' END,
      CASE WHEN duplicate_keys > 0 THEN duplicate_keys || ' duplicate keys (' || duplicate_severity || ')' END) AS issues
  FROM graded
  UNION ALL SELECT 'region', 'SUCCESS', 'NOT_RUN', (SELECT count(*) FROM region), 2, NULL, NULL, 0, 0, 0, 0, 0, NULL, 0, 0, NULL, 0, ''
  UNION ALL SELECT 'orders_archive', 'EMPTY', 'WARNING', 0, 6, NULL, NULL, 0, 0, 0, 0, 0, NULL, 0, 0, 'NONE', 0, 'Table is empty'
  UNION ALL SELECT 'returns', 'TABLE_NOT_FOUND', 'FAILED', 0, 0, NULL, NULL, 0, 0, 0, 0, 0, NULL, 0, 0, NULL, 0, 'Table does not exist'
)"""

_REPORT_COLUMNS = (
    "table_name", "status", "validation_status", "row_count", "column_count", "date_range_start", "date_range_end",
    "unique_dates", "expected_dates", "missing_dates", "gap_count", "anomaly_count", "anomaly_severity",
    "duplicate_keys", "duplicate_rows", "duplicate_severity",
)


def _report(spark, folder):
    return report.table_report(spark, reported(spark, folder))


@query(
    "table_report",
    f"""WITH {_REPORT} SELECT {", ".join(c for c in _REPORT_COLUMNS if c != "column_count")},
    CAST(column_count AS BIGINT) AS column_count, CAST(avg_rows_per_day AS DOUBLE) AS avg_rows_per_day, issues FROM report""",
)
def table_report(spark, folder):
    return _report(spark, folder).select(
        *_REPORT_COLUMNS,
        F.round("avg_rows_per_day", 4).alias("avg_rows_per_day"),
        F.concat_ws("; ", "validation_issues").alias("issues"),
    )


@query(
    "report_isolated",
    f"WITH {_REPORT} SELECT table_name, status, validation_status, row_count FROM report",
)
def report_isolated(spark, folder):
    out = report.isolated_report(spark, reported(spark, folder))
    return out.select("table_name", "status", "validation_status", "row_count")


@query(
    "report_status_counts",
    f"""WITH {_REPORT} SELECT 'status' AS kind, status AS name, count(*) AS tables FROM report GROUP BY 2
    UNION ALL SELECT 'validation', validation_status, count(*) FROM report GROUP BY 2""",
)
def report_status_counts(spark, folder):
    return report.status_counts(_report(spark, folder))


@query(
    "report_rollup",
    f"""WITH {_REPORT} SELECT count(*) AS total_tables, CAST(sum(row_count) AS BIGINT) AS total_rows,
      count(*) FILTER (WHERE issues <> '') AS tables_with_issues, count(*) FILTER (WHERE validation_status = 'FAILED') AS failed,
      count(*) FILTER (WHERE gap_count > 0) AS gaps, count(*) FILTER (WHERE duplicate_severity IN ('HIGH', 'CRITICAL')) AS duplicates,
      count(*) FILTER (WHERE anomaly_severity IN ('HIGH', 'CRITICAL')) AS anomalies,
      count(*) FILTER (WHERE status = 'TABLE_NOT_FOUND') AS not_found, count(*) FILTER (WHERE status = 'EMPTY') AS empty FROM report""",
)
def report_rollup(spark, folder):
    return report.report_rollup(_report(spark, folder))


@query(
    "largest_tables",
    f"WITH {_REPORT} SELECT table_name, row_count FROM report WHERE row_count > 0 ORDER BY row_count DESC, table_name LIMIT 5",
)
def largest_tables(spark, folder):
    return report.largest_tables(_report(spark, folder))


@query(
    "critical_tables",
    f"""WITH {_REPORT} SELECT table_name, unnest(string_split(issues, '; ')) AS reason FROM report WHERE validation_status = 'FAILED'""",
)
def critical_tables(spark, folder):
    return report.critical_tables(_report(spark, folder))


@query("empty_tables", f"WITH {_REPORT} SELECT table_name FROM report WHERE status = 'EMPTY'")
def empty_tables(spark, folder):
    return report.empty_tables(_report(spark, folder))


@query(
    "report_filtered",
    f"WITH {_REPORT} SELECT table_name, row_count FROM report WHERE table_name LIKE 'orders%'",
)
def report_filtered(spark, folder):
    targets = report.select_targets(reported(spark, folder), "ORDERS*")
    return report.table_report(spark, targets).select("table_name", "row_count")


@query(
    "recommended_actions",
    f"""WITH {_REPORT},
    findings AS (
      SELECT 'failed' AS kind, 'Look into every table that failed validation first' AS action, count(*) FILTER (WHERE validation_status = 'FAILED') AS n FROM report
      UNION ALL SELECT 'gaps', 'Reload or explain the days missing inside the date range', count(*) FILTER (WHERE gap_count > 0) FROM report
      UNION ALL SELECT 'duplicates', 'Remove duplicate keys where their severity is high or critical', count(*) FILTER (WHERE duplicate_severity IN ('HIGH', 'CRITICAL')) FROM report
      UNION ALL SELECT 'anomalies', 'Find out why days with high or critical severity have unusual volumes', count(*) FILTER (WHERE anomaly_severity IN ('HIGH', 'CRITICAL')) FROM report
      UNION ALL SELECT 'not_found', 'Create the tables that were not found, or correct their names', count(*) FILTER (WHERE status = 'TABLE_NOT_FOUND') FROM report
      UNION ALL SELECT 'empty', 'Load the tables that have no rows', count(*) FILTER (WHERE status = 'EMPTY') FROM report)
    SELECT kind, action FROM findings WHERE n > 0""",
)
def recommended_actions(spark, folder):
    return report.recommended_actions(_report(spark, folder))


@query(
    "report_saved",
    f"WITH {_REPORT} SELECT table_name, status, validation_status, row_count, missing_dates, issues FROM report",
)
def report_saved(spark, folder):
    """The report written as JSON and read back."""
    target = scratch(spark, "report")
    sinks.write_json_report(_report(spark, folder), target)
    schema = "table_name string, status string, validation_status string, row_count bigint, missing_dates bigint, validation_issues array<string>"
    back = spark.read.schema(schema).json(target)
    return back.withColumn("issues", F.concat_ws("; ", "validation_issues")).drop("validation_issues")


@query(
    "issues_saved",
    f"""WITH {AUDIT_SQL}
    SELECT table_name || ': missing_date: ' || CAST(CAST(x AS DATE) AS VARCHAR) AS line
    FROM (SELECT table_name, unnest(generate_series(prev + 1, d - 1, INTERVAL 1 DAY)) AS x FROM gaps)
    UNION ALL SELECT table_name || ': gap: ' || prev || ' to ' || d || ' (' || missing_days || ' days missing)' FROM gaps
    UNION ALL SELECT table_name || ': anomaly: ' || d || ': ' || row_count || ' rows (' || severity || ')' FROM classified WHERE severity <> 'NORMAL'
    UNION ALL SELECT table_name || ': duplicates: ' || duplicate_keys || ' keys, ' || excess_rows || ' excess rows' FROM audit WHERE duplicate_keys > 0""",
)
def issues_saved(spark, folder):
    """The issue list written as text and read back."""
    target = scratch(spark, "issues")
    sinks.write_issue_text(report.issues_flat(audit.validate_tables(spark, audited(spark, folder), listed=None)), target)
    return spark.read.text(target).select(F.col("value").alias("line"))


INVENTORIED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _inventory_sql() -> str:
    parts = []
    for name, columns in _COLUMNS.items():
        for i, column in enumerate(columns.split(", "), 1):
            col, kind = column.split(" ")
            parts.append(
                f"SELECT '{name}' AS table_name, '{col}' AS column_name, '{kind}' AS data_type, "
                f"CAST({i} AS BIGINT) AS ordinal, count({col}) AS row_count FROM {name}"
            )
    return " UNION ALL ".join(parts)


@query("schema_inventory", _inventory_sql())
def schema_inventory(spark, folder):
    return profile.schema_inventory({n: table(spark, folder, n) for n in INVENTORIED})
