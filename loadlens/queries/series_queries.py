"""Daily series, completeness and anomaly queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.functions import dates
from loadlens.operators import series as op
from loadlens.queries import query, table
from loadlens.queries.common import (
    CLASSIFIED_SQL,
    GAPS_SQL,
    MONTH,
    MONTH_END,
    MONTH_START,
    SERIES_SQL,
    STATS_SQL,
    audited,
    day_text,
    series,
)


@query(
    "daily_counts",
    f"WITH {SERIES_SQL} SELECT table_name, CAST(d AS VARCHAR) AS d, n FROM series",
)
def daily_counts(spark, folder):
    return series(spark, folder).withColumns(day_text("d"))


@query(
    "daily_stats",
    f"""WITH {SERIES_SQL}, {STATS_SQL}
    SELECT table_name, round(avg_count, 4) AS avg_count, round(std_dev, 4) AS std_dev,
           CAST(q1 AS DOUBLE) AS q1, CAST(median AS DOUBLE) AS median, CAST(q3 AS DOUBLE) AS q3 FROM stats""",
)
def daily_stats(spark, folder):
    out = op.series_statistics(series(spark, folder))
    return out.withColumns({c: F.round(c, 4) for c in ("avg_count", "std_dev")})


@query(
    "classified_days",
    f"""WITH {SERIES_SQL}, {STATS_SQL}, {CLASSIFIED_SQL}
    SELECT table_name, CAST(d AS VARCHAR) AS d, row_count, severity,
           CAST(round(CAST(row_count / avg_count * 100 AS DECIMAL(38, 10)), 1) AS DOUBLE) AS pct_of_avg, CAST(floor(avg_count) AS BIGINT) AS expected_count
    FROM classified""",
)
def classified_days(spark, folder):
    return op.classify_days(series(spark, folder)).drop("avg_count").withColumns(day_text("d"))


@query(
    "volume_anomalies",
    f"""WITH {SERIES_SQL}, {STATS_SQL}, {CLASSIFIED_SQL},
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY
        CASE severity WHEN 'SEVERELY_LOW' THEN 1 WHEN 'OUTLIER_LOW' THEN 2 WHEN 'LOW' THEN 3 ELSE 4 END, d) AS rn
      FROM classified WHERE severity <> 'NORMAL')
    SELECT table_name, CAST(d AS VARCHAR) AS d, row_count, severity,
           CAST(round(CAST(row_count / avg_count * 100 AS DECIMAL(38, 10)), 1) AS DOUBLE) AS pct_of_avg, CAST(floor(avg_count) AS BIGINT) AS expected_count
    FROM ranked""",
)
def volume_anomalies(spark, folder):
    return op.volume_anomalies(series(spark, folder)).drop("avg_count").withColumns(day_text("d"))


@query(
    "anomaly_severity_counts",
    f"""WITH {SERIES_SQL}, {STATS_SQL}, {CLASSIFIED_SQL}
    SELECT table_name, severity, count(*) AS days, severity IN ('SEVERELY_LOW', 'OUTLIER_LOW') AS fails_table
    FROM classified GROUP BY table_name, severity""",
)
def anomaly_severity_counts(spark, folder):
    return op.severity_counts(op.classify_days(series(spark, folder)))


_GRADE = f"""WITH {SERIES_SQL}, {STATS_SQL}, {CLASSIFIED_SQL},
counts AS (
  SELECT table_name, count(*) FILTER (WHERE severity = 'SEVERELY_LOW') AS severely_low,
         count(*) FILTER (WHERE severity IN ('OUTLIER_LOW', 'OUTLIER_HIGH')) AS outliers,
         count(*) FILTER (WHERE severity <> 'NORMAL') AS anomalies
  FROM classified GROUP BY table_name)
SELECT table_name, anomalies, CASE WHEN anomalies = 0 THEN NULL {{}} END AS anomaly_severity FROM counts"""


@query(
    "anomaly_grade",
    _GRADE.format("WHEN severely_low > 0 THEN 'CRITICAL' WHEN outliers > 0 THEN 'HIGH' ELSE 'MEDIUM'"),
)
def anomaly_grade(spark, folder):
    return op.anomaly_grade(op.classify_days(series(spark, folder)))


@query(
    "anomaly_grade_legacy",
    _GRADE.format(
        "WHEN severely_low > 10 THEN 'CRITICAL' WHEN severely_low > 5 THEN 'HIGH' "
        "WHEN anomalies > 10 THEN 'MEDIUM' ELSE 'LOW'"
    ),
)
def anomaly_grade_legacy(spark, folder):
    return op.anomaly_grade(op.classify_days(series(spark, folder)), policy="legacy")


@query(
    "date_extent",
    f"""WITH {SERIES_SQL}
    SELECT table_name, CAST(min(d) AS VARCHAR) AS min_date, CAST(max(d) AS VARCHAR) AS max_date
    FROM series GROUP BY table_name""",
)
def date_extent(spark, folder):
    return op.date_extent(series(spark, folder)).withColumns(day_text("min_date", "max_date"))


@query(
    "range_summary",
    f"""SELECT 'orders' AS table_name, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS min_date,
           CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS max_date,
           count(DISTINCT CAST(o_orderdate AS DATE)) AS unique_dates, count(*) AS total_rows
    FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{MONTH_START}' AND DATE '{MONTH_END}'""",
)
def range_summary(spark, folder):
    month = op.daily_series(table(spark, folder, "orders"), "o_orderdate", "orders", MONTH_START, MONTH_END)
    return op.range_summary(month).withColumns(day_text("min_date", "max_date"))


@query(
    "completeness_month",
    f"""WITH {SERIES_SQL}, {GAPS_SQL},
    inside AS (SELECT * FROM series WHERE d BETWEEN DATE '{MONTH_START}' AND DATE '{MONTH_END}'),
    extent AS (SELECT table_name, min(d) AS lo, max(d) AS hi FROM series GROUP BY table_name),
    month_gaps AS (SELECT table_name, count(*) AS c FROM gaps
      WHERE prev >= DATE '{MONTH_START}' AND d <= DATE '{MONTH_END}' GROUP BY table_name)
    SELECT e.table_name, CAST(e.lo AS VARCHAR) AS actual_start, CAST(e.hi AS VARCHAR) AS actual_end,
           count(i.d) AS unique_dates, CAST(coalesce(sum(i.n), 0) AS BIGINT) AS total_rows,
           CAST(31 AS BIGINT) AS expected_dates, 31 - count(i.d) AS missing_dates,
           coalesce(max(g.c), 0) AS gap_count,
           round(coalesce(sum(i.n) / nullif(count(i.d), 0), 0), 4) AS avg_rows_per_day
    FROM extent e LEFT JOIN inside i USING (table_name) LEFT JOIN month_gaps g ON g.table_name = e.table_name
    GROUP BY e.table_name, e.lo, e.hi""",
)
def completeness_month(spark, folder):
    out = op.completeness(series(spark, folder), *dates.month_range(MONTH))
    return out.select(
        "table_name",
        *[v.alias(k) for k, v in day_text("actual_start", "actual_end").items()],
        "unique_dates",
        "total_rows",
        "expected_dates",
        "missing_dates",
        "gap_count",
        F.round("avg_rows_per_day", 4).alias("avg_rows_per_day"),
    )


@query(
    "date_gaps",
    f"""WITH {SERIES_SQL}, {GAPS_SQL}
    SELECT table_name, CAST(prev AS VARCHAR) AS prev_date, CAST(d AS VARCHAR) AS next_date, missing_days FROM gaps""",
)
def date_gaps(spark, folder):
    return op.date_gaps(series(spark, folder)).withColumns(day_text("prev_date", "next_date"))


@query(
    "date_gaps_listed",
    f"""WITH {SERIES_SQL}, {GAPS_SQL}
    SELECT table_name, CAST(prev AS VARCHAR) AS prev_date, CAST(d AS VARCHAR) AS next_date, missing_days,
      count(*) OVER (PARTITION BY table_name) > 100 AS truncated FROM gaps
    QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY prev) <= 100""",
)
def date_gaps_listed(spark, folder):
    return op.listed_gaps(series(spark, folder), limit=100).withColumns(day_text("prev_date", "next_date"))


@query(
    "missing_dates_gaps",
    f"""WITH {SERIES_SQL}, {GAPS_SQL}
    SELECT table_name, CAST(CAST(x AS DATE) AS VARCHAR) AS missing_date
    FROM (SELECT table_name, unnest(generate_series(prev + 1, d - 1, INTERVAL 1 DAY)) AS x
          FROM gaps)""",
)
def missing_dates_gaps(spark, folder):
    return op.missing_from_gaps(series(spark, folder)).withColumns(day_text("missing_date"))


@query(
    "missing_dates_calendar",
    f"""WITH {SERIES_SQL},
    spine AS (SELECT table_name, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT table_name, min(d) AS lo, max(d) AS hi FROM series GROUP BY table_name))
    SELECT table_name, CAST(d AS VARCHAR) AS missing_date FROM spine ANTI JOIN series USING (table_name, d)""",
)
def missing_dates_calendar(spark, folder):
    return op.missing_days(series(spark, folder)).withColumns(day_text("missing_date"))


@query(
    "missing_dates_quarter",
    f"""WITH {SERIES_SQL},
    spine AS (SELECT t.table_name, CAST(unnest(generate_series(DATE '2001-06-01', DATE '2001-08-31', INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT DISTINCT table_name FROM series) t)
    SELECT table_name, CAST(d AS VARCHAR) AS missing_date FROM spine ANTI JOIN series USING (table_name, d)""",
)
def missing_dates_quarter(spark, folder):
    found = op.missing_days(series(spark, folder), "2001-06-01", "2001-08-31")
    return found.withColumns(day_text("missing_date"))


@query(
    "date_distribution",
    f"""WITH {SERIES_SQL}
    SELECT table_name, CAST(d AS VARCHAR) AS d, n AS row_count FROM series
    WHERE d BETWEEN DATE '{MONTH_START}' AND DATE '{MONTH_END}'""",
)
def date_distribution(spark, folder):
    return op.date_distribution(series(spark, folder), MONTH_START, MONTH_END).withColumns(day_text("d"))


# Order dates in changing spellings, some of them unusable.
SPELLED_SQL = """
spelled AS (
  SELECT o_orderkey, o_orderdate, CASE o_orderkey % 8
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 1 THEN strftime(o_orderdate, '%Y%m%d')
    WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y')
    WHEN 3 THEN strftime(o_orderdate, '%b') || '  ' || CAST(day(o_orderdate) AS VARCHAR) || ' ' || CAST(year(o_orderdate) AS VARCHAR)
    WHEN 4 THEN strftime(o_orderdate, '%d-%m-%Y')
    WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    WHEN 6 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m') END AS cell
  FROM orders
)"""


def spelled_orders(spark, folder):
    day = F.col("o_orderdate")
    turn = F.col("o_orderkey") % 8
    fmt = lambda f: F.date_format(day, f)
    cell = (
        F.when(turn == 0, fmt("yyyy-MM-dd"))
        .when(turn == 1, fmt("yyyyMMdd"))
        .when(turn == 2, fmt("MM/dd/yyyy"))
        .when(turn == 3, fmt("MMM  d yyyy"))
        .when(turn == 4, fmt("dd-MM-yyyy"))
        .when(turn == 5, fmt("yyyy-MM-dd HH:mm:ss"))
        .when(turn == 6, "n/a")
        .otherwise(fmt("yyyy-MM"))
    )
    return table(spark, folder, "orders").withColumn("cell", cell)


_FORMATS = (
    "%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%m-%d-%Y", "%d/%m/%Y", "%d-%m-%Y", "%Y%m%d", "%b %d %Y", "%b %d, %Y",
    "%B %d %Y", "%B %d, %Y", "%d %b %Y", "%d %B %Y", "%Y-%m-%d %H:%M:%S", "%Y/%m/%d %H:%M:%S",
    "%m/%d/%Y %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ",
)
_SPARK_FORMATS = (
    "yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "MM-dd-yyyy", "dd/MM/yyyy", "dd-MM-yyyy", "yyyyMMdd", "MMM dd yyyy",
    "MMM dd, yyyy", "MMMM dd yyyy", "MMMM dd, yyyy", "dd MMM yyyy", "dd MMMM yyyy", "yyyy-MM-dd HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'",
)


def parse_sql(cell: str) -> str:
    """The ordered list of formats as a SQL expression."""
    clean = f"regexp_replace(trim({cell}), '\\s+', ' ', 'g')"
    return "CAST(coalesce(" + ", ".join(f"try_strptime({clean}, '{f}')" for f in _FORMATS) + ") AS DATE)"


@query(
    "date_spellings",
    "WITH spelled AS ("
    + " UNION ALL ".join(
        f"SELECT {i} AS spelling, strftime(o_orderdate, '{f}') AS cell FROM orders" for i, f in enumerate(_FORMATS)
    )
    + f""")
    SELECT CAST(spelling AS BIGINT) AS spelling, CAST({parse_sql("cell")} AS VARCHAR) AS d, count(*) AS n
    FROM spelled GROUP BY ALL""",
)
def date_spellings(spark, folder):
    day = F.col("o_orderdate")
    cells = F.array(*[F.date_format(day, f) for f in _SPARK_FORMATS])
    rows = table(spark, folder, "orders").select(F.posexplode(cells).alias("spelling", "cell"))
    parsed = F.date_format(dates.parse_date(F.col("cell")), "yyyy-MM-dd").alias("d")
    return rows.groupBy(F.col("spelling").cast("bigint").alias("spelling"), parsed).agg(F.count("*").alias("n"))


@query(
    "text_date_series",
    f"""WITH {SPELLED_SQL}
    SELECT CAST({parse_sql("cell")} AS VARCHAR) AS d, count(*) AS n FROM spelled GROUP BY 1""",
)
def text_date_series(spark, folder):
    out = op.daily_series(spelled_orders(spark, folder), "cell", "orders")
    return out.select(F.date_format("d", "yyyy-MM-dd").alias("d"), "n")


@query(
    "rendered_dates",
    f"""WITH {SPELLED_SQL}
    SELECT o_orderkey, coalesce(CAST({parse_sql("cell")} AS VARCHAR), cell) AS rendered FROM spelled""",
)
def rendered_dates(spark, folder):
    return spelled_orders(spark, folder).select("o_orderkey", dates.render_date(F.col("cell")).alias("rendered"))


@query(
    "invalid_dates",
    f"""WITH {SPELLED_SQL}
    SELECT o_orderkey, trim(cell) AS value FROM spelled
    WHERE coalesce(try_strptime(trim(cell), '%Y-%m-%d'), try_strptime(trim(cell), '%Y%m%d'),
                   try_strptime(trim(cell), '%m/%d/%Y')) IS NULL""",
)
def invalid_dates(spark, folder):
    return op.invalid_dates(spelled_orders(spark, folder), "cell", ["o_orderkey"], limit=None)


@query(
    "invalid_dates_first",
    f"""WITH {SPELLED_SQL}
    SELECT o_orderkey, trim(cell) AS value FROM spelled
    WHERE coalesce(try_strptime(trim(cell), '%Y-%m-%d'), try_strptime(trim(cell), '%Y%m%d'),
                   try_strptime(trim(cell), '%m/%d/%Y')) IS NULL
    ORDER BY o_orderkey, value LIMIT 100""",
)
def invalid_dates_first(spark, folder):
    return op.invalid_dates(spelled_orders(spark, folder), "cell", ["o_orderkey"], limit=100)


@query(
    "partial_load_probe",
    f"""WITH {SPELLED_SQL}
    SELECT count(*) AS row_count, CAST(min({parse_sql("cell")}) AS VARCHAR) AS min_date,
           CAST(max({parse_sql("cell")}) AS VARCHAR) AS max_date
    FROM spelled WHERE cell LIKE '1996-03-%' OR cell LIKE '199603%' OR cell LIKE '%-03-1996' OR cell LIKE '03/%/1996'""",
)
def partial_load_probe(spark, folder):
    out = op.partial_load_probe(spelled_orders(spark, folder), "cell", MONTH)
    return out.withColumns(day_text("min_date", "max_date"))


@query(
    "partial_load_probe_typed",
    f"""SELECT count(*) AS row_count, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS min_date,
           CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS max_date
    FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{MONTH_START}' AND DATE '{MONTH_END}'""",
)
def partial_load_probe_typed(spark, folder):
    out = op.partial_load_probe(table(spark, folder, "orders"), "o_orderdate", MONTH)
    return out.withColumns(day_text("min_date", "max_date"))


@query(
    "month_bounds",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(date_trunc('month', min(o_orderdate))::DATE AS VARCHAR) AS first_day,
           CAST(last_day(min(o_orderdate)) AS VARCHAR) AS last_day,
           CAST(date_diff('day', date_trunc('month', min(o_orderdate))::DATE, last_day(min(o_orderdate))) + 1 AS BIGINT) AS expected_dates,
           count(*) AS n
    FROM orders GROUP BY 1""",
)
def month_bounds(spark, folder):
    months = table(spark, folder, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("n")
    )
    first, last = dates.month_start(F.col("month")), dates.month_end(F.col("month"))
    return months.select(
        "month",
        F.date_format(first, "yyyy-MM-dd").alias("first_day"),
        F.date_format(last, "yyyy-MM-dd").alias("last_day"),
        dates.expected_days(first, last).alias("expected_dates"),
        "n",
    )


@query(
    "unparseable_dates",
    f"""WITH {SPELLED_SQL}
    SELECT 'orders' AS table_name, count(*) FILTER (WHERE {parse_sql("cell")} IS NULL) AS unparseable_date_rows
    FROM spelled""",
)
def unparseable_dates(spark, folder):
    return op.unparseable_rows(op.daily_series(spelled_orders(spark, folder), "cell", "orders"))


def flagship(spark, folder):
    """Classified days of the three dated tables."""
    return op.classify_days(op.daily_series_of(audited(spark, folder)))
