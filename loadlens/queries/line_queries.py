"""Line-structure queries: every document, page or rendered row set is one file."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.contracts import Contract
from loadlens.operators import sniff, structure
from loadlens.queries import query, table
from loadlens.sources.lines import first_lines, head_lines, split_lines

# Lines of each text with their zero-based position; a final line feed ends the last line.
def _lines_sql(source: str, file: str, text: str) -> str:
    return f"""
lines AS (
  SELECT {file} AS file, unnest(parts) AS value, unnest(range(0, len(parts))) AS seq
  FROM (SELECT {file}, string_split(CASE WHEN ends_with({text}, chr(10)) THEN left({text}, length({text}) - 1) ELSE {text} END, chr(10)) AS parts
        FROM {source} WHERE length({text}) > 0)
)"""


DOCS_SQL = _lines_sql("documents", "doc_id", "text")
PAGES_SQL = _lines_sql("pages", "page_id", "html")

# Customers rendered as pipe-separated lines, one file per nation, some rows damaged.
RENDERED_SQL = """
rendered AS (
  SELECT c_nationkey AS file, string_agg(
    c_custkey || '|' || c_name || '|' ||
    CASE WHEN c_custkey % 50 = 7 THEN c_mktsegment WHEN c_custkey % 50 = 9 THEN c_mktsegment || '|x|y'
         WHEN c_custkey % 50 = 11 THEN 'bad' || chr(1) || '|' || c_mktsegment
         WHEN c_custkey % 50 = 13 THEN '"open|' || c_mktsegment ELSE 'ok|' || c_mktsegment END
    || CASE WHEN c_custkey % 50 = 15 THEN chr(13) ELSE '' END, chr(10) ORDER BY c_custkey) || chr(10) AS body
  FROM customer GROUP BY c_nationkey
)"""
RENDERED_LINES_SQL = RENDERED_SQL + "," + _lines_sql("rendered", "file", "body")


def doc_lines(spark, folder):
    return split_lines(table(spark, folder, "documents"), "doc_id", "text")


def page_lines(spark, folder):
    return split_lines(table(spark, folder, "pages"), "page_id", "html")


def rendered_lines(spark, folder):
    """Customer rows as lines of one file per nation, straight from the rows."""
    turn = F.col("c_custkey") % 50
    tail = (
        F.when(turn == 7, F.col("c_mktsegment"))
        .when(turn == 9, F.concat("c_mktsegment", F.lit("|x|y")))
        .when(turn == 11, F.concat(F.lit("bad\u0001|"), "c_mktsegment"))
        .when(turn == 13, F.concat(F.lit('"open|'), "c_mktsegment"))
        .otherwise(F.concat(F.lit("ok|"), "c_mktsegment"))
    )
    line = F.concat(
        F.col("c_custkey").cast("string"), F.lit("|"), "c_name", F.lit("|"), tail,
        F.when(turn == 15, "\r").otherwise(""),
    )
    return table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("file"),
        F.lit(None).cast("bigint").alias("file_size"),
        F.lit(0).cast("bigint").alias("block"),
        F.col("c_custkey").alias("seq"),
        line.alias("value"),
    )


def _count(value: str, piece: str) -> str:
    return f"(length({value}) - length(replace({value}, {piece}, '')))"


_WIDTH = _count("value", "','") + " + 1"
_PIPES = _count("value", "'|'") + " + 1"


@query(
    "line_counts",
    f"WITH {DOCS_SQL} SELECT file, count(*) AS row_count FROM lines GROUP BY file",
)
def line_counts(spark, folder):
    return structure.row_counts(doc_lines(spark, folder))


@query(
    "file_summary",
    f"""WITH {DOCS_SQL} SELECT l.file, max(strlen(d.text)) AS bytes, count(*) AS row_count,
      max({_WIDTH}) AS column_count, count(*) FILTER (WHERE contains(value, chr(0))) AS null_byte_lines,
      round(max(strlen(d.text)) / count(*), 4) AS avg_row_bytes
    FROM lines l JOIN documents d ON d.doc_id = l.file GROUP BY l.file""",
)
def file_summary(spark, folder):
    out = structure.file_summary(doc_lines(spark, folder), ",")
    return out.withColumn("avg_row_bytes", F.round("avg_row_bytes", 4))


@query(
    "row_width",
    f"""WITH {DOCS_SQL} SELECT file, min({_WIDTH}) AS min_columns, max({_WIDTH}) AS max_columns,
      min({_WIDTH}) = max({_WIDTH}) AS consistent FROM lines GROUP BY file""",
)
def row_width(spark, folder):
    return structure.column_counts(doc_lines(spark, folder), ",")


@query(
    "row_width_distribution",
    f"WITH {RENDERED_LINES_SQL} SELECT file, {_PIPES} AS columns, count(*) AS lines FROM lines GROUP BY ALL",
)
def row_width_distribution(spark, folder):
    return structure.column_count_distribution(rendered_lines(spark, folder), "|")


@query(
    "line_lengths",
    f"""WITH {PAGES_SQL} SELECT file, min(length(value)) AS shortest, max(length(value)) AS longest,
      CAST(sum(strlen(value)) AS BIGINT) AS line_bytes FROM lines GROUP BY file""",
)
def line_lengths(spark, folder):
    value = F.col("value")
    return page_lines(spark, folder).groupBy("file").agg(
        F.min(F.char_length(value)).cast("bigint").alias("shortest"),
        F.max(F.char_length(value)).cast("bigint").alias("longest"),
        F.sum(F.octet_length(value)).alias("line_bytes"),
    )


@query(
    "ragged_rows",
    f"""WITH {DOCS_SQL}, widths AS (SELECT file, seq + 1 AS line_no, {_WIDTH} AS columns FROM lines),
    firsts AS (SELECT file, columns AS expected FROM widths WHERE line_no = 1)
    SELECT file, line_no, columns, expected FROM widths JOIN firsts USING (file) WHERE columns <> expected""",
)
def ragged_rows(spark, folder):
    return structure.ragged_rows(doc_lines(spark, folder), ",")


_PROBLEMS = """
problems AS (
  SELECT file, seq, 'too_few' AS kind, columns AS measure FROM measured WHERE columns < expected
  UNION ALL SELECT file, seq, 'too_many', columns FROM measured WHERE columns > expected
  UNION ALL SELECT file, seq, 'very_long', length(value) FROM measured WHERE length(value) > {long}
  UNION ALL SELECT file, seq, 'null_byte', {nulls} FROM measured WHERE contains(value, chr(0))
)"""


def _problems_sql(lines: str, width: str, expected: str, long: int) -> str:
    return f"""WITH {lines}, measured AS (SELECT *, {width} AS columns, {expected} AS expected FROM lines),
    {_PROBLEMS.format(long=long, nulls=_count("value", "chr(0)"))}"""


@query(
    "problem_rows",
    _problems_sql(DOCS_SQL, _WIDTH, "2", 1000)
    + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY file, kind ORDER BY seq) AS rn FROM problems)
    SELECT file, kind, seq + 1 AS line_no, measure FROM ranked WHERE rn <= 10""",
)
def problem_rows(spark, folder):
    return structure.problem_rows(doc_lines(spark, folder), ",", expected=2, samples=10, long_line=1000)


@query(
    "problem_counts",
    _problems_sql(DOCS_SQL, _WIDTH, "2", 1000)
    + "SELECT kind, count(*) AS rows, count(DISTINCT file) AS files FROM problems GROUP BY kind",
)
def problem_counts(spark, folder):
    return structure.problem_counts(doc_lines(spark, folder), ",", expected=2, long_line=1000)


_FLAGS = """count(*) FILTER (WHERE contains(value, chr(0))) AS null_byte_lines,
  count(*) FILTER (WHERE regexp_matches(value, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]')) AS control_lines,
  count(*) FILTER (WHERE strlen(value) <> length(value)) AS high_byte_lines, CAST(0 AS BIGINT) AS invalid_utf8_lines"""


@query("special_chars", f"WITH {DOCS_SQL} SELECT file, {_FLAGS} FROM lines GROUP BY file")
def special_chars(spark, folder):
    return structure.special_characters(doc_lines(spark, folder))


@query("special_chars_planted", f"WITH {RENDERED_LINES_SQL} SELECT file, {_FLAGS} FROM lines GROUP BY file")
def special_chars_planted(spark, folder):
    return structure.special_characters(rendered_lines(spark, folder))


_QUOTES = f"""count(*) FILTER (WHERE {_count("value", "chr(34)")} % 2 <> 0) AS odd_quote_lines,
  count(*) FILTER (WHERE contains(value, chr(92) || chr(34)) OR contains(value, chr(92) || chr(39))) AS escaped_quote_lines"""


@query("quote_check", f"WITH {PAGES_SQL} SELECT file, {_QUOTES} FROM lines GROUP BY file")
def quote_check(spark, folder):
    return structure.quote_check(page_lines(spark, folder))


@query("quote_check_planted", f"WITH {RENDERED_LINES_SQL} SELECT file, {_QUOTES} FROM lines GROUP BY file")
def quote_check_planted(spark, folder):
    return structure.quote_check(rendered_lines(spark, folder))


@query(
    "line_endings",
    f"""WITH {RENDERED_LINES_SQL},
    counts AS (SELECT file, count(*) FILTER (WHERE ends_with(value, chr(13))) AS crlf,
      count(*) FILTER (WHERE NOT ends_with(value, chr(13))) AS lf,
      CAST(sum({_count("value", "chr(13)")}) AS BIGINT) - count(*) FILTER (WHERE ends_with(value, chr(13))) AS cr
      FROM lines GROUP BY file)
    SELECT *, CASE WHEN crlf > 0 AND lf > 0 THEN 'Mixed' WHEN crlf > 0 THEN 'CRLF' WHEN lf > 0 THEN 'LF'
      WHEN cr > 0 THEN 'CR' ELSE 'None' END AS line_ending FROM counts""",
)
def line_endings(spark, folder):
    return structure.line_endings(rendered_lines(spark, folder))


@query(
    "line_endings_text",
    f"""SELECT doc_id AS file, {_count("text", "chr(13) || chr(10)")} // 2 AS crlf,
      {_count("text", "chr(10)")} - {_count("text", "chr(13) || chr(10)")} // 2 AS lf,
      {_count("text", "chr(13)")} - {_count("text", "chr(13) || chr(10)")} // 2 AS cr,
      CASE WHEN contains(text, chr(13) || chr(10)) AND {_count("text", "chr(10)")} > {_count("text", "chr(13) || chr(10)")} // 2 THEN 'Mixed'
        WHEN contains(text, chr(13) || chr(10)) THEN 'CRLF' WHEN contains(text, chr(10)) THEN 'LF'
        WHEN contains(text, chr(13)) THEN 'CR' ELSE 'None' END AS line_ending
    FROM documents WHERE length(text) > 0""",
)
def line_endings_text(spark, folder):
    return structure.line_endings(doc_lines(spark, folder))


@query(
    "encoding_evidence",
    f"""WITH {DOCS_SQL} SELECT file, CASE WHEN min(value) FILTER (WHERE seq = 0) LIKE chr(65279) || '%' THEN 'UTF-8' END AS bom,
      CAST(0 AS BIGINT) AS invalid_lines, true AS valid_utf8 FROM lines GROUP BY file""",
)
def encoding_evidence(spark, folder):
    return structure.encoding_evidence(doc_lines(spark, folder))


_DELIMITERS = (("','", 0, 1.2), ("chr(9)", 1, 1.2), ("'|'", 2, 1.0), ("';'", 3, 1.0), ("':'", 4, 1.0))


def _scores_sql(lines: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT file, {d} AS delimiter, {r} AS rank, {b} AS bonus, {_count('value', d)} AS c FROM lines"
        for d, r, b in _DELIMITERS
    )
    return f"""WITH {lines}, counts AS ({parts}),
    scored AS (
      SELECT file, delimiter, rank, count(*) AS lines, min(c) AS min_count, avg(c) AS mean_count, var_pop(c) AS variance,
             1.0 / (1 + var_pop(c)) * max(bonus) AS score
      FROM counts GROUP BY file, delimiter, rank HAVING min(c) > 0)"""


@query(
    "delimiter_scores",
    _scores_sql(DOCS_SQL)
    + """SELECT file, delimiter, CAST(rank AS BIGINT) AS rank, lines, min_count, round(mean_count, 6) AS mean_count,
    round(variance, 6) AS variance, round(score, 6) AS score FROM scored""",
)
def delimiter_scores(spark, folder):
    out = sniff.delimiter_scores(doc_lines(spark, folder), sample_lines=None)
    return out.withColumn("rank", F.col("rank").cast("bigint")).withColumns(
        {c: F.round(c, 6) for c in ("mean_count", "variance", "score")}
    )


@query(
    "delimiter_detected",
    _scores_sql(DOCS_SQL)
    + """, best AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY round(score, 9) DESC, rank) AS rn FROM scored)
    SELECT file, delimiter, round(least(score, 1.0), 6) AS confidence FROM best WHERE rn = 1""",
)
def delimiter_detected(spark, folder):
    out = sniff.detect_delimiter(doc_lines(spark, folder))
    return out.withColumn("confidence", F.round("confidence", 6))


@query(
    "delimiter_valid",
    f"""WITH {RENDERED_LINES_SQL}, counts AS (SELECT file, {_count("value", "'|'")} AS c FROM lines)
    SELECT file, min(c) AS min_count, round(avg(c), 6) AS mean_count, round(var_pop(c), 6) AS variance,
      min(c) > 0 AND var_pop(c) < avg(c) AS valid FROM counts GROUP BY file""",
)
def delimiter_valid(spark, folder):
    out = sniff.validate_delimiter(rendered_lines(spark, folder), "|", sample_lines=None)
    return out.select(
        "file",
        F.col("min_count").cast("bigint").alias("min_count"),
        F.round("mean_count", 6).alias("mean_count"),
        F.round("variance", 6).alias("variance"),
        "valid",
    )


_NUMBER = "^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$"


@query(
    "header_tests",
    f"""WITH {DOCS_SQL}, heads AS (SELECT file, string_split(trim(value, chr(32) || chr(9) || chr(10) || chr(13)), ',') AS f, value FROM lines WHERE seq = 0)
    SELECT file, len(trim(value)) > 0 AND len(list_filter(f, lambda x: NOT regexp_matches(trim(x), '{_NUMBER}'))) > 0 AS any_text,
      len(list_filter(f[1:5], lambda x: regexp_matches(x, '^[0-9]'))) = 0 AS names_first,
      len(trim(value)) > 0 AND (len(list_filter(f, lambda x: NOT regexp_matches(replace(replace(trim(x), '.', ''), '-', ''), '^[0-9]+$'))) > len(f) * 0.7
        OR len(list_filter(f, lambda x: regexp_matches(lower(x), 'id|name|date|time|count|amount|value|type|status|description'))) > 2) AS mostly_text
    FROM heads""",
)
def header_tests(spark, folder):
    return sniff.header_tests(doc_lines(spark, folder), ",", quote=None)


@query(
    "format_detected",
    _scores_sql(DOCS_SQL)
    + """, best AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY round(score, 9) DESC, rank) AS rn FROM scored)
    SELECT l.file, CASE WHEN b.delimiter = chr(9) THEN 'TSV' ELSE 'CSV' END AS format, coalesce(b.delimiter, ',') AS delimiter,
      round(CASE WHEN b.score IS NULL THEN 0.3 ELSE least(b.score, 1.0) END, 6) AS confidence, CASE WHEN b.delimiter IS NULL THEN 'fallback' ELSE 'content' END AS method
    FROM (SELECT DISTINCT file FROM lines) l LEFT JOIN best b ON b.file = l.file AND b.rn = 1""",
)
def format_detected(spark, folder):
    out = sniff.detect_format(doc_lines(spark, folder))
    return out.select("file", "format", "delimiter", F.round("confidence", 6).alias("confidence"), "method")


@query(
    "first_lines",
    f"WITH {DOCS_SQL} SELECT file, value AS first_line FROM lines WHERE seq = 0",
)
def first_lines_of(spark, folder):
    return first_lines(doc_lines(spark, folder))


@query(
    "head_lines",
    f"WITH {DOCS_SQL} SELECT file, seq + 1 AS line_no, value FROM lines WHERE seq < 5",
)
def head_lines_of(spark, folder):
    out = head_lines(doc_lines(spark, folder), 5)
    return out.select("file", F.col("line_no").cast("bigint").alias("line_no"), "value")


@query(
    "clean_rows",
    f"""WITH {RENDERED_LINES_SQL} SELECT file, value FROM lines WHERE {_PIPES} = 4 AND NOT contains(value, chr(0))""",
)
def clean_rows(spark, folder):
    out = structure.clean_lines(rendered_lines(spark, folder), "|", expected=4)
    return out.filter("keep").select("file", "value")


@query(
    "clean_rows_first_line",
    f"""WITH {DOCS_SQL}, widths AS (SELECT file, seq, {_WIDTH} AS w, contains(value, chr(0)) AS nul FROM lines),
    firsts AS (SELECT file, w AS expected FROM widths WHERE seq = 0)
    SELECT file, count(*) AS lines, count(*) FILTER (WHERE w = expected AND NOT nul) AS kept FROM widths JOIN firsts USING (file) GROUP BY file""",
)
def clean_rows_first_line(spark, folder):
    out = structure.clean_lines(doc_lines(spark, folder), ",")
    return out.groupBy("file").agg(F.count("*").alias("lines"), F.count(F.when(F.col("keep"), 1)).alias("kept"))


_FIRST_DELIMITER = f"""CASE WHEN {_count("first_line", "chr(9)")} > greatest({_count("first_line", "','")}, {_count("first_line", "'|'")}) THEN chr(9)
  WHEN {_count("first_line", "','")} > {_count("first_line", "'|'")} THEN ',' WHEN {_count("first_line", "'|'")} > 0 THEN '|' ELSE chr(9) END"""


@query(
    "file_characteristics",
    f"""WITH {DOCS_SQL}, firsts AS (SELECT file, value AS first_line FROM lines WHERE seq = 0),
    seps AS (SELECT file, {_FIRST_DELIMITER} AS delimiter FROM firsts)
    SELECT l.file, s.delimiter, count(*) AS line_count, max(strlen(d.text)) AS bytes,
      min({_count("value", "s.delimiter")} + 1) AS min_columns, max({_count("value", "s.delimiter")} + 1) AS max_columns,
      min({_count("value", "s.delimiter")} + 1) FILTER (WHERE seq = 0) AS first_line_columns,
      CASE WHEN bool_or(strlen(value) <> length(value)) THEN 'utf-8' ELSE 'ascii' END AS encoding
    FROM lines l JOIN seps s USING (file) JOIN documents d ON d.doc_id = l.file GROUP BY l.file, s.delimiter""",
)
def file_characteristics(spark, folder):
    return structure.file_characteristics(doc_lines(spark, folder)).select(
        "file", "delimiter", "line_count", "bytes", "min_columns", "max_columns", "first_line_columns", "encoding"
    )


@query(
    "structure_compare",
    f"""WITH {DOCS_SQL}, firsts AS (SELECT file, value AS first_line FROM lines WHERE seq = 0),
    seps AS (SELECT file, {_FIRST_DELIMITER} AS delimiter FROM firsts),
    profile AS (
      SELECT l.file, d.source, s.delimiter, count(*) AS line_count, max(strlen(d.text)) AS bytes,
        max({_count("value", "s.delimiter")} + 1) AS max_columns,
        CASE WHEN bool_or(strlen(value) <> length(value)) THEN 'utf-8' ELSE 'ascii' END AS encoding,
        CASE WHEN contains(d.text, chr(10)) THEN 'LF' ELSE 'None' END AS line_ending
      FROM lines l JOIN seps s USING (file) JOIN documents d ON d.doc_id = l.file GROUP BY ALL),
    pairs AS (
      SELECT file AS second_file, source, lag(file) OVER w AS first_file,
        abs(lag(bytes) OVER w - bytes) / greatest(lag(bytes) OVER w, 0.1 * 1048576) * 100 AS size_pct,
        abs(lag(line_count) OVER w - line_count) / greatest(lag(line_count) OVER w, 1) * 100 AS line_pct,
        lag(encoding) OVER w <> encoding AS e, lag(line_ending) OVER w <> line_ending AS le,
        lag(max_columns) OVER w <> max_columns AS mc, lag(delimiter) OVER w <> delimiter AS dl
      FROM profile WINDOW w AS (PARTITION BY source ORDER BY file))
    SELECT source, first_file, second_file, round(size_pct, 1) AS size_diff_pct, round(line_pct, 1) AS line_diff_pct,
      concat_ws(',', CASE WHEN size_pct > 10 THEN 'size' END, CASE WHEN e THEN 'encoding' END, CASE WHEN le THEN 'line_ending' END,
        CASE WHEN mc THEN 'column_count' END, CASE WHEN dl THEN 'delimiter' END) AS differences,
      NOT (size_pct > 10 OR e OR le OR mc OR dl) AS compatible
    FROM pairs WHERE first_file IS NOT NULL""",
)
def structure_compare(spark, folder):
    profile = structure.file_characteristics(doc_lines(spark, folder))
    sources = table(spark, folder, "documents").select(F.col("doc_id").alias("file"), "source")
    out = structure.compare_consecutive(profile.join(sources, "file"), group="source", order="file")
    return out.select(
        "source", "first_file", "second_file", "size_diff_pct", "line_diff_pct",
        F.concat_ws(",", "differences").alias("differences"), "compatible",
    )


RENDERED = Contract(
    "customer_{month}.txt", "customer", ("c_custkey", "c_name", "note", "c_mktsegment"), delimiter="|", quote_char=None
)


@query(
    "contract_alignment",
    f"""WITH {RENDERED_LINES_SQL} SELECT file, {_PIPES} AS actual_columns, CAST(4 AS BIGINT) AS expected_columns,
      {_PIPES} = 4 AS aligned FROM lines WHERE seq = 0""",
)
def contract_alignment(spark, folder):
    return structure.contract_alignment(rendered_lines(spark, folder), RENDERED)


@query(
    "locate_value",
    f"""WITH {RENDERED_LINES_SQL}, cells AS (SELECT file, unnest(string_split(value, '|')) AS cell,
      unnest(range(1, len(string_split(value, '|')) + 1)) AS position FROM lines)
    SELECT file, position, count(*) AS cells, CASE position WHEN 1 THEN 'c_custkey' WHEN 2 THEN 'c_name' WHEN 3 THEN 'note'
      WHEN 4 THEN 'c_mktsegment' END AS column_name FROM cells WHERE contains(cell, 'MACHINERY') GROUP BY file, position""",
)
def locate_value(spark, folder):
    return structure.locate_value(rendered_lines(spark, folder), RENDERED, "MACHINERY")


@query(
    "modal_date_format",
    """WITH cells AS (
      SELECT o_orderpriority AS file, 0 AS position, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d')
        WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%m/%d/%Y') END AS cell FROM orders
      UNION ALL SELECT o_orderpriority, 1, CAST(o_orderkey AS VARCHAR) FROM orders),
    kinds AS (SELECT file, position, CASE WHEN regexp_matches(cell, '^[0-9]{8}$') THEN 'YYYYMMDD'
        WHEN length(cell) = 10 AND contains(cell, '-') THEN 'YYYY-MM-DD' WHEN contains(cell, '/') THEN 'MM/DD/YYYY' ELSE 'Other' END AS spelling,
        count(*) AS cells FROM cells GROUP BY ALL)
    SELECT file, CAST(position AS BIGINT) AS position, spelling, cells FROM kinds
    QUALIFY row_number() OVER (PARTITION BY file, position ORDER BY cells DESC, spelling DESC) = 1""",
)
def modal_date_format(spark, folder):
    turn = F.col("o_orderkey") % 3
    day = (
        F.when(turn == 0, F.date_format("o_orderdate", "yyyyMMdd"))
        .when(turn == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    )
    lines = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("file"), F.concat_ws("\t", day, F.col("o_orderkey").cast("string")).alias("value")
    )
    out = structure.modal_date_format(lines, "\t")
    return out.withColumn("position", F.col("position").cast("bigint"))
