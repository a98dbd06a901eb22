"""Filters and string scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.functions import dates
from loadlens.functions.text import glob_match, percent, strip, truncate_text
from loadlens.queries import query, table


@query(
    "raw_range_filter",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS cell FROM orders
    WHERE strftime(o_orderdate, '%Y%m%d') BETWEEN '19960301' AND '19960331'""",
)
def raw_range_filter(spark, folder):
    text = table(spark, folder, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("cell"))
    return text.filter(dates.raw_between("cell", "19960301", "19960331"))


@query(
    "parsed_range_filter",
    """SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-15'""",
)
def parsed_range_filter(spark, folder):
    events = table(spark, folder, "events")
    return events.filter(dates.date_between(events, "ts", "2024-01-05", "2024-01-14")).select("event_id", "user_id")


@query(
    "glob_filter",
    "SELECT c_custkey, c_name FROM customer WHERE c_name GLOB 'Customer#*[13]?7'",
)
def glob_filter(spark, folder):
    names = table(spark, folder, "customer").select("c_custkey", "c_name")
    return names.filter(glob_match(F.col("c_name"), "Customer#*[13]?7"))


@query(
    "string_scalars",
    """SELECT p_partkey, trim(chr(9) || p_name || '  ', ' ' || chr(9)) AS stripped, upper(p_name) AS upper_name,
      lower(p_brand) AS lower_brand, replace(p_name, ' ', '_') AS replaced, starts_with(p_brand, 'Brand#1') AS starts,
      contains(p_name, 'ring') AS has_ring, split_part(p_name, ' ', 1) AS first_word, regexp_extract(p_brand, '([0-9]+)', 1) AS digits,
      regexp_replace(p_type, '[AEIOU]', '', 'g') AS consonants, length(p_name) AS chars,
      CASE WHEN length(p_name) > 5 THEN left(p_name, 5) || '...' ELSE p_name END AS short
    FROM part""",
)
def string_scalars(spark, folder):
    name, brand = F.col("p_name"), F.col("p_brand")
    return table(spark, folder, "part").select(
        "p_partkey",
        strip(F.concat(F.lit("\t"), name, F.lit("  "))).alias("stripped"),
        F.upper(name).alias("upper_name"),
        F.lower(brand).alias("lower_brand"),
        F.replace(name, F.lit(" "), F.lit("_")).alias("replaced"),
        F.startswith(brand, F.lit("Brand#1")).alias("starts"),
        F.contains(name, F.lit("ring")).alias("has_ring"),
        F.split_part(name, F.lit(" "), F.lit(1)).alias("first_word"),
        F.regexp_extract(brand, "([0-9]+)", 1).alias("digits"),
        F.regexp_replace("p_type", "[AEIOU]", "").alias("consonants"),
        F.char_length(name).cast("bigint").alias("chars"),
        truncate_text(name, 5).alias("short"),
    )


@query(
    "share_of_total",
    """SELECT event_type, count(*) AS n, CAST(round(CAST(count(*) / (SELECT count(*) FROM events) * 100 AS DECIMAL(38, 10)), 1) AS DOUBLE) AS pct
    FROM events GROUP BY event_type""",
)
def share_of_total(spark, folder):
    events = table(spark, folder, "events")
    total = events.agg(F.count("*")).scalar()
    return events.groupBy("event_type").agg(F.count("*").alias("n")).withColumn("pct", percent(F.col("n"), total))
