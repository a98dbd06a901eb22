"""Minimal keys of whole tables."""

from __future__ import annotations

from itertools import combinations

from loadlens.operators.keys import minimal_keys
from loadlens.queries import query, table

_LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
_EVENTS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _keys_sql(name: str, columns: list[str], most: int = 3) -> str:
    """Every set of columns counted, and of the unique ones those without a unique part."""
    sets = [s for size in range(1, most + 1) for s in combinations(columns, size)]
    counted = " UNION ALL ".join(
        f"SELECT {list(s)} AS cols, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(s)} FROM {name})) AS n" for s in sets
    )
    return f"""WITH counted AS ({counted}), uniq AS (SELECT cols FROM counted WHERE n = (SELECT count(*) FROM {name}))
    SELECT array_to_string(cols, ',') AS key_columns, len(cols) AS key_size FROM uniq u
    WHERE NOT EXISTS (SELECT 1 FROM uniq s WHERE len(s.cols) < len(u.cols) AND list_has_all(u.cols, s.cols))"""


@query("minimal_keys_lineitem", _keys_sql("lineitem", _LINEITEM))
def minimal_keys_lineitem(spark, folder):
    return minimal_keys(table(spark, folder, "lineitem").select(*_LINEITEM))


@query("minimal_keys_events", _keys_sql("events", _EVENTS))
def minimal_keys_events(spark, folder):
    return minimal_keys(table(spark, folder, "events").select(*_EVENTS))
