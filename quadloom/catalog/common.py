"""Registry of named queries and the SQL that checks them, plus shared SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quadloom.session import configure
from quadloom.sources.tables import TYPE_CODES, UID_SPAN, Graph

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of a `Graph` under `name`, with its checking SQL if any."""

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Graph(configure(spark), sf_dir))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def u(type_name: str, key: str) -> str:
    """SQL text of a uid."""
    return f"({TYPE_CODES[type_name] * UID_SPAN} + {key})"


def hexa(expr: str) -> str:
    """SQL text of a uid's hex form."""
    return f"('0x' || lower(to_hex(cast({expr} AS BIGINT))))"


K = "cast(json_extract_string(props, '$.k') AS INT)"

EVENTS = f"""ev AS (SELECT *, {K} AS k, {u('Event', 'event_id')} AS uid,
    {u('Customer', 'user_id')} AS cust FROM events)"""

LOG = f"""{EVENTS},
log AS (SELECT cast(user_id % 5 AS BIGINT) AS namespace, cust AS subject, event_type AS predicate,
    cast(value AS VARCHAR) AS value, k,
    CASE WHEN k % 10 = 0 THEN 'DEL' WHEN k % 10 = 1 THEN 'OVR' ELSE 'SET' END AS op,
    event_id AS seq, event_id AS start_ts, event_id + 1 AS commit_ts,
    k % 20 = 5 AS aborted FROM ev)"""

CONTAINS = f"""contains AS (SELECT {u('Order', 'l_orderkey')} AS src, {u('Part', 'l_partkey')} AS dst,
    sum(l_quantity) AS quantity, round(sum(l_extendedprice), 2) AS price, count(*) AS lines,
    min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey, l_partkey)"""


def state_sql(source: str, lists: tuple[str, ...] = ("click", "view"), stars: bool = True) -> str:
    """CTE `state`: what the log `source` leaves behind, by window functions. With `stars`,
    k = 0 is a star delete of the predicate and k = 50 a delete of the node."""
    names = ", ".join(f"'{x}'" for x in lists)
    kind = "WHEN k = 50 THEN 'node' WHEN k = 0 THEN 'star'" if stars else ""
    return f"""marked AS (SELECT *, CASE {kind} WHEN op = 'OVR' AND predicate IN ({names}) THEN 'over' END AS ending FROM {source}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY namespace, subject, predicate, CASE WHEN predicate IN ({names}) THEN value END
      ORDER BY commit_ts DESC) AS rn FROM marked WHERE ending IS NULL OR ending = 'over'),
    pe AS (SELECT namespace, subject, predicate, max(commit_ts) AS p_end FROM marked WHERE ending IN ('star', 'over') GROUP BY ALL),
    ne AS (SELECT namespace, subject, max(commit_ts) AS n_end FROM marked WHERE ending = 'node' GROUP BY ALL),
    state AS (SELECT r.* FROM ranked r LEFT JOIN pe USING (namespace, subject, predicate) LEFT JOIN ne USING (namespace, subject)
      WHERE rn = 1 AND op <> 'DEL' AND commit_ts >= coalesce(p_end, 0) AND commit_ts > coalesce(n_end, 0))"""
