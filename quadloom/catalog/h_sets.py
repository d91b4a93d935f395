"""Set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom.catalog.common import EVENTS, query, u
from quadloom.operators import sets, uid_sets
from quadloom.plans.cut import written
from quadloom.sources.tables import Graph, uid_of


def _rich(g: Graph):
    return g.customer().where("c_acctbal > 5000").select("uid")


def _urgent(g: Graph):
    return g.orders().where("o_orderpriority = '1-URGENT'").select(F.col("placed_by").alias("uid"))


SETS = f"""a AS (SELECT {u('Customer', 'c_custkey')} AS uid FROM customer WHERE c_acctbal > 5000),
    b AS (SELECT {u('Customer', 'o_custkey')} AS uid FROM orders WHERE o_orderpriority = '1-URGENT')"""


@query("h01_union", f"WITH {SETS} SELECT uid FROM a UNION SELECT uid FROM b")
def union(g: Graph):
    return sets.union(_rich(g), _urgent(g))


@query("h02_intersection", f"WITH {SETS} SELECT uid FROM a INTERSECT SELECT uid FROM b")
def intersection(g: Graph):
    return sets.intersection(_rich(g), _urgent(g))


@query("h03_difference", f"WITH {SETS} SELECT uid FROM a EXCEPT SELECT uid FROM b")
def difference(g: Graph):
    return sets.difference(_rich(g), _urgent(g))


@query(
    "h04_distinct",
    """SELECT p_brand, p_type, min(p_partkey) AS p_partkey FROM part GROUP BY p_brand, p_type""",
)
def distinct(g: Graph):
    rows = g.raw("part").select("p_brand", "p_type", "p_partkey")
    return sets.distinct_by(rows, ["p_brand", "p_type"], ["p_partkey"])


SEGMENTS = f"""seg AS (SELECT {u('Customer', 'c_custkey')} AS uid, * FROM customer),
    a AS (SELECT uid FROM seg WHERE c_acctbal > 5000), b AS (SELECT {u('Customer', 'o_custkey')} AS uid FROM orders WHERE o_orderpriority = '1-URGENT'),
    c AS (SELECT uid FROM seg WHERE c_mktsegment = 'BUILDING'), d AS (SELECT {u('Customer', 'user_id')} AS uid FROM events WHERE event_type = 'purchase')"""


def _stored(g: Graph) -> dict:
    """Four variables in their stored form."""
    variables = {
        "rich": _rich(g), "urgent": _urgent(g),
        "building": g.customer().where("c_mktsegment = 'BUILDING'").select("uid"),
        "buyer": g.raw("events").where("event_type = 'purchase'").select(uid_of("Customer", "user_id").alias("uid")),
    }
    return {name: written(uid_sets.compress(v), f"uids-{name}") for name, v in variables.items()}


@query(
    "h01_stored_counts",
    f"""WITH {SEGMENTS}, x AS (SELECT 'rich' AS name, uid FROM a UNION SELECT 'urgent', uid FROM b UNION SELECT 'building', uid FROM c
      UNION SELECT 'buyer', uid FROM d)
    SELECT name, 0::BIGINT AS namespace, count(*) AS uids, count(DISTINCT uid >> 6) AS words, count(*) / (count(DISTINCT uid >> 6) * 64) AS density
    FROM x GROUP BY name""",
)
def stored_counts(g: Graph):
    """Sizes of uid variables from their stored form, without a uid being read."""
    return sets.blocks({name: uid_sets.counts(s) for name, s in _stored(g).items()}).withColumnRenamed("block", "name")


@query(
    "h02_stored_tree",
    f"""WITH {SEGMENTS} SELECT 0::BIGINT AS namespace, uid FROM ((SELECT uid FROM a INTERSECT SELECT uid FROM b) UNION (SELECT uid FROM c EXCEPT SELECT uid FROM d))""",
)
def stored_tree(g: Graph):
    """(rich and urgent) or (building and not buyer), in one grouping of words."""
    tree = ("or", [("and", ["rich", "urgent"]), ("and", ["building", ("not", "buyer")])])
    return uid_sets.members(uid_sets.evaluate(_stored(g), tree))


@query(
    "h03_stored_changes",
    f"""WITH {EVENTS}, last AS (SELECT user_id % 5 AS namespace, cust AS uid, arg_max(event_type = 'purchase', event_id) AS added FROM ev
        WHERE event_type IN ('purchase', 'error') GROUP BY ALL),
    kept AS (SELECT DISTINCT user_id % 5 AS namespace, cust AS uid FROM ev WHERE event_type = 'view')
    SELECT namespace::BIGINT AS namespace, uid FROM (SELECT namespace, uid FROM last WHERE added UNION (SELECT * FROM kept EXCEPT SELECT namespace, uid FROM last WHERE NOT added))""",
)
def stored_changes(g: Graph):
    """Who has viewed, kept up by purchases (in) and errors (out) of five tenants."""
    events = g.raw("events").select(
        (F.col("user_id") % 5).alias("namespace"), uid_of("Customer", "user_id").alias("uid"), "event_type", F.col("event_id").alias("seq"),
    )
    viewed = written(uid_sets.compress(events.where("event_type = 'view'")), "uids-viewed")
    changes = events.where("event_type in ('purchase', 'error')").withColumn("added", F.col("event_type") == "purchase")
    return uid_sets.members(uid_sets.changed(viewed, changes))
