"""Root functions, filters and parameters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quadloom.catalog.common import EVENTS, query, u
from quadloom.catalog.c_mutations import TENANTS, tenant_facts
from quadloom.operators import roots
from quadloom.sources.tables import Graph, key_of


@query("d01_eq", f"SELECT {u('Customer', 'c_custkey')} AS uid, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def eq(g: Graph):
    return g.customer().where(roots.compare("c_mktsegment", "eq", "BUILDING")).select("uid", "c_name")


@query(
    "d02_uid",
    f"""SELECT {u('Part', 'p_partkey')} AS uid, p_name FROM part
    WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)
       OR {u('Part', 'p_partkey')} = 5497558138881""",
)
def by_uid(g: Graph):
    bulk = g.raw("lineitem").where("l_quantity >= 49")
    variable = bulk.select((F.lit(5 << 40) + F.col("l_partkey")).alias("uid"))
    by_variable = roots.by_uid(g.part(), variable)
    by_literal = roots.by_uid(g.part(), [key_of("Part", (5 << 40) + 1)], key="p_partkey")
    return by_variable.unionByName(by_literal).select("uid", "p_name").distinct()


@query(
    "d03_type",
    f"""SELECT {u('Supplier', 's_suppkey')} AS uid, s_name AS name FROM supplier""",
)
def of_type(g: Graph):
    nodes = (
        g.customer().select("uid", F.col("c_name").alias("name"), F.array(F.lit("Customer"), F.lit("Party")).alias("labels"))
        .unionByName(g.supplier().select("uid", F.col("s_name").alias("name"), F.array(F.lit("Supplier"), F.lit("Party")).alias("labels")))
        .unionByName(g.part().select("uid", F.col("p_name").alias("name"), F.array(F.lit("Part")).alias("labels")))
    )
    return roots.of_type(nodes, "Supplier").select("uid", "name")


@query(
    "d04_has",
    f"""SELECT 0::BIGINT AS namespace, {u('Document', 'doc_id')} AS uid FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
    UNION ALL SELECT c_custkey % {TENANTS}, {u('Customer', f'c_custkey // {TENANTS}')} FROM customer WHERE c_acctbal IS NOT NULL
    UNION ALL SELECT 0, {u('Supplier', 's_suppkey')} FROM supplier WHERE s_acctbal IS NOT NULL""",
)
def has(g: Graph):
    labelled = g.raw("labels").select((F.lit(7 << 40) + F.col("doc_id")).alias("src"), F.col("quality").alias("dst"))
    zero = F.lit(0).cast("long").alias("namespace")
    with_edge = roots.has_edge(g.documents(), labelled).select(zero, "uid")
    with_value = roots.subjects_with(tenant_facts(g), "c_acctbal")
    wide = roots.has_value(g.supplier(), "s_acctbal").select(zero, "uid")
    return with_edge.unionByName(with_value).unionByName(wide)


@query(
    "d05_compare",
    f"""SELECT {u('Order', 'o_orderkey')} AS uid, o_totalprice FROM orders
    WHERE o_orderdate < TIMESTAMP '1997-03-15' AND o_totalprice >= 100000""",
)
def compare(g: Graph):
    rows = g.orders().where(roots.compare("o_orderdate", "lt", dt.datetime(1997, 3, 15)))
    return rows.where(roots.compare("o_totalprice", "ge", 100000.0)).select("uid", "o_totalprice")


@query(
    "d06_filter_root",
    f"""SELECT {u('Part', 'p_partkey')} AS uid, p_name, p_size FROM part WHERE p_type = 'ECONOMY' AND p_size = 11""",
)
def filter_root(g: Graph):
    return g.part().where(roots.compare("p_type", "eq", "ECONOMY")).where(roots.compare("p_size", "eq", 11)).select("uid", "p_name", "p_size")


@query(
    "d07_filter_edge",
    f"""SELECT {u('Customer', 'c_custkey')} AS uid, c_name, {u('Order', 'o_orderkey')} AS order_uid, o_totalprice AS order_price
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT'""",
)
def filter_edge(g: Graph):
    from quadloom.operators.traverse import expand

    orders = g.orders().select("uid", "placed_by", F.col("o_totalprice").alias("price"), "o_orderpriority")
    edges = orders.select(F.col("placed_by").alias("src"), F.col("uid").alias("dst"))
    rows = expand(
        g.customer().select("uid", "c_name"), edges, orders.drop("placed_by"),
        where=F.col("o_orderpriority") == "1-URGENT", keep_childless=True, prefix="order_",
    )
    return rows.select("uid", "c_name", "order_uid", "order_price")


@query(
    "d08_filter_tree",
    f"""SELECT {u('Part', 'p_partkey')} AS uid, p_brand, p_size FROM part
    WHERE (p_size < 10 OR p_brand = 'Brand#2') AND NOT (p_type = 'ECONOMY' OR p_retailprice > 950)""",
)
def filter_tree(g: Graph):
    tree = ("and", [
        ("or", [F.col("p_size") < 10, F.col("p_brand") == "Brand#2"]),
        ("not", ("or", [F.col("p_type") == "ECONOMY", F.col("p_retailprice") > 950])),
    ])
    return g.part().where(roots.filter_tree(tree)).select("uid", "p_brand", "p_size")


@query(
    "d09_parameters",
    """SELECT o_orderkey, o_orderpriority, 'string' AS status_type, 'int' AS floor_type, '[F,P]' AS status_text
    FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_custkey >= 20""",
)
def parameters(g: Graph):
    declared = roots.declare(statuses=["F", "P"], floor=20)
    rows = roots.with_parameters(
        g.spark,
        "SELECT o_orderkey, o_orderpriority FROM {orders} WHERE array_contains(:statuses, o_orderstatus) AND o_custkey >= :floor",
        {"statuses": F.array(F.lit("F"), F.lit("P")), "floor": 20},
        orders=g.raw("orders"),
    )
    return rows.select(
        "*",
        F.lit(declared["$statuses"][0]).alias("status_type"),
        F.lit(declared["$floor"][0]).alias("floor_type"),
        F.lit(declared["$statuses"][1]).alias("status_text"),
    )


@query(
    "d10_regexp",
    f"""SELECT {u('Part', 'p_partkey')} AS uid, p_name, pattern FROM part, (VALUES
      ('/^RED/i', '(?i)^RED'), ('(ring|widget)$', '(ring|widget)$'), ('/l{{2}}\\s+.*t/sU', '(?s)l{{2}}\\s+.*t')) AS t(pattern, re)
    WHERE regexp_matches(p_name, re)""",
)
def regexp(g: Graph):
    valid, rejected = roots.split_patterns(
        g.spark, ["/^RED/i", "(ring|widget)$", r"/l{2}\s+.*t/sU", "/(unclosed/"]
    )
    assert rejected == ["/(unclosed/"]
    return roots.match_patterns(g.part().select("uid", "p_name"), "p_name", valid)


@query(
    "d11_allow_list",
    f"""WITH {EVENTS}, allow AS (SELECT user_id % 5 AS ns, event_type FROM ev GROUP BY ALL
      HAVING count(*) FILTER (WHERE k < 10) * 10 >= count(*))
    SELECT uid, cast(user_id % 5 AS BIGINT) AS namespace, event_type FROM ev
    WHERE (user_id % 5, event_type) IN (SELECT (ns, event_type) FROM allow)""",
)
def allow_list(g: Graph):
    events = g.events().select("uid", (F.col("user_id") % 5).cast("long").alias("namespace"), "event_type", "k")
    counts = events.groupBy("namespace", "event_type").agg(
        F.count_if(F.col("k") < 10).alias("low"), F.count(F.lit(1)).alias("n")
    )
    allow = counts.where(F.col("low") * 10 >= F.col("n"))
    return roots.allowed(events.drop("k"), allow, ["namespace", "event_type"]).select("uid", "namespace", "event_type")
