"""Traversal: expansion, nesting, variables, wide and long forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom.catalog.common import CONTAINS, EVENTS, query, u
from quadloom.catalog.f_counting import TENANTS, order_facts, shared, tenant
from quadloom.model import value_fact
from quadloom.operators import reach, roots, sets, traverse
from quadloom.operators.traverse import TypeInfo
from quadloom.plans.pages import PAGE_SIZE, nest
from quadloom.sources.tables import Graph, uid_of


@query(
    "e00_nested_query",
    f"""WITH {CONTAINS},
    o AS (SELECT {u('Order', 'o_orderkey')} AS order_uid, * FROM orders WHERE o_orderpriority = '1-URGENT'),
    lines AS (SELECT src, string_agg(dst || '|' || cast(quantity AS BIGINT) || '|' || strftime(first_ship, '%Y-%m-%d'), ';' ORDER BY dst) AS txt
      FROM contains GROUP BY src),
    per AS (SELECT o_custkey, string_agg(strftime(o_orderdate, '%Y-%m-%d') || ' ' || order_uid || ' [' || coalesce(txt, '') || ']', ', '
        ORDER BY o_orderdate, order_uid) AS orders, count(*) AS n
      FROM o LEFT JOIN lines ON src = order_uid GROUP BY o_custkey)
    SELECT {u('Customer', 'c_custkey')} AS uid, c_name, 0::BIGINT AS page, coalesce(n, 0)::INTEGER AS n_orders, orders
    FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN per ON o_custkey = c_custkey
    WHERE n_name = (SELECT min(n_name) FROM nation)""",
)
def nested_query(g: Graph):
    """Root by nation name, reverse edge to customers, filtered and sorted orders, line
    facets on the nested parts; customers without urgent orders stay."""
    nation = g.nation().where(F.col("n_name") == g.nation().agg(F.min("n_name")).scalar())
    customers = g.customer().join(
        nation.select(F.col("uid").alias("in_nation")), "in_nation", "left_semi"
    ).select("uid", "c_name")
    orders = (
        g.orders()
        .where(F.col("o_orderpriority") == "1-URGENT")
        .join(customers.select(F.col("uid").alias("placed_by")), "placed_by", "left_semi")
        .select("placed_by", F.col("uid").alias("order_uid"), "o_orderdate")
    )
    edges = g.contains().join(orders.select(F.col("order_uid").alias("src")), "src", "left_semi")
    lines = nest(
        edges.select("src", "dst", "quantity", F.date_format("first_ship", "yyyy-MM-dd").alias("shipped")),
        ["src"], ["dst"],
        F.concat_ws("|", F.col("dst").cast("string"), F.col("quantity").cast("long").cast("string"), "shipped"),
        "lines", keep=True,
    )
    nested = orders.join(lines.withColumnRenamed("page", "lines_page"), F.col("src") == F.col("order_uid"), "left")
    per_customer = nest(
        nested.select("placed_by", "o_orderdate", "order_uid", F.coalesce("lines_page", F.lit(0)).alias("lines_page"), "lines"),
        ["placed_by"], ["o_orderdate", "order_uid", "lines_page"],
        F.concat(
            F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "), F.col("order_uid").cast("string"), F.lit(" ["),
            F.coalesce(F.array_join("lines", ";"), F.lit("")), F.lit("]"),
        ),
        "orders", keep=True,
    )
    out = customers.join(per_customer, customers["uid"] == per_customer["placed_by"], "left")
    return out.select(
        "uid", "c_name", F.coalesce("page", F.lit(0)).cast("long").alias("page"),
        F.coalesce(F.size("orders"), F.lit(0)).alias("n_orders"), F.array_join("orders", ", ").alias("orders"),
    )


@query(
    "e01_expand",
    f"""SELECT {u('Order', 'o_orderkey')} AS uid, {u('Customer', 'c_custkey')} AS customer_uid, c_name AS customer_name, o_totalprice
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def expand(g: Graph):
    orders = g.orders()
    edges = orders.select(F.col("uid").alias("src"), F.col("placed_by").alias("dst"))
    customers = g.customer().select("uid", F.col("c_name").alias("name"))
    return traverse.expand(orders.select("uid", "o_totalprice"), edges, customers, prefix="customer_").select(
        "uid", "customer_uid", "customer_name", "o_totalprice"
    )


@query(
    "e02_reverse",
    f"""SELECT {u('Nation', 'n_nationkey')} AS uid, n_name, {u('Customer', 'c_custkey')} AS customer_uid
    FROM nation JOIN customer ON c_nationkey = n_nationkey""",
)
def reverse(g: Graph):
    customers = g.customer()
    in_nation = customers.select(F.col("uid").alias("src"), F.col("in_nation").alias("dst"))
    back = traverse.reverse(in_nation)
    return traverse.expand(g.nation().select("uid", "n_name"), back, customers.select("uid"), prefix="customer_")


@query(
    "e03_nested_path",
    f"""SELECT r_name, n_name, {u('Customer', 'c_custkey')} AS customer, {u('Order', 'o_orderkey')} AS order_uid
    FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey""",
)
def nested_path(g: Graph):
    regions = g.region().select(F.col("uid").alias("in_region"), "r_name")
    nations = g.nation().select(F.col("uid").alias("in_nation"), "in_region", "n_name")
    customers = g.customer().select(F.col("uid").alias("placed_by"), "in_nation")
    orders = g.orders().select(F.col("uid").alias("order_uid"), "placed_by")
    rows = traverse.follow_path(orders, [("placed_by", customers), ("in_nation", nations), ("in_region", regions)])
    return rows.select("r_name", "n_name", F.col("placed_by").alias("customer"), "order_uid")


CUSTOMER_UID, NATION_UID, ORDER_UID = u("Customer", "c_custkey"), u("Nation", "n_nationkey"), u("Order", "o_orderkey")
NAMED = """'{{"{0}":"' || {0} || '"}}'"""
EXPANDED = {
    "": ("NULL", CUSTOMER_UID, "Customer", NAMED.format("c_name"), "customer"),
    "in_nation": (CUSTOMER_UID, NATION_UID, "Nation", NAMED.format("n_name"), "customer JOIN nation ON n_nationkey = c_nationkey"),
    "in_nation.~in_nation": (NATION_UID, u("Supplier", "s_suppkey"), "Supplier", NAMED.format("s_name"),
                             "customer JOIN nation ON n_nationkey = c_nationkey JOIN supplier ON s_nationkey = n_nationkey"),
    "in_nation.in_region": (NATION_UID, u("Region", "r_regionkey"), "Region", NAMED.format("r_name"),
                            "customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"),
    "~placed_by": (CUSTOMER_UID, ORDER_UID, "Order", NAMED.format("o_orderstatus"), "customer JOIN orders ON o_custkey = c_custkey"),
    "~placed_by.contains": (ORDER_UID, u("Part", "p_partkey"), "Part", NAMED.format("p_brand"),
                            "customer JOIN orders ON o_custkey = c_custkey JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey"),
    "~placed_by.placed_by": (ORDER_UID, CUSTOMER_UID, "Customer", NAMED.format("c_name"), "customer JOIN orders ON o_custkey = c_custkey"),
    "did": (CUSTOMER_UID, u("Event", "event_id"), "Event", NAMED.format("event_type"), "customer JOIN events ON user_id = c_custkey"),
}


@query(
    "e04_expand_all",
    " UNION ALL ".join(
        f"SELECT {CUSTOMER_UID} AS root, '{path}' AS path, cast({parent} AS BIGINT) AS parent, {uid} AS uid, '{name}' AS type, {fields} AS fields FROM {rows}"
        for path, (parent, uid, name, fields, rows) in EXPANDED.items()
    ),
)
def expand_all(g: Graph):
    """Customers, two hops: single, list and reverse edges side by side."""
    return traverse.expand_all(two_hops(g), "Customer", 2)


def two_hops(g: Graph) -> dict[str, TypeInfo]:
    customers, nations, orders, suppliers, events = g.customer(), g.nation(), g.orders(), g.supplier(), g.events()
    edge = lambda df, src, dst: df.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
    return {
        "Customer": TypeInfo(customers, ["c_name"], {
            "in_nation": (edge(customers, "uid", "in_nation"), "Nation"), "~placed_by": (edge(orders, "placed_by", "uid"), "Order"), "did": (edge(events, "user", "uid"), "Event")}),
        "Nation": TypeInfo(nations, ["n_name"], {
            "~in_nation": (edge(suppliers, "in_nation", "uid"), "Supplier"), "in_region": (edge(nations, "uid", "in_region"), "Region")}),
        "Order": TypeInfo(orders, ["o_orderstatus"], {
            "contains": (g.contains_pairs(), "Part"), "placed_by": (edge(orders, "uid", "placed_by"), "Customer")}),
        "Supplier": TypeInfo(suppliers, ["s_name"]), "Region": TypeInfo(g.region(), ["r_name"]), "Part": TypeInfo(g.part(), ["p_brand"]), "Event": TypeInfo(events, ["event_type"]),
    }


#: (type, key, edges to: predicate, target type, target key, rows) of a graph in which every edge can be followed both ways.
BOTH_WAYS = [
    ("Nation", "n_nationkey", "in_region", "Region", "n_regionkey", "nation"), ("Customer", "c_custkey", "in_nation", "Nation", "c_nationkey", "customer"),
    ("Supplier", "s_suppkey", "in_nation", "Nation", "s_nationkey", "supplier"), ("Order", "o_orderkey", "placed_by", "Customer", "o_custkey", "orders"),
    ("Part", "l_partkey", "supplied_by", "Supplier", "l_suppkey", "lineitem"),
]
NAMES = [("Region", "r_regionkey", "r_name", "region"), ("Nation", "n_nationkey", "n_name", "nation"), ("Customer", "c_custkey", "c_name", "customer"),
         ("Supplier", "s_suppkey", "s_name", "supplier"), ("Order", "o_orderkey", "o_orderstatus", "orders"), ("Part", "p_partkey", "p_brand", "part")]


def both_ways(g: Graph) -> dict[str, TypeInfo]:
    types = {name: TypeInfo(g.raw(rows).select(uid_of(name, k).alias("uid"), value), [value]) for name, k, value, rows in NAMES}
    for name, k, predicate, target, target_key, rows in BOTH_WAYS:
        edges = g.raw(rows).select(uid_of(name, k).alias("src"), uid_of(target, target_key).alias("dst"))
        types[name].edges[predicate] = (edges, target)
        types[target].edges[f"~{predicate}.{name}"] = (traverse.reverse(edges), name)
    return types


DEEPEST = 9
ANY_DEPTH = f"""WITH RECURSIVE e AS MATERIALIZED ({" UNION ".join(
    f"SELECT {u(a, k)} AS src, {u(b, t)} AS dst, '{p}' AS via FROM {rows} UNION SELECT {u(b, t)}, {u(a, k)}, '~{p}.{a}' FROM {rows}" for a, k, p, b, t, rows in BOTH_WAYS)}),
r AS (SELECT {u("Region", "r_regionkey")} AS root, {u("Region", "r_regionkey")} AS uid, 0 AS depth FROM region
  UNION SELECT root, dst, depth + 1 FROM r JOIN e ON src = uid WHERE depth < {DEEPEST}),
least AS (SELECT root, uid, min(depth) AS depth FROM r GROUP BY ALL),
nodes AS ({" UNION ALL ".join(f"SELECT {u(t, k)} AS uid, '{t}' AS type, {NAMED.format(v)} AS fields FROM {rows}" for t, k, v, rows in NAMES)}),
parents AS (SELECT a.root, e.dst AS uid, min(struct_pack(parent := e.src, via := e.via)) AS b FROM least a JOIN e ON e.src = a.uid JOIN least c ON c.root = a.root AND c.uid = e.dst AND c.depth = a.depth + 1 GROUP BY ALL)
SELECT least.root, least.uid, least.depth, b.parent AS parent, b.via AS via, type, fields FROM least JOIN nodes USING (uid) LEFT JOIN parents ON parents.root = least.root AND parents.uid = least.uid"""


@query("e04_any_depth", ANY_DEPTH)
def any_depth(g: Graph):
    """Everything each region leads to, over edges in both directions: a graph full of cycles."""
    return reach.expand_to_any_depth(both_ways(g), "Region")


@query(
    "e05_has_one",
    f"""SELECT {u('Supplier', 's_suppkey')} AS uid, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def has_one(g: Graph):
    nations = g.nation().select(F.col("uid").alias("nation_uid"), "n_name")
    return traverse.follow(g.supplier(), "in_nation", nations, "nation_uid", "left").select("uid", "s_name", "n_name")


def _has_many(name: str, page_size: int):
    @query(
        name,
        f"""WITH {CONTAINS}, p AS (SELECT *, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // {page_size} AS page FROM contains)
        SELECT src AS uid, page, count(*)::INTEGER AS n, string_agg(dst::VARCHAR, ' ' ORDER BY dst) AS parts FROM p GROUP BY src, page""",
    )
    def run(g: Graph):
        parts = traverse.uid_matrix(g.order_parts(), page_size)
        return parts.select(
            F.col("src").alias("uid"), "page", F.size("uids").alias("n"),
            F.array_join(F.col("uids").cast("array<string>"), " ").alias("parts"),
        )

    return run


_has_many("e06_has_many", PAGE_SIZE)
_has_many("e06_has_many_pages", 3)


@query(
    "e07_missing_block",
    f"""SELECT {u('Customer', 'c_custkey')} AS uid, c_name, 0::BIGINT AS page, max(CASE WHEN o_totalprice > 400000 THEN 1 ELSE 0 END) = 1 AS has_big,
      CASE WHEN count(*) FILTER (WHERE o_totalprice > 400000) > 0 THEN
        '{{"c_name":"' || c_name || '","big":[' || string_agg({u('Order', 'o_orderkey')}, ',' ORDER BY o_orderkey) FILTER (WHERE o_totalprice > 400000) || ']}}'
      ELSE '{{"c_name":"' || c_name || '"}}' END AS doc
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name""",
)
def missing_block(g: Graph):
    big = g.orders().where("o_totalprice > 400000").select("placed_by", F.col("uid").alias("big"))
    lists = nest(big, ["placed_by"], ["big"], F.col("big"), "big")
    customers = g.customer().select("uid", "c_name")
    rows = customers.join(lists, customers["uid"] == lists["placed_by"], "left")
    return rows.select(
        "uid", "c_name", F.coalesce("page", F.lit(0)).cast("long").alias("page"), F.col("big").isNotNull().alias("has_big"), F.to_json(F.struct("c_name", "big")).alias("doc")
    )


@query(
    "e08_nested_result",
    f"""SELECT {u('Nation', 'c_nationkey')} AS uid, page, count(*)::INTEGER AS n,
      '[' || string_agg('{{"uid":' || {u('Customer', 'c_custkey')} || ',"c_name":"' || c_name || '"}}', ',' ORDER BY c_custkey) || ']' AS customers
    FROM (SELECT *, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 5 AS page FROM customer) GROUP BY c_nationkey, page""",
)
def nested_result(g: Graph):
    children = g.customer().select("in_nation", "uid", "c_name")
    nested = nest(children, ["in_nation"], ["uid"], F.struct("uid", "c_name"), "customers", page_size=5)
    return nested.select(
        F.col("in_nation").alias("uid"), "page", F.size("customers").alias("n"), F.to_json("customers").alias("customers")
    )


@query(
    "e09_variable",
    f"""SELECT {u('Order', 'o_orderkey')} AS uid, o_totalprice FROM orders WHERE o_custkey IN
      (SELECT c_custkey FROM customer WHERE c_acctbal > 9000) AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def variable(g: Graph):
    rich = g.customer().where("c_acctbal > 9000").select("uid")
    returned = g.raw("lineitem").where("l_returnflag = 'R'").select((F.lit(6 << 40) + F.col("l_orderkey")).alias("uid"))
    rows = roots.by_uid(g.orders(), rich, key="placed_by")
    return roots.by_uid(rows, returned).select("uid", "o_totalprice")


@query(
    "e10_blocks",
    f"""SELECT 'suppliers' AS block, {u('Supplier', 's_suppkey')} AS uid, s_name AS name FROM supplier WHERE s_acctbal < 0
    UNION ALL SELECT 'customers', {u('Customer', 'c_custkey')}, c_name FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'regions', {u('Region', 'r_regionkey')}, r_name FROM region""",
)
def blocks(g: Graph):
    return sets.blocks({
        "suppliers": g.supplier().where("s_acctbal < 0").select("uid", F.col("s_name").alias("name")),
        "customers": g.customer().where("c_acctbal < 0").select("uid", F.col("c_name").alias("name")),
        "regions": g.region().select("uid", F.col("r_name").alias("name")),
    })


@query(
    "e11_long_to_wide",
    f"""SELECT cast(o_orderkey % {TENANTS} AS BIGINT) AS namespace, {u('Order', f'o_orderkey // {TENANTS}')} AS uid, o_orderstatus, o_totalprice, o_orderpriority, {u('Customer', 'o_custkey')} AS placed_by FROM orders""",
)
def long_to_wide(g: Graph):
    """Orders of five tenants that share subjects, each with a translated priority as well."""
    translated = value_fact(g.raw("orders"), shared("Order", "o_orderkey"), "o_orderpriority", F.lit("~"), "string", lang=F.lit("de"), namespace=tenant("o_orderkey"))
    return traverse.wide(
        order_facts(g).unionByName(translated),
        {"o_orderstatus": "string", "o_totalprice": "double", "o_orderpriority": "string"},
        ["placed_by"],
    )


@query(
    "e12_uid_matrix",
    f"""WITH e AS (SELECT DISTINCT {u('Part', 'l_partkey')} AS src, {u('Supplier', 'l_suppkey')} AS dst FROM lineitem)
    SELECT src, page, count(*)::INTEGER AS n, string_agg(dst::VARCHAR, ' ' ORDER BY dst) AS uids
    FROM (SELECT *, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // 4 AS page FROM e) GROUP BY src, page""",
)
def uid_matrix(g: Graph):
    rows = traverse.uid_matrix(g.part_suppliers(), page_size=4)
    return rows.select("src", "page", F.size("uids").alias("n"), F.array_join(F.col("uids").cast("array<string>"), " ").alias("uids"))


@query(
    "e13_value_matrix",
    f"""WITH {EVENTS}, p AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 4 AS page FROM ev)
    SELECT cast(user_id % {TENANTS} AS BIGINT) AS namespace, {u('Customer', f'user_id // {TENANTS}')} AS subject, page, string_agg(value::VARCHAR, ' ' ORDER BY event_id) AS vals FROM p GROUP BY user_id, page""",
)
def value_matrix(g: Graph):
    facts = g.events().select(
        tenant("user_id").alias("namespace"), shared("Customer", "user_id").alias("subject"), "event_id", F.col("value").cast("string").alias("value"))
    rows = traverse.value_matrix(facts, ["event_id"], F.col("value"), page_size=4)
    return rows.select("namespace", "subject", "page", F.array_join("values", " ").alias("vals"))


@query(
    "e14_semi_anti",
    f"""SELECT {u('Customer', 'c_custkey')} AS uid, c_custkey IN (SELECT o_custkey FROM orders) AS has_orders FROM customer""",
)
def semi_anti(g: Graph):
    edges = g.orders().select(F.col("placed_by").alias("dst"), F.col("uid").alias("src"))
    with_orders = roots.has_edge(g.customer(), edges, reverse=True).select("uid", F.lit(True).alias("has_orders"))
    without = roots.lacks_edge(g.customer(), edges, reverse=True).select("uid", F.lit(False).alias("has_orders"))
    return with_orders.unionByName(without)
