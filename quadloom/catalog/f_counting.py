"""Counts and size statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom.catalog.common import CONTAINS, EVENTS, LOG, query, u
from quadloom.model import edge_fact, value_fact, wide_to_facts
from quadloom.operators import checks, counting, roots, sketches
from quadloom.plans.cut import written
from quadloom.plans.pages import PAGE_SIZE
from quadloom.sources.tables import Graph, uid_of

TENANTS = 5
# Five tenants that use the same subjects: order k is node k div 5 of tenant k mod 5.
FACTS = f"""facts AS (
    SELECT cast(o_orderkey % {TENANTS} AS BIGINT) AS namespace, {u('Order', f'o_orderkey // {TENANTS}')} AS subject, unnest(['o_orderstatus', 'o_totalprice', 'o_orderpriority', 'placed_by']) AS predicate,
      unnest([o_orderstatus, cast(o_totalprice AS VARCHAR), o_orderpriority, NULL]) AS value,
      unnest([NULL, NULL, NULL, {u('Customer', 'o_custkey')}]) AS object_uid FROM orders
    UNION ALL SELECT DISTINCT cast(l_orderkey % {TENANTS} AS BIGINT), {u('Order', f'l_orderkey // {TENANTS}')}, 'contains', NULL, {u('Part', 'l_partkey')} FROM lineitem)"""


def tenant(key: str):
    return (F.col(key) % TENANTS).cast("long")


def shared(type_name: str, key: str):
    return uid_of(type_name, F.call_function("div", F.col(key).cast("long"), F.lit(TENANTS).cast("long")))


def order_facts(g: Graph):
    orders = g.orders().withColumn("ns", tenant("o_orderkey")).withColumn("uid", shared("Order", "o_orderkey"))
    values = {c: (c, t) for c, t in (("o_orderstatus", "string"), ("o_totalprice", "float"), ("o_orderpriority", "string"))}
    return wide_to_facts(orders, "uid", values, {"placed_by": "placed_by"}, namespace="ns")


def contains_facts(g: Graph, distinct: bool = True):
    pairs = g.raw("lineitem").select("l_orderkey", "l_partkey")
    pairs = pairs.distinct() if distinct else pairs
    return edge_fact(pairs, shared("Order", "l_orderkey"), "contains", uid_of("Part", "l_partkey"), namespace=tenant("l_orderkey"))


def facts(g: Graph):
    return order_facts(g).unionByName(contains_facts(g))


@query("f01_len", "SELECT count(DISTINCT l_suppkey) AS len FROM lineitem WHERE l_discount > 0.05")
def length(g: Graph):
    v = g.raw("lineitem").where("l_discount > 0.05").select(F.col("l_suppkey").alias("uid"))
    return counting.size_of(v)


@query(
    "f02_out_counts",
    f"""WITH {EVENTS} SELECT {u('Customer', 'c_custkey')} AS uid, count(DISTINCT event_id) AS n FROM customer LEFT JOIN ev ON user_id = c_custkey GROUP BY c_custkey""",
)
def out_counts(g: Graph):
    did = g.events().select(F.col("user").alias("src"), F.col("uid").alias("dst"))
    return counting.out_counts(g.customer().select("uid"), did)


@query(
    "f03_in_counts",
    f"""SELECT {u('Part', 'p_partkey')} AS uid, count(DISTINCT l_orderkey) AS n FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey""",
)
def in_counts(g: Graph):
    edges = g.raw("lineitem").select((F.lit(6 << 40) + F.col("l_orderkey")).alias("src"), (F.lit(5 << 40) + F.col("l_partkey")).alias("dst"))
    return counting.in_counts(g.part().select("uid"), edges)


@query(
    "f04_count_index",
    f"""WITH {CONTAINS} SELECT src AS uid, count(*) AS cnt FROM contains GROUP BY src HAVING count(*) >= 6""",
)
def count_index(g: Graph):
    edges = g.raw("lineitem").select((F.lit(6 << 40) + F.col("l_orderkey")).alias("src"), (F.lit(5 << 40) + F.col("l_partkey")).alias("dst"))
    return counting.with_count(edges, "ge", 6)


@query(
    "f05_uids_per_predicate",
    f"""WITH {FACTS} SELECT namespace, predicate, count(DISTINCT subject) AS num_uids FROM facts GROUP BY ALL""",
)
def uids_per_predicate(g: Graph):
    return counting.uids_per_predicate(facts(g))


SPAN, AFTER, UNTIL = 100, 199, 799


@query(
    "f05_sketches",
    f"""WITH {LOG} SELECT namespace, predicate, count(*) AS rows, cast(sum(coalesce(strlen(value), 8)) AS BIGINT) AS bytes, true AS nodes_ok, true AS median_ok
    FROM log WHERE commit_ts > {AFTER} AND commit_ts <= {UNTIL} GROUP BY ALL""",
)
def stored_sketches(g: Graph):
    """A range of commits from stored sketches: rows and bytes are exact, distinct nodes and the
    median within the errors that are promised, against the facts themselves."""
    stored = written(sketches.build(g.log(), SPAN), "sketches")
    asked = sketches.merged(stored, SPAN, AFTER, UNTIL).select(
        "namespace", "predicate", "rows", "bytes", sketches.node_count().alias("about"), sketches.quantile(0.5).alias("middle"))
    facts_ = g.log().where((F.col("commit_ts") > AFTER) & (F.col("commit_ts") <= UNTIL)).withColumn("x", F.col("value").cast("double"))
    rank = facts_.join(asked, ["namespace", "predicate"]).groupBy("namespace", "predicate").agg(
        F.first("rows").alias("rows"), F.first("bytes").alias("bytes"), F.first("about").alias("about"), F.count_distinct("subject").alias("nodes"),
        F.avg((F.col("x") < F.col("middle")).cast("double")).alias("below"), F.avg((F.col("x") <= F.col("middle")).cast("double")).alias("up_to"))
    error = sketches.RANK_ERROR
    return rank.select(
        "namespace", "predicate", "rows", "bytes", (F.abs(F.col("about") - F.col("nodes")) <= F.greatest(F.lit(1.0), F.col("nodes") * sketches.NODE_ERROR)).alias("nodes_ok"),
        ((F.col("below") <= 0.5 + error) & (F.col("up_to") >= 0.5 - error)).alias("median_ok"),
    )


@query(
    "f06_predicate_sizes",
    f"""WITH {FACTS} SELECT predicate, count(*) AS rows, cast(sum(coalesce(strlen(value), 8)) AS BIGINT) AS bytes FROM facts GROUP BY predicate""",
)
def predicate_sizes(g: Graph):
    return counting.predicate_sizes(facts(g), per_tenant=False)


@query(
    "f06_tenant_sizes",
    f"""WITH {FACTS} SELECT namespace, predicate, count(*) AS rows, cast(sum(coalesce(strlen(value), 8)) AS BIGINT) AS bytes FROM facts GROUP BY ALL""",
)
def tenant_sizes(g: Graph):
    return counting.predicate_sizes(facts(g))


# Edges order node -> part of five tenants, and every node in every tenant.
TENANT_EDGES = f"""edges AS (SELECT DISTINCT cast(l_orderkey % {TENANTS} AS BIGINT) AS namespace, {u('Order', f'l_orderkey // {TENANTS}')} AS src, {u('Part', 'l_partkey')} AS dst FROM lineitem)"""
EVERY = f"(SELECT unnest(range({TENANTS}))::BIGINT AS namespace)"


def tenant_edges(g: Graph):
    return g.raw("lineitem").select(tenant("l_orderkey").alias("namespace"), shared("Order", "l_orderkey").alias("src"), uid_of("Part", "l_partkey").alias("dst"))


def in_every_tenant(nodes):
    return nodes.withColumn("namespace", F.explode(F.array(*[F.lit(i).cast("long") for i in range(TENANTS)])))


@query(
    "f02_tenant_counts",
    f"""WITH {TENANT_EDGES}, nodes AS (SELECT namespace, uid FROM (SELECT DISTINCT src AS uid FROM edges), {EVERY}), parts AS (SELECT namespace, {u('Part', 'p_partkey')} AS uid FROM part, {EVERY})
    SELECT 'out' AS kind, n.namespace, uid, count(dst) AS n FROM nodes n LEFT JOIN edges e ON e.namespace = n.namespace AND src = uid GROUP BY ALL
    UNION ALL SELECT 'in', p.namespace, uid, count(src) FROM parts p LEFT JOIN edges e ON e.namespace = p.namespace AND dst = uid GROUP BY ALL
    UNION ALL SELECT 'index', namespace, src, count(*) FROM edges GROUP BY ALL""",
)
def tenant_counts(g: Graph):
    """Edges out of and into the same nodes, tenant by tenant."""
    edges = tenant_edges(g)
    nodes = in_every_tenant(edges.select(F.col("src").alias("uid")).distinct())
    rows = counting.out_counts(nodes, edges).select(F.lit("out").alias("kind"), "namespace", "uid", "n")
    rows = rows.unionByName(counting.in_counts(in_every_tenant(g.part().select("uid")), edges).select(F.lit("in").alias("kind"), "namespace", "uid", "n"))
    return rows.unionByName(counting.count_index(edges).select(F.lit("index").alias("kind"), "namespace", "uid", F.col("cnt").alias("n")))


@query(
    "e14_tenant_edges",
    f"""WITH {TENANT_EDGES}, parts AS (SELECT namespace, {u('Part', 'p_partkey')} AS uid FROM part, {EVERY})
    SELECT EXISTS (SELECT 1 FROM edges e WHERE e.namespace = p.namespace AND e.dst = p.uid) AS linked, namespace, uid FROM parts p
    UNION ALL SELECT NULL, namespace, src FROM edges WHERE dst % 2 = 0 AND namespace = 0""",
)
def tenant_links(g: Graph):
    """Parts with and without an order in each tenant; edges whose target one tenant has deleted."""
    edges, parts = tenant_edges(g), in_every_tenant(g.part().select("uid"))
    linked = roots.has_edge(parts, edges, reverse=True).select(F.lit(True).alias("linked"), "namespace", "uid")
    free = roots.lacks_edge(parts, edges, reverse=True).select(F.lit(False).alias("linked"), "namespace", "uid")
    left = parts.where("namespace <> 0 or uid % 2 <> 0")
    broken = checks.dangling(edges.distinct(), left).select(F.lit(None).cast("boolean").alias("linked"), "namespace", F.col("src").alias("uid"))
    return linked.unionByName(free).unionByName(broken)


@query(
    "m03_tenant_keys",
    f"""WITH b AS (SELECT cast(user_id % {TENANTS} AS BIGINT) AS namespace, event_type AS email FROM events), s AS (SELECT DISTINCT 0::BIGINT AS namespace, 'click' AS email UNION ALL SELECT 3, 'view')
    SELECT namespace, email, count(*) AS n, (namespace, email) IN (SELECT (namespace, email) FROM s) AS known FROM b GROUP BY ALL HAVING count(*) > 1""",
)
def tenant_keys(g: Graph):
    """The same keys in five tenants; one tenant knows one of them, another one another."""
    events = g.raw("events").select(tenant("user_id").alias("namespace"), F.col("event_type").alias("email"))
    known = events.where("namespace = 0 and email = 'click' or namespace = 3 and email = 'view'").distinct()
    return checks.repeated_keys(events, "email", known)


def _postings(name: str, page_size: int):
    @query(
        name,
        f"""WITH {FACTS}, p AS (SELECT *, (row_number() OVER (PARTITION BY namespace, predicate, subject ORDER BY object_uid, value) - 1) // {page_size} AS page FROM facts)
        SELECT namespace, predicate, subject, page, string_agg(coalesce(object_uid::VARCHAR, value), ' ' ORDER BY object_uid, value) AS postings FROM p GROUP BY ALL""",
    )
    def run(g: Graph):
        rows = counting.posting_lists(order_facts(g).unionByName(contains_facts(g, distinct=False)), page_size)
        return rows.select("namespace", "predicate", "subject", "page", F.array_join("postings", " ").alias("postings"))

    return run


_postings("f07_posting_lists", PAGE_SIZE)
_postings("f07_posting_pages", 6)


@query(
    "f08_observed_types",
    f"""WITH {FACTS}, {LOG},
    all_facts AS (SELECT namespace, predicate, subject, value, object_uid FROM facts UNION ALL SELECT namespace, predicate, subject, value, NULL FROM log
      UNION ALL SELECT p_partkey % {TENANTS}, 'p_size', p_partkey // {TENANTS}, p_size::VARCHAR, NULL FROM part
      UNION ALL SELECT p_partkey % {TENANTS}, 'p_large', p_partkey // {TENANTS}, CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END, NULL FROM part
      UNION ALL SELECT p_partkey % {TENANTS}, 'p_seen', p_partkey // {TENANTS}, '2024-05-01T10:00:' || lpad((p_size % 60)::VARCHAR, 2, '0') || 'Z', NULL FROM part),
    per AS (SELECT namespace, predicate, count(*) AS n, bool_and(object_uid IS NOT NULL) AS is_uid,
      bool_and(regexp_full_match(value, '-?[0-9]+')) AS is_int, bool_and(try_cast(value AS DOUBLE) IS NOT NULL) AS is_float,
      bool_and(value IN ('true', 'false')) AS is_bool, bool_and(starts_with(value, '2024-05-01T')) AS is_time
      FROM all_facts GROUP BY namespace, predicate, subject)
    SELECT namespace, predicate, cast(sum(n) AS BIGINT) AS rows, CASE WHEN bool_and(is_uid) THEN 'uid' WHEN bool_and(is_int) THEN 'int'
      WHEN bool_and(is_float) THEN 'float' WHEN bool_and(is_bool) THEN 'bool' WHEN bool_and(is_time) THEN 'dateTime' ELSE 'string' END AS observed,
      CASE WHEN max(n) > 1 THEN 'LIST' ELSE 'SINGLE' END AS hint FROM per GROUP BY namespace, predicate""",
)
def observed_types(g: Graph):
    from quadloom.model import FACT_COLUMNS

    rows = facts(g).unionByName(g.log().select(*FACT_COLUMNS))
    node = F.call_function("div", F.col("p_partkey").cast("long"), F.lit(TENANTS).cast("long"))
    seen = F.concat(F.lit("2024-05-01T10:00:"), F.lpad((F.col("p_size") % 60).cast("string"), 2, "0"), F.lit("Z"))
    for name, value, kind in (("p_size", F.col("p_size"), "int"), ("p_large", F.col("p_size") > 25, "bool"), ("p_seen", seen, "dateTime")):
        rows = rows.unionByName(value_fact(g.raw("part"), node, name, value, kind, namespace=tenant("p_partkey")))
    return counting.observed_types(rows).select("namespace", "predicate", "rows", "observed", "hint")
