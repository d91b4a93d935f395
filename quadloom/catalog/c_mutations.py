"""Mutations: applying change rows, deletes, upserts, conditions, save."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom.catalog.common import CONTAINS, LOG, query, state_sql, u
from quadloom.catalog.f_counting import TENANTS, shared, tenant
from quadloom.model import STAR, TYPE_PREDICATE, wide_to_facts
from quadloom.operators import identity, mutate
from quadloom.plans.cut import written
from quadloom.plans.semi import lacking
from quadloom.sources.tables import Graph

LISTS = ["click", "view"]
CUST, ORDER = u("Customer", "c_custkey"), u("Order", "o_orderkey")


def log_with_stars(g: Graph):
    """The event log with some deletes widened: k = 0 to a star delete of the predicate,
    k = 50 to a delete of the node."""
    k = F.try_element_at("facets", F.lit("k"))
    return (
        g.log()
        .withColumn("_k", k)
        .withColumn("predicate", F.when(F.col("_k") == "50", STAR).otherwise(F.col("predicate")))
        .withColumn("value", F.when(F.col("_k").isin("0", "50"), STAR).otherwise(F.col("value")))
        .drop("_k")
    )


def state_rows(facts):
    return facts.select("namespace", "subject", "predicate", "value", F.try_element_at("facets", F.lit("k")).cast("int").alias("k"))


@query("c01_apply_log", f"WITH {LOG}, {state_sql('log')} SELECT namespace, subject, predicate, value, k FROM state")
def apply_log(g: Graph):
    return state_rows(mutate.resolve(log_with_stars(g), LISTS))


@query(
    "c02_delete_edge",
    f"""WITH {CONTAINS} SELECT src, dst FROM contains WHERE (src, dst) NOT IN
      (SELECT ({u('Order', 'l_orderkey')}, {u('Part', 'l_partkey')}) FROM lineitem WHERE l_returnflag = 'R')""",
)
def delete_edge(g: Graph):
    gone = g.raw("lineitem").where("l_returnflag = 'R'").select(
        (F.lit(6 << 40) + F.col("l_orderkey")).alias("src"), (F.lit(5 << 40) + F.col("l_partkey")).alias("dst"))
    return mutate.delete_edges(g.contains_pairs(), gone)


CUSTOMER_FACTS = f"""cf AS (SELECT {CUST} AS subject, c_acctbal AS bal, unnest(['c_name', 'c_acctbal', 'c_mktsegment', 'in_nation']) AS predicate,
    unnest([c_name, c_acctbal::VARCHAR, c_mktsegment, NULL]) AS value, unnest([NULL, NULL, NULL, {u('Nation', 'c_nationkey')}]) AS object_uid FROM customer)"""


# Five tenants that use the same subjects: customer k is node k div 5 of tenant k mod 5.
TENANT_FACTS = f"""tf AS (SELECT cast(c_custkey % {TENANTS} AS BIGINT) AS namespace, {u('Customer', f'c_custkey // {TENANTS}')} AS subject, c_acctbal AS bal,
    unnest(['c_name', 'c_acctbal', 'in_nation']) AS predicate, unnest([c_name, c_acctbal::VARCHAR, NULL]) AS value, unnest([NULL, NULL, {u('Nation', 'c_nationkey')}]) AS object_uid FROM customer)"""


def tenant_customers(g: Graph):
    return g.customer().withColumn("namespace", tenant("c_custkey")).withColumn("uid", shared("Customer", "c_custkey"))


def tenant_facts(g: Graph):
    values = {"c_name": ("c_name", "string"), "c_acctbal": ("c_acctbal", "float")}
    return wide_to_facts(tenant_customers(g), "uid", values, {"in_nation": "in_nation"}, namespace="namespace")


@query(
    "c03_delete_star",
    f"""WITH {TENANT_FACTS} SELECT namespace, subject, predicate, value, object_uid FROM tf WHERE NOT (bal < 0 AND predicate IN ('c_acctbal', 'in_nation'))""",
)
def delete_star(g: Graph):
    stars = mutate.star_rows(tenant_customers(g).where("c_acctbal < 0"), ["c_acctbal", "in_nation"])
    return mutate.delete_predicates(tenant_facts(g), stars).select("namespace", "subject", "predicate", "value", "object_uid")


@query(
    "c04_delete_node",
    f"""WITH {TENANT_FACTS} SELECT namespace, subject, predicate, value, object_uid FROM tf
    WHERE (namespace, subject) IN (SELECT (o_custkey % {TENANTS}, {u('Customer', f'o_custkey // {TENANTS}')}) FROM orders WHERE o_orderstatus = 'F')""",
)
def delete_node(g: Graph):
    """Customers without any finished order are deleted."""
    finished = g.orders().where("o_orderstatus = 'F'").select(tenant("o_custkey").alias("namespace"), shared("Customer", "o_custkey").alias("uid"))
    gone = lacking(tenant_customers(g), finished, ["namespace", "uid"])
    return mutate.delete_nodes(tenant_facts(g), gone).select("namespace", "subject", "predicate", "value", "object_uid")


@query(
    "c05_drop_predicate",
    f"""WITH {CUSTOMER_FACTS} SELECT subject, predicate, value, object_uid FROM cf WHERE predicate <> 'c_mktsegment'""",
)
def drop_predicate(g: Graph):
    return mutate.drop_predicate(g.customer_facts(), "c_mktsegment").select("subject", "predicate", "value", "object_uid")


@query(
    "c06_set_delete",
    """WITH l AS (SELECT l_orderkey, l_linenumber, unnest(['l_discount', 'l_tax', 'line', 'late', 'l_returnflag']) AS predicate,
      unnest([l_discount::DECIMAL(10,2)::VARCHAR, l_tax::VARCHAR, (l_linenumber - 1)::VARCHAR, CASE WHEN l_linenumber > 2 THEN 'true' ELSE 'false' END, nullif(l_returnflag, 'N')]) AS v FROM lineitem),
    s AS (SELECT *, v IS NOT NULL AND v <> 'false' AND coalesce(try_cast(v AS DOUBLE) <> 0, true) AS stays FROM l)
    SELECT l_orderkey, l_linenumber, predicate, CASE WHEN stays THEN v END AS value, CASE WHEN stays THEN 'SET' ELSE 'DEL' END AS op FROM s""",
)
def set_delete(g: Graph):
    rows = g.raw("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_discount").cast("decimal(10,2)").alias("l_discount"), "l_tax", (F.col("l_linenumber") - 1).alias("line"),
        (F.col("l_linenumber") > 2).alias("late"), F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"))
    pair = mutate.set_and_delete(
        rows, ["l_orderkey", "l_linenumber"],
        {"l_discount": ("l_discount", "float"), "l_tax": ("l_tax", "float"), "line": ("line", "float"), "late": ("late", "bool"), "l_returnflag": ("l_returnflag", "string")},
        drop_defaults=True,
    )
    return pair.select("l_orderkey", "l_linenumber", "predicate", "value", "op")


@query(
    "c07_upsert",
    f"""WITH b AS (SELECT printf('Customer#%09d', user_id * 2) AS email, count(*) AS n FROM events GROUP BY 1)
    SELECT email, n, c_name IS NULL AS is_new, CASE WHEN c_name IS NULL THEN '_:' || substr(sha256(email), 1, 32)
      ELSE '0x' || lower(to_hex({CUST})) END AS uid FROM b LEFT JOIN customer ON c_name = email""",
)
def upsert(g: Graph):
    batch = (
        g.raw("events")
        .groupBy(F.format_string("Customer#%09d", F.col("user_id") * 2).alias("email"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    state = g.customer().select(F.col("c_name").alias("email"), "uid")
    return mutate.upsert(batch, state, "email").select("email", "n", "is_new", "uid")


@query(
    "c07_upsert_variables",
    f"""WITH {CUSTOMER_FACTS} SELECT subject, predicate, value, object_uid FROM cf WHERE NOT (predicate = 'c_mktsegment' AND bal < 0)
    UNION ALL SELECT {CUST}, 'standing', 'in debt', NULL FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT {CUST}, 'seat', NULL, {u('Nation', 'min(n_nationkey)')} FROM customer, nation WHERE c_acctbal < 0 GROUP BY c_custkey""",
)
def upsert_variables(g: Graph):
    """Mutation text over query variables: a star delete, a value and an edge for every
    customer in debt; a variable without nodes changes nothing."""
    from quadloom.sources import nquads

    texts = ['uid(debtor) <standing> "in debt" .', "uid(debtor) <seat> uid(first) .", 'uid(nobody) <standing> "?" .']
    sets = nquads.triples(nquads.parse(g.spark.createDataFrame([(t,) for t in texts], "value string")))
    dels = nquads.triples(nquads.parse(g.spark.createDataFrame([("uid(debtor) <c_mktsegment> * .",)], "value string")))
    changes = sets.withColumn("op", F.lit("SET")).unionByName(dels.withColumn("op", F.lit("DEL")))
    customers = g.customer()
    variables = {
        "debtor": customers.where("c_acctbal < 0").select("uid"),
        "first": g.nation().agg(F.min("uid").alias("uid")),
        "nobody": customers.where("c_acctbal IS NULL").select("uid"),
    }
    bound = mutate.bind(changes, variables)
    changes = written(mutate.changes_from(bound, commit_ts=1), "log")
    state = mutate.apply(g.dealt().customer_facts(), changes)
    return state.select("subject", "predicate", "value", "object_uid")


@query(
    "c08_conditional",
    f"""SELECT 'held' AS batch, {ORDER} AS subject FROM orders WHERE o_orderstatus = 'P'
      AND (SELECT count(*) FROM region) = 5 AND (SELECT count(DISTINCT n_regionkey) FROM nation) = 5
    UNION ALL SELECT 'failed', {ORDER} FROM orders WHERE o_orderstatus = 'F' AND (SELECT count(*) FROM region) = 4""",
)
def conditional(g: Graph):
    regions = g.region().select("uid")
    used = g.nation().select(F.col("in_region").alias("uid"))
    orders = g.orders()
    held = orders.where("o_orderstatus = 'P'").select(F.lit("held").alias("batch"), F.col("uid").alias("subject"))
    failed = orders.where("o_orderstatus = 'F'").select(F.lit("failed").alias("batch"), F.col("uid").alias("subject"))
    return mutate.apply_if(held, [(regions, "eq", 5), (used, "eq", 5)]).unionByName(
        mutate.apply_if(failed, [(regions, "eq", 4)])
    )


@query(
    "c09_batch",
    f"""WITH {LOG}, t AS (SELECT start_ts // 10 AS txn, bool_or(k >= 90) AS committed FROM log GROUP BY 1)
    SELECT txn, start_ts, predicate, value, committed FROM log JOIN t ON txn = start_ts // 10""",
)
def batch(g: Graph):
    """Ten requests per transaction; one that asks to commit commits them all."""
    k = F.try_element_at("facets", F.lit("k")).cast("int")
    rows = g.log().select(
        F.call_function("div", F.col("start_ts"), F.lit(10).cast("long")).alias("txn"), "start_ts", "predicate", "value", (k >= 90).alias("commit_now")
    )
    return mutate.commit_together(rows).select("txn", "start_ts", "predicate", "value", "committed")


@query(
    "c10_drop",
    f"""WITH {CUSTOMER_FACTS}, n AS (SELECT count(*) AS f, count(DISTINCT predicate) AS p, count(*) FILTER (WHERE predicate <> 'c_acctbal') AS fa FROM cf)
    SELECT 'ALL' AS kind, 0::BIGINT AS facts, 0::BIGINT AS predicates, 0::BIGINT AS types FROM n UNION ALL SELECT 'DATA', 0, p, p FROM n
    UNION ALL SELECT 'ATTR', fa, p - 1, p - 1 FROM n UNION ALL SELECT 'TYPE', f, p, 0 FROM n""",
)
def drop(g: Graph):
    facts = g.customer_facts()
    predicates = facts.select("predicate").distinct()
    types = predicates.select(F.lit("Customer").alias("type_name"), "predicate")
    out = None
    for kind, value in [("ALL", None), ("DATA", None), ("ATTR", "c_acctbal"), ("TYPE", "Customer")]:
        f, p, t = mutate.drop(facts, predicates, types, kind, value)
        parts = [df.select(F.lit(name).alias("part")) for name, df in (("facts", f), ("predicates", p), ("types", t))]
        row = parts[0].unionByName(parts[1]).unionByName(parts[2]).agg(
            *[F.count_if(F.col("part") == n).alias(n) for n in ("facts", "predicates", "types")]
        ).select(F.lit(kind).alias("kind"), "facts", "predicates", "types")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "c11_namespace",
    f"""SELECT 'kept' AS part, cast(n_regionkey AS BIGINT) AS namespace, {CUST} AS subject, c_name AS value FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 2
    UNION ALL SELECT 'scoped', cast(n_regionkey AS BIGINT), {CUST}, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 3""",
)
def namespace(g: Graph):
    regions = g.nation().select(F.col("uid").alias("in_nation"), F.col("n_regionkey").cast("long").alias("namespace"))
    facts = g.customer().join(regions, "in_nation").select("namespace", F.col("uid").alias("subject"), F.col("c_name").alias("value"))
    kept = mutate.delete_namespace(facts, 2).select(F.lit("kept").alias("part"), "namespace", "subject", "value")
    return kept.unionByName(mutate.in_namespace(facts, 3).select(F.lit("scoped").alias("part"), "namespace", "subject", "value"))


@query(
    "c12_save",
    f"""WITH {CUSTOMER_FACTS}, c AS (SELECT *, {CUST} AS old FROM customer),
    fresh AS (SELECT *, -9223372036854775807 + 999999 + row_number() OVER (ORDER BY sha256(c_name)) - 1 AS uid FROM c WHERE c_acctbal <= 0),
    saved AS (SELECT old AS uid, c_name, c_mktsegment FROM c WHERE c_acctbal > 0 UNION ALL SELECT uid, c_name, c_mktsegment FROM fresh)
    SELECT subject, predicate, value, object_uid FROM cf WHERE predicate IN ('c_acctbal', 'in_nation') OR (bal <= 0)
    UNION ALL SELECT uid, 'c_name', c_name, NULL FROM saved UNION ALL SELECT uid, 'node.type', 'Customer', NULL FROM saved
    UNION ALL SELECT uid, 'c_mktsegment', c_mktsegment, NULL FROM saved WHERE c_mktsegment <> 'BUILDING'""",
)
def save(g: Graph):
    """Customers in credit are saved onto their node, the others as new nodes with uids above
    2^63; a missing segment deletes the stored one."""
    from quadloom.functions import uid as uids

    g = g.dealt()
    entities = g.customer().select(
        F.when(F.col("c_acctbal") > 0, uids.to_text(F.col("uid"))).otherwise("").alias("uid"),
        "c_name",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
    )
    rows = mutate.save(
        entities, "c_name", {"c_name": ("c_name", "string"), "c_mktsegment": ("c_mktsegment", "string")},
        "Customer", TYPE_PREDICATE, drop_nulls=True,
    )
    assigned = identity.assign(identity.blank_labels(rows), first_uid=1_000_000 - 2**63)
    changes = written(mutate.changes_from(identity.propagate(rows, assigned), commit_ts=1), "log")
    state = mutate.apply(g.customer_facts(), changes, [TYPE_PREDICATE])
    return state.select("subject", "predicate", "value", "object_uid")


@query(
    "c13_type_labels",
    f"""SELECT {CUST} AS uid, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Customer' WHEN c_acctbal > 0 THEN c_mktsegment || ' Customer'
      ELSE 'Customer ' || c_mktsegment END AS labels FROM customer""",
)
def type_labels(g: Graph):
    segment = F.col("c_mktsegment")
    given = (
        F.when(segment == "BUILDING", F.lit(None).cast("array<string>"))
        .when(F.col("c_acctbal") > 0, F.array(segment, segment))
        .otherwise(F.array(F.lit("Customer"), segment, F.lit("Customer")))
    )
    return g.customer().select("uid", F.array_join(mutate.complete_labels(given, "Customer"), " ").alias("labels"))


@query(
    "c14_dropped_elements",
    f"""SELECT {ORDER} AS uid, o_orderpriority AS value, CASE WHEN o_orderstatus = 'F' THEN 'DEL' ELSE 'SET' END AS op FROM orders
    UNION ALL SELECT {ORDER}, o_orderstatus, 'SET' FROM orders""",
)
def dropped_elements(g: Graph):
    element = lambda value, flag: F.struct(value.alias("value"), flag.alias("drop"))
    rows = g.orders().select(
        "uid",
        F.array(
            element(F.col("o_orderpriority"), F.col("o_orderstatus") == "F"),
            element(F.col("o_orderstatus"), F.lit(False)),
            element(F.lit(None).cast("string"), F.lit(True)),
        ).alias("ways"),
    )
    return mutate.split_dropped(rows, "ways", ["uid"])
