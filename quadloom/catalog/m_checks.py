"""Constraint checks: the rows that break a schema rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom.catalog.c_mutations import TENANTS, tenant_customers
from quadloom.catalog.common import LOG, query, u
from quadloom.model import FACT_COLUMNS, value_fact, wide_to_facts
from quadloom.operators import checks
from quadloom.sources.tables import Graph, uid_of

CUST, PART = u("Customer", "c_custkey"), u("Part", "p_partkey")


@query(
    "m01_unique",
    """SELECT cast(p_size % 3 AS BIGINT) AS namespace, p_name AS value, count(*) AS subjects FROM part GROUP BY ALL HAVING count(*) > 1""",
)
def unique(g: Graph):
    rows = value_fact(g.part(), F.col("uid"), "p_name", F.col("p_name"), "string", namespace=F.col("p_size") % 3)
    return checks.not_unique(rows, "p_name")


@query(
    "m02_not_null",
    f"""SELECT 'value' AS kind, cast(c_custkey % {TENANTS} AS BIGINT) AS namespace, {u('Customer', f'c_custkey // {TENANTS}')} AS uid FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT 'element', 0, {PART} FROM part WHERE p_type = 'ECONOMY'""",
)
def not_null(g: Graph):
    customers = tenant_customers(g).withColumn("segment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    facts = wide_to_facts(customers, "uid", {"segment": ("segment", "string"), "c_name": ("c_name", "string")}, namespace="namespace")
    values = checks.missing(customers, facts, "segment").select(F.lit("value").alias("kind"), "namespace", "uid")
    lists = g.part().select("uid", F.array("p_name", F.nullif("p_type", F.lit("ECONOMY"))).alias("items"))
    zero = F.lit(0).cast("long").alias("namespace")
    return values.unionByName(checks.null_elements(lists, "items").select(F.lit("element").alias("kind"), zero, "uid"))


@query(
    "m03_upsert_key",
    f"""SELECT printf('Customer#%09d', user_id * 2) AS email, count(*) AS n, printf('Customer#%09d', user_id * 2) IN (SELECT c_name FROM customer) AS known
    FROM events GROUP BY user_id HAVING count(*) > 1""",
)
def upsert_key(g: Graph):
    batch = g.raw("events").select(F.format_string("Customer#%09d", F.col("user_id") * 2).alias("email"))
    state = g.raw("customer").select(F.col("c_name").alias("email"))
    return checks.repeated_keys(batch, "email", state)


@query(
    "m04_single_value",
    f"""WITH {LOG} SELECT namespace, subject, predicate, count(DISTINCT value) AS n FROM log GROUP BY ALL HAVING count(DISTINCT value) > 1""",
)
def single_value(g: Graph):
    return checks.several_values(g.log().select(*FACT_COLUMNS)).select("namespace", "subject", "predicate", "n")


@query(
    "m05_value_type",
    f"""SELECT 0::BIGINT AS namespace, {CUST} AS subject, 'c_name' AS predicate, c_name AS value, 'int' AS declared FROM customer
    UNION ALL SELECT 0, {CUST}, 'c_acctbal', c_acctbal::VARCHAR, 'int' FROM customer
    UNION ALL SELECT 0, {CUST}, 'c_mktsegment', c_mktsegment, 'bool' FROM customer""",
)
def value_type(g: Graph):
    """Customer values against a schema that declares three of them wrongly."""
    facts = wide_to_facts(
        g.customer(), "uid",
        {c: (c, "string") for c in ("c_name", "c_acctbal", "c_mktsegment", "c_custkey")},
    )
    declared = {"c_name": "int", "c_acctbal": "int", "c_mktsegment": "bool", "c_custkey": "float"}
    return checks.wrong_type(facts, declared)


@query(
    "m06_dangling",
    f"""SELECT 'missing' AS kind, {u('Order', 'o_orderkey')} AS src, {u('Customer', 'o_custkey')} AS dst FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < 0
    UNION ALL SELECT 'wrong type', {CUST}, {u('Region', 'c_nationkey')} FROM customer""",
)
def dangling(g: Graph):
    """Orders of deleted customers, and customers whose nation edge ends at a region."""
    placed = g.orders().select(F.col("uid").alias("src"), F.col("placed_by").alias("dst"))
    missing = checks.dangling(placed, g.customer().where("c_acctbal >= 0"))
    crossed = g.customer().select(F.col("uid").alias("src"), uid_of("Region", "c_nationkey").alias("dst"))
    wrong = checks.dangling(crossed, g.nation())
    return missing.select(F.lit("missing").alias("kind"), "*").unionByName(wrong.select(F.lit("wrong type").alias("kind"), "*"))
