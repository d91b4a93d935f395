"""Uid text, order, blank labels and assignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom.catalog.common import hexa, query, u
from quadloom.functions import uid as uids
from quadloom.functions.uid import UID_PATTERN as GRAMMAR
from quadloom.operators import identity
from quadloom.sources import json_io
from quadloom.sources.tables import Graph

CUST = u("Customer", "c_custkey")

TEXTS = f"""texts AS (SELECT c_custkey, unnest(['<' || {hexa(CUST)} || '>', upper(to_hex({CUST})), '0x' || to_hex({CUST}),
    '_:' || 'Cust_' || c_custkey, '<_:c' || c_custkey || '>', '', '0x', '0xG' || c_custkey, '0x12345678901234567',
    '_:a-' || c_custkey, '<0x' || c_custkey, c_custkey || '>', '_:' || repeat('x', 33), '0x0']) AS t FROM customer)"""


def _texts(g: Graph):
    """Valid and broken uid texts made from every customer key."""
    key = F.col("c_custkey").cast("string")
    hexed = F.hex("uid")
    return g.customer().select(
        "c_custkey",
        F.explode(
            F.array(
                uids.in_nquad(uids.to_text(F.col("uid"))), hexed, F.concat(F.lit("0x"), hexed),
                F.concat(F.lit("_:Cust_"), key), F.concat(F.lit("<_:c"), key, F.lit(">")), F.lit(""), F.lit("0x"),
                F.concat(F.lit("0xG"), key), F.lit("0x12345678901234567"), F.concat(F.lit("_:a-"), key),
                F.concat(F.lit("<0x"), key), F.concat(key, F.lit(">")), F.concat(F.lit("_:"), F.repeat(F.lit("x"), 33)),
                F.lit("0x0"),
            )
        ).alias("t"),
    )


@query(
    "b01_classify",
    f"""WITH {TEXTS} SELECT c_custkey, t, CASE WHEN t = '' THEN 'empty' WHEN NOT regexp_matches(t, '{GRAMMAR}') THEN 'invalid'
      WHEN contains(t, '0x') THEN 'concrete' ELSE 'blank' END AS kind FROM texts""",
)
def classify(g: Graph):
    return _texts(g).select("c_custkey", "t", uids.classify(F.col("t")).alias("kind"))


@query(
    "b02_normalise",
    f"""WITH {TEXTS} SELECT c_custkey, t, CASE WHEN regexp_matches(t, '{GRAMMAR}') THEN lower(replace(replace(t, '<', ''), '>', '')) END AS uid FROM texts""",
)
def normalise(g: Graph):
    return _texts(g).select("c_custkey", "t", uids.normalise(F.col("t")).alias("uid"))


@query(
    "b03_hex",
    f"""SELECT {CUST} AS uid, {hexa(CUST)} AS text, '18446744073709551615' AS top, CAST(NULL AS VARCHAR) AS zero_uid, {CUST} AS back FROM customer
    UNION ALL SELECT {u('Order', 'o_orderkey')}, {hexa(u('Order', 'o_orderkey'))}, '18446744073709551615', NULL, {u('Order', 'o_orderkey')} FROM orders
    UNION ALL SELECT -1 - p_partkey, {hexa('-1 - p_partkey')}, '18446744073709551615', NULL, -1 - p_partkey FROM part""",
)
def hexadecimal(g: Graph):
    """Uids of both halves of the unsigned range: the last ones belong to parts."""
    last = g.raw("part").select((F.lit(-1) - F.col("p_partkey")).cast("long").alias("uid"))
    both = g.customer().select("uid").unionByName(g.orders().select("uid")).unionByName(last)
    return both.select(
        "uid",
        uids.to_text(F.col("uid")).alias("text"),
        uids.to_unsigned(F.lit("0xFFFFFFFFFFFFFFFF")).cast("string").alias("top"),
        F.coalesce(uids.to_text(F.lit(0)), uids.to_unsigned(F.lit("0x0")).cast("string"), uids.to_unsigned(F.lit("_:a")).cast("string")).alias("zero_uid"),
        uids.to_long(uids.in_nquad(uids.to_text(F.col("uid")))).alias("back"),
    )


@query(
    "b04_compare",
    f"""SELECT o_orderkey, '0x' || lower(to_hex(o_orderkey + 1)) < '0x' || lower(to_hex(o_custkey + 1)) AS text_less, o_orderkey < o_custkey AS number_less,
      true AS less_than_last FROM orders""",
)
def compare(g: Graph):
    a, b = uids.to_text(F.col("o_orderkey") + 1), uids.to_text(F.col("o_custkey") + 1)
    number = lambda text: uids.unsigned_order(uids.to_long(text))
    last = uids.to_text(F.lit(-1) - F.col("o_custkey"))
    return g.raw("orders").select(
        "o_orderkey", (a < b).alias("text_less"), (number(a) < number(b)).alias("number_less"), (number(a) < number(last)).alias("less_than_last"))


@query(
    "b05_blank_label",
    f"""SELECT c_custkey, '_:' || substr(sha256(c_name), 1, 32) AS uid FROM customer""",
)
def blank_label(g: Graph):
    rows = g.raw("customer").select("c_custkey", "c_name", F.lit("").alias("uid"))
    return identity.complete_blank(rows, "c_name").select("c_custkey", "uid")


def _blank_triples(g: Graph):
    """Orders and customers as a mutation names them: every node by a blank label."""
    label = lambda kind, key: F.concat(F.lit(f"_:{kind}"), F.col(key).cast("string"))
    null = F.lit(None).cast("string")
    empty = [null.alias("lang"), F.lit(None).cast("map<string,string>").alias("facets"), F.lit(False).alias("star")]
    orders = g.raw("orders")
    edges = orders.select(label("o", "o_orderkey").alias("subject"), F.lit("placed_by").alias("predicate"),
                          label("c", "o_custkey").alias("object"), null.alias("value"), F.lit("uid").alias("value_type"), *empty)
    values = orders.select(label("o", "o_orderkey").alias("subject"), F.lit("o_orderstatus").alias("predicate"), null.alias("object"),
                           F.col("o_orderstatus").alias("value"), F.lit("string").alias("value_type"), *empty)
    known = g.customer().select(uids.to_text(F.col("uid")).alias("subject"), F.lit("same_as").alias("predicate"),
                                label("c", "c_custkey").alias("object"), null.alias("value"), F.lit("uid").alias("value_type"), *empty)
    return edges.unionByName(values).unionByName(known)


LABELS = """labels_ AS (SELECT '_:o' || o_orderkey AS label FROM orders UNION SELECT '_:c' || c_custkey FROM customer),
    assigned AS (SELECT label, 1000 + row_number() OVER (ORDER BY label) - 1 AS uid FROM labels_)"""


@query("b06_assign", f"WITH {LABELS} SELECT label, uid FROM assigned")
def assign(g: Graph):
    return identity.assign(identity.blank_labels(_blank_triples(g)), first_uid=1000)


@query(
    "b07_propagate",
    f"""WITH {LABELS}, h AS (SELECT label, '0x' || lower(to_hex(uid)) AS x FROM assigned)
    SELECT a.x AS subject, 'placed_by' AS predicate, b.x AS object, NULL AS value FROM orders JOIN h a ON a.label = '_:o' || o_orderkey JOIN h b ON b.label = '_:c' || o_custkey
    UNION ALL SELECT a.x, 'o_orderstatus', NULL, o_orderstatus FROM orders JOIN h a ON a.label = '_:o' || o_orderkey
    UNION ALL SELECT {hexa(CUST)}, 'same_as', b.x, NULL FROM customer JOIN h b ON b.label = '_:c' || c_custkey""",
)
def propagate(g: Graph):
    rows = _blank_triples(g)
    assigned = identity.assign(identity.blank_labels(rows), first_uid=1000)
    return identity.propagate(rows, assigned).select("subject", "predicate", "object", "value")


@query(
    "b08_flatten",
    f"""SELECT o_orderkey, CASE WHEN c_acctbal > 0 THEN '{{"uid":"' || {hexa(CUST)} || '"}}'
      ELSE '{{"uid":"_:c' || c_custkey || '","c_name":"' || c_name || '"}}' END AS placed_by
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def flatten(g: Graph):
    """Customers in credit are stored nodes, the others arrive as new ones."""
    customers = g.customer().select(
        F.col("uid").alias("placed_by"), "c_name",
        F.when(F.col("c_acctbal") > 0, uids.to_text(F.col("uid"))).otherwise(F.concat(F.lit("_:c"), F.col("c_custkey").cast("string"))).alias("ref"),
    )
    rows = g.orders().select("o_orderkey", "placed_by").join(customers, "placed_by")
    return rows.select("o_orderkey", json_io.flatten_reference(F.col("ref"), [F.col("c_name")]).alias("placed_by"))
