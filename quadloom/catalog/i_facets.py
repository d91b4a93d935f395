"""Facets and languages."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom.catalog.common import CONTAINS, EVENTS, LOG, query, u
from quadloom.functions import facets as fx
from quadloom.functions.values import json_literal
from quadloom.model import FACETS, edge_fact, value_fact
from quadloom.operators import facet_ops, roots, traverse
from quadloom.plans.spread import spread_out
from quadloom.sources import nquads
from quadloom.sources.tables import Graph

CUST, ORDER = u("Customer", "c_custkey"), u("Order", "o_orderkey")


def faceted_names(g: Graph):
    """Customer names with two facets: segment (text) and balance (number)."""
    facets = F.create_map(
        F.lit("segment"), json_literal(F.col("c_mktsegment")), F.lit("balance"), json_literal(F.col("c_acctbal"))
    ).cast(FACETS)
    return value_fact(g.customer(), F.col("uid"), "c_name", F.col("c_name"), "string", facets=facets)


@query(
    "i01_facet_key",
    f"""WITH t AS (SELECT c_custkey, c_name, unnest([c_name || '|' || c_mktsegment, c_name || '@de', c_name, c_name || '|a|b', 'x|' || c_custkey || '@y']) AS text FROM customer)
    SELECT c_custkey, text, CASE WHEN text LIKE '%|a|b' THEN NULL WHEN text LIKE 'x|%' THEN 'x' WHEN text = c_name THEN NULL ELSE c_name END AS predicate,
      CASE WHEN text LIKE '%|a|b' OR text = c_name THEN NULL WHEN text LIKE 'x|%' THEN c_custkey || '@y' WHEN text LIKE '%@de' THEN 'de' ELSE split_part(text, '|', 2) END AS facet,
      CASE WHEN text LIKE '%|a|b' OR text = c_name THEN NULL ELSE text LIKE '%@de' END AS is_lang,
      CASE WHEN text LIKE '%|a|b' OR text = c_name THEN NULL ELSE text END AS back FROM t""",
)
def facet_key(g: Graph):
    rows = g.raw("customer").select(
        "c_custkey",
        F.explode(F.array(
            F.concat_ws("|", "c_name", "c_mktsegment"), F.concat(F.col("c_name"), F.lit("@de")), F.col("c_name"),
            F.concat(F.col("c_name"), F.lit("|a|b")), F.concat(F.lit("x|"), F.col("c_custkey").cast("string"), F.lit("@y")),
        )).alias("text"),
    )
    return rows.withColumn("f", fx.parse_key(F.col("text"))).select(
        "c_custkey", "text", "f.predicate", "f.facet", "f.is_lang", F.when(F.col("f").isNotNull(), fx.format_key(F.col("f"))).alias("back")
    )


@query(
    "i02_value_facets",
    f"""SELECT {CUST} AS uid, c_name, c_mktsegment AS "c_name|segment", c_acctbal::VARCHAR AS "c_name|balance" FROM customer""",
)
def value_facets(g: Graph):
    return facet_ops.value_with_facets(faceted_names(g), "c_name", ["segment", "balance"])


@query("i02_tenant_facets", f"WITH {LOG} SELECT namespace, subject AS uid, value AS click, k::VARCHAR AS \"click|k\" FROM log WHERE predicate = 'click'")
def tenant_facets(g: Graph):
    """A predicate of five tenants with its facet."""
    return facet_ops.value_with_facets(g.log(), "click", ["k"], tenant=True)


@query(
    "i03_edge_facets",
    f"""WITH {CONTAINS} SELECT src AS uid, dst AS part_uid, p_name AS part_name, quantity AS "contains|quantity", price AS "contains|price", first_ship AS "contains|first_ship"
    FROM contains JOIN part ON dst = {u('Part', 'p_partkey')}""",
)
def edge_facets(g: Graph):
    edges = facet_ops.edge_facet_columns(g.contains(), "contains", ["quantity", "price", "first_ship"])
    parts = g.part().select("uid", F.col("p_name").alias("name"))
    return traverse.expand(g.orders().select("uid"), edges, parts, prefix="part_")


@query(
    "i04_selected_facets",
    f"""SELECT {CUST} AS uid, c_mktsegment AS seg, 'balance,segment' AS keys FROM customer""",
)
def selected_facets(g: Graph):
    facets = F.col("facets")
    return faceted_names(g).select(
        F.col("subject").alias("uid"), *fx.columns(facets, "c_name", {"segment": "seg"}),
        F.array_join(fx.sorted_keys(facets), ",").alias("keys"),
    )


@query(
    "i05_facet_filter",
    f"""WITH {CONTAINS} SELECT src, dst, quantity FROM contains WHERE (quantity >= 45 OR lines > 1) AND NOT price < 20000""",
)
def facet_filter(g: Graph):
    tree = ("and", [("or", [F.col("quantity") >= 45, F.col("lines") > 1]), ("not", F.col("price") < 20000)])
    return g.contains().where(roots.filter_tree(tree)).select("src", "dst", "quantity")


@query(
    "i06_facet_default",
    f"""SELECT {CUST} AS uid, c_acctbal AS balance, c_mktsegment AS segment, -1::INTEGER AS wrong_type, 'none' AS missing, 0.5::DOUBLE AS text_as_number FROM customer""",
)
def facet_default(g: Graph):
    facets = F.col("facets")
    return faceted_names(g).select(
        F.col("subject").alias("uid"),
        fx.get(facets, "balance", "double", 0.0).alias("balance"),
        fx.get(facets, "segment", "string", "none").alias("segment"),
        fx.get(facets, "segment", "int", -1).alias("wrong_type"),
        fx.get(facets, "origin", "string", "none").alias("missing"),
        fx.get(facets, "segment", "double", 0.5).alias("text_as_number"),
    )


@query(
    "i07_facet_set",
    f"""SELECT {CUST} AS uid, CASE WHEN c_acctbal > 0 THEN 'balance=' || c_acctbal || ';' ELSE '' END || 'big="' || c_custkey || '";seen=true;segment="' || c_name || '"' AS facets FROM customer""",
)
def facet_set(g: Graph):
    """Overwrite one, remove one by null, add a boolean and a 64-bit integer (kept as text)."""
    rows = faceted_names(g).join(g.customer().select(F.col("uid").alias("subject"), "c_acctbal", "c_custkey"), "subject")
    m = fx.put(F.col("facets"), "segment", F.col("value"), "string")
    m = fx.put(m, "balance", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")), "double")
    m = fx.put(m, "seen", F.lit(True), "boolean")
    m = fx.put(m, "big", F.col("c_custkey"), "bigint")
    m = fx.remove(fx.put(m, "tmp", F.lit("x"), "string"), "tmp")
    text = F.transform(fx.facet_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return rows.select(F.col("subject").alias("uid"), F.array_join(text, ";").alias("facets"))


def node_texts(g: Graph):
    """Every document as a language value of a node: eight documents a node, in two tenants
    that use the same nodes."""
    node = F.call_function("div", F.col("doc_id").cast("long"), F.lit(16).cast("long"))
    return value_fact(g.documents(), node, "body", F.col("text"), "string", lang=F.col("lang"), namespace=F.col("doc_id") % 2)


TEXTS = "texts AS (SELECT cast(doc_id % 2 AS BIGINT) AS namespace, cast(doc_id // 16 AS BIGINT) AS uid, lang, text FROM documents)"


@query(
    "i08_language",
    f"""WITH {TEXTS} SELECT namespace, uid, coalesce(max(text) FILTER (WHERE lang = 'de'), max(text) FILTER (WHERE lang = 'fr')) AS de_fr,
      first(text ORDER BY lang, text) AS any_text FROM texts GROUP BY namespace, uid""",
)
def language(g: Graph):
    texts = node_texts(g)
    first = facet_ops.in_language(texts, "body", ["de", "fr"]).withColumnRenamed("body", "de_fr")
    some = facet_ops.in_language(texts, "body", ["xx", "."]).withColumnRenamed("body", "any_text")
    return first.join(some, ["namespace", "uid"]).select("namespace", "uid", "de_fr", "any_text")


@query("i09_all_languages", f"WITH {TEXTS} SELECT namespace, uid, lang, text AS value FROM texts")
def all_languages(g: Graph):
    return facet_ops.all_languages(node_texts(g), "body").select("namespace", "uid", "lang", "value")


@query(
    "i10_json_facets",
    f"""WITH {EVENTS}, f AS (SELECT event_id, unnest(['k', 'v', 'at', 'ok', 'text', 'en']) AS facet, unnest(['int', 'float', 'dateTime', 'bool', 'string', 'string']) AS facet_type,
      unnest([k::VARCHAR, (value + 0.125)::VARCHAR, strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), CASE WHEN k > 50 THEN 'true' ELSE 'false' END, event_type || ' "x"', event_type]) AS value FROM ev)
    SELECT event_id, CASE WHEN facet = 'en' THEN 'name' ELSE 'value' END AS predicate, facet, facet = 'en' AS is_lang, facet_type, value FROM f""",
)
def json_facets(g: Graph):
    docs = spread_out(g.events(), "uid").select(
        "event_id",
        F.to_json(F.struct(
            F.col("event_id").alias("uid"), F.col("k").alias("value|k"), (F.col("value") + 0.125).alias("value|v"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("value|at"), (F.col("k") > 50).alias("value|ok"),
            F.concat(F.col("event_type"), F.lit(' "x"')).alias("value|text"), F.col("event_type").alias("name@en"),
            F.array("k").alias("value|list"), F.lit(None).cast("string").alias("value|none"),
        ), {"ignoreNullFields": "false"}).alias("json"),
    )
    return facet_ops.json_facets(docs, "json", ["event_id"])



def _list_json(g: Graph):
    """`ways` of three elements, the middle one null, facets on the first and the last."""
    return g.events().select(
        "event_id",
        F.to_json(F.struct(
            F.array(F.col("event_type"), F.lit(None), F.col("value").cast("string")).alias("ways"),
            F.create_map(F.lit("2"), F.col("k")).alias("ways|facet"),
            F.create_map(F.lit("0"), F.col("event_type"), F.lit("1"), F.lit("gone")).alias("ways|note"),
        )).alias("json"),
    )


@query(
    "i11_faceted_list_read",
    f"""WITH {EVENTS} SELECT event_id, 0::INTEGER AS pos, event_type AS value, NULL::BIGINT AS facet, event_type AS note FROM ev
    UNION ALL SELECT event_id, 2, value::VARCHAR, k, NULL FROM ev""",
)
def faceted_list_read(g: Graph):
    return facet_ops.read_faceted_list(_list_json(g), "json", ["event_id"], "ways", {"facet": "bigint", "note": "string"})


@query(
    "i12_faceted_list_write",
    f"""WITH {EVENTS} SELECT event_id, '{{"ways":["' || event_type || '","' || value || '"],"ways|facet":{{"0":' || k || ',"1":"' || event_type || '"}},"ways|ok":{{"1":true}}}}' AS json FROM ev""",
)
def faceted_list_write(g: Graph):
    def element(value, *cells):
        return F.struct(value.alias("value"), F.create_map(*cells).cast(FACETS).alias("facets"))

    elements = F.array(
        element(F.col("event_type"), F.lit("facet"), json_literal(F.col("k"))),
        element(F.col("value").cast("string"), F.lit("facet"), json_literal(F.col("event_type")), F.lit("ok"), F.lit("true")),
    )
    return g.events().select("event_id", facet_ops.faceted_list_json(elements, "ways").alias("json"))


@query(
    "i13_facet_on_target",
    f"""SELECT {u('Customer', 'o_custkey')} AS src, {ORDER} AS dst, o_orderdate AS "orders|since", o_orderstatus FROM orders""",
)
def facet_on_target(g: Graph):
    orders = g.orders()
    edges = orders.select(F.col("placed_by").alias("src"), F.col("uid").alias("dst"))
    moved, children = facet_ops.facet_from_child(edges, orders.select("uid", "o_orderstatus", "o_orderdate"), "o_orderdate", "orders|since")
    return moved.join(children.withColumnRenamed("uid", "dst"), "dst").select("src", "dst", F.col("orders|since"), "o_orderstatus")


@query(
    "i14_reference_facets",
    f"""SELECT '<0x' || lower(to_hex({ORDER})) || '> <placed_by> <0x' || lower(to_hex({u('Customer', 'o_custkey')})) || '> (price=' || o_totalprice || ', priority="' || o_orderpriority || '") .' AS line FROM orders""",
)
def reference_facets(g: Graph):
    facets = F.create_map(
        F.lit("priority"), json_literal(F.col("o_orderpriority")), F.lit("price"), json_literal(F.col("o_totalprice"))
    ).cast(FACETS)
    return nquads.lines(nquads.from_facts(edge_fact(g.orders(), F.col("uid"), "placed_by", F.col("placed_by"), facets=facets)))


@query(
    "i15_facet_tokens",
    f"""SELECT 0::BIGINT AS namespace, {ORDER} AS subject, 'placed_by' AS predicate, 'priority' AS facet, token FROM
      (SELECT o_orderkey, unnest(list_distinct(list_filter(regexp_split_to_array(lower(o_orderpriority), '[^a-z0-9]+'), lambda x: x <> ''))) AS token FROM orders)""",
)
def facet_tokens(g: Graph):
    facets = F.create_map(F.lit("priority"), json_literal(F.col("o_orderpriority")), F.lit("price"), json_literal(F.col("o_totalprice"))).cast(FACETS)
    return facet_ops.facet_tokens(edge_fact(g.orders(), F.col("uid"), "placed_by", F.col("placed_by"), facets=facets))
