"""Sources and sinks: N-Quads, JSON documents, responses, partitioned facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom.catalog.common import CONTAINS, EVENTS, hexa, query, u
from quadloom.functions import uid as uids
from quadloom.functions.values import json_literal
from quadloom.model import FACETS
from quadloom.plans.cut import written
from quadloom.plans.spread import spread_out
from quadloom.sources import json_io, json_open, nquads
from quadloom.sources.tables import Graph

ORDER, CUSTOMER, PART = u("Order", "o_orderkey"), u("Customer", "o_custkey"), u("Part", "dst")


def _nquad_lines(g: Graph):
    """Lines as a user would send them: typed literals, edges with facets, language-tagged
    texts, star deletes, blank subjects, and some that are malformed."""
    orders = spread_out(g.orders(), "uid")
    uid = uids.in_nquad(uids.to_text(F.col("uid")))
    cust = uids.in_nquad(uids.to_text(F.col("placed_by") + F.lit(-(2**63))))  # uids above 2^63
    per_order = orders.select(
        F.explode(
            F.array(
                F.concat(uid, F.lit(" <o_totalprice> "), F.col("o_totalprice").cast("string"), F.lit(".")),
                F.concat(uid, F.lit(" <o_orderpriority> "), json_literal(F.col("o_orderpriority")), F.lit(" .")),
                F.concat(uid, F.lit(" <placed_by> "), cust, F.lit(' (since="'), F.date_format("o_orderdate", "yyyy-MM-dd"),
                         F.lit('", status='), json_literal(F.col("o_orderstatus")), F.lit(") .")),
                F.concat(F.lit("_:order"), F.col("o_orderkey").cast("string"), F.lit(" <is_final> "),
                         (F.col("o_orderstatus") == "F").cast("string"), F.lit(" .")),
                F.concat(uid, F.lit(" <old_note> * .")),
                F.concat(uid, F.lit(' <no_dot> "x" ')),
                F.concat(F.lit("<0xG"), F.col("o_orderkey").cast("string"), F.lit('> <bad_uid> "x" .')),
                F.concat(F.lit('<0x0> <no_node> "'), F.col("o_orderkey").cast("string"), F.lit('" .')),
                F.lit("   "),
            )
        ).alias("value")
    )
    texts = spread_out(g.documents(), "uid").select(
        F.concat(uids.in_nquad(uids.to_text(F.col("uid"))), F.lit(" <text> "), json_literal(F.col("text")),
                 F.lit("@"), F.col("lang"), F.lit(" .")).alias("value")
    )
    return per_order.unionByName(texts)


@query(
    "a01_nquad_source",
    f"""WITH o AS (SELECT *, {hexa(ORDER)} AS s, {hexa(CUSTOMER + ' - 9223372036854775807 - 1')} AS c FROM orders)
    SELECT s AS subject, 'o_totalprice' AS predicate, NULL AS object, o_totalprice::VARCHAR AS value, 'float' AS value_type, NULL AS lang, NULL AS facets, false AS rejected FROM o
    UNION ALL SELECT s, 'o_orderpriority', NULL, o_orderpriority, 'string', NULL, NULL, false FROM o
    UNION ALL SELECT s, 'placed_by', c, NULL, 'uid', NULL, 'since="' || strftime(o_orderdate, '%Y-%m-%d') || '", status="' || o_orderstatus || '"', false FROM o
    UNION ALL SELECT '_:order' || o_orderkey, 'is_final', NULL, CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END, 'bool', NULL, NULL, false FROM o
    UNION ALL SELECT s, 'old_note', NULL, '_STAR_ALL', 'default', NULL, NULL, false FROM o
    UNION ALL SELECT NULL, NULL, NULL, '<' || s || '> <no_dot> "x" ', 'end of line', NULL, NULL, true FROM o
    UNION ALL SELECT NULL, NULL, NULL, '<0x0> <no_node> "' || o_orderkey || '" .', 'subject', NULL, NULL, true FROM o
    UNION ALL SELECT NULL, NULL, NULL, '<0xG' || o_orderkey || '> <bad_uid> "x" .', 'subject', NULL, NULL, true FROM o
    UNION ALL SELECT {hexa(u('Document', 'doc_id'))}, 'text', NULL, text, 'string', lang, NULL, false FROM documents""",
)
def nquad_source(g: Graph):
    parsed = nquads.parse(_nquad_lines(g))
    bad = F.col("error").isNotNull()
    facets = F.array_join(
        F.transform(F.array_sort(F.map_entries("facets")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", "
    )
    return parsed.select(
        F.when(~bad, F.col("subject")).alias("subject"),
        F.when(~bad, F.col("predicate")).alias("predicate"),
        F.when(~bad, F.col("object")).alias("object"),
        F.when(bad, F.col("line")).otherwise(F.col("value")).alias("value"),
        F.when(bad, F.col("error")).otherwise(F.col("value_type")).alias("value_type"),
        F.when(~bad, F.col("lang")).alias("lang"),
        F.when(~bad, facets).alias("facets"),
        bad.alias("rejected"),
    )


@query(
    "a02_nquad_sink",
    f"""WITH {CONTAINS}, c AS (SELECT *, '<' || {hexa(u('Customer', 'c_custkey'))} || '>' AS s FROM customer)
    SELECT s || ' <c_name> "' || c_name || '" .' AS line FROM c
    UNION ALL SELECT s || ' <c_acctbal> ' || c_acctbal || ' .' FROM c
    UNION ALL SELECT s || ' <c_mktsegment> "' || c_mktsegment || '" .' FROM c
    UNION ALL SELECT s || ' <in_nation> <' || {hexa(u('Nation', 'c_nationkey'))} || '> .' FROM c
    UNION ALL SELECT s || ' <node.type> "Customer" .' FROM c
    UNION ALL SELECT '<' || {hexa('src')} || '> <contains> <' || {hexa('dst')} || '> (lines=' || lines || ', shipped="' || strftime(first_ship, '%Y-%m-%d') || '") .' FROM contains""",
)
def nquad_sink(g: Graph):
    edges = g.contains().select(
        F.lit(0).cast("long").alias("namespace"), F.col("src").alias("subject"), F.lit("contains").alias("predicate"),
        F.col("dst").alias("object_uid"), F.lit(None).cast("string").alias("value"), F.lit("uid").alias("value_type"),
        F.lit(None).cast("string").alias("lang"),
        F.create_map(F.lit("lines"), json_literal(F.col("lines")), F.lit("shipped"),
                     json_literal(F.date_format("first_ship", "yyyy-MM-dd"))).cast(FACETS).alias("facets"),
    )
    rows = nquads.from_facts(g.customer_facts().unionByName(edges))
    labels = nquads.type_rows(g.customer(), F.array(F.lit("Customer")), "node.type")
    return nquads.lines(rows.unionByName(labels))


JSON_TRIPLES = f"""WITH {EVENTS}, o AS (SELECT *, {hexa(ORDER)} AS s, {hexa(CUSTOMER)} AS c FROM orders),
    e AS (SELECT *, {hexa('cust')} AS s, {hexa('uid')} AS o FROM ev)
    SELECT s AS subject, 'o_totalprice' AS predicate, NULL AS object, o_totalprice::VARCHAR AS value, 'float' AS value_type, NULL AS facets FROM o
    UNION ALL SELECT s, 'tags', NULL, o_orderstatus, 'string', NULL FROM o
    UNION ALL SELECT s, 'tags', NULL, o_orderpriority, 'string', NULL FROM o
    UNION ALL SELECT s, 'placed_by', c, NULL, 'uid', 'since="' || strftime(o_orderdate, '%Y-%m-%d') || '"' FROM o
    UNION ALL SELECT c, 'c_custkey', NULL, o_custkey::VARCHAR, 'int', NULL FROM o
    UNION ALL SELECT s, 'did', o, NULL, 'uid', 'k=' || k FROM e
    UNION ALL SELECT o, 'event_type', NULL, event_type, 'string', NULL FROM e
    UNION ALL SELECT o, 'value', NULL, value::VARCHAR, 'float', NULL FROM e"""


def _json_texts(g: Graph):
    orders = spread_out(g.orders(), "uid").select(
        F.to_json(
            F.struct(
                uids.to_text(F.col("uid")).alias("uid"), "o_totalprice",
                F.array("o_orderstatus", "o_orderpriority").alias("tags"),
                F.struct(
                    uids.to_text(F.col("placed_by")).alias("uid"), F.col("o_custkey").alias("c_custkey"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("placed_by|since"),
                ).alias("placed_by"),
            )
        ).alias("json")
    )
    events = spread_out(g.events(), "uid").select(
        F.to_json(
            F.struct(
                uids.to_text(F.col("user")).alias("uid"),
                F.array(F.struct(uids.to_text(F.col("uid")).alias("uid"), "event_type", "value", F.col("k").alias("did|k"))).alias("did"),
            )
        ).alias("json")
    )
    return orders, events


def _with_facet_text(rows):
    facets = F.array_join(F.transform(F.map_entries("facets"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", ")
    return rows.select("subject", "predicate", "object", "value", "value_type", facets.alias("facets"))


@query(
    "a03_json_source",
    JSON_TRIPLES,
)
def json_source(g: Graph):
    """Orders with a nested customer, and customers with an array of nested events."""
    orders, events = _json_texts(g)
    from pyspark.sql import types as T

    person = T.StructType.fromDDL("uid string, c_custkey bigint, `placed_by|since` string")
    order = T.StructType.fromDDL("uid string, o_totalprice double, tags array<string>").add("placed_by", person)
    event = T.StructType.fromDDL("uid string, did array<struct<uid: string, event_type: string, value: double, `did|k`: bigint>>")
    rows = json_io.to_triples(orders, "json", order).unionByName(json_io.to_triples(events, "json", event))
    return _with_facet_text(rows)


@query("a03_json_open", JSON_TRIPLES)
def json_open_source(g: Graph):
    """The same texts, read without a declared schema."""
    orders, events = _json_texts(g)
    return _with_facet_text(json_open.to_triples(orders.unionByName(events), "json"))


@query(
    "a03_json_depth",
    f"""WITH o AS (SELECT *, {hexa(ORDER)} AS s, {hexa(CUSTOMER)} AS c FROM orders)
    SELECT s AS subject, 'priority' AS predicate, NULL AS object, o_orderpriority AS value, 'string' AS value_type FROM o
    UNION ALL SELECT s, 'grid', NULL, unnest([o_orderkey, o_custkey, o_orderkey + 1])::VARCHAR, 'int' FROM o
    UNION ALL SELECT s, 'by', c, NULL, 'uid' FROM o WHERE o_orderkey % 3 > 0
    UNION ALL SELECT c, 'last', s, NULL, 'uid' FROM o WHERE o_orderkey % 3 > 0
    UNION ALL SELECT s, 'final', NULL, CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END, 'bool' FROM o WHERE o_orderkey % 3 = 2""",
)
def json_depth(g: Graph):
    """Texts of three depths: lists in lists, an object in an object in an object."""
    uid, by, n = uids.to_text(F.col("uid")), uids.to_text(F.col("placed_by")), F.col("o_orderkey") % 3
    last = F.struct(uid.alias("uid"), F.when(n == 2, F.col("o_orderstatus") == "F").alias("final"))
    lists = F.array(F.array("o_orderkey"), F.array(F.col("o_custkey"), F.col("o_orderkey") + 1))
    texts = spread_out(g.orders(), "uid").select(F.to_json(F.struct(
        uid.alias("uid"), F.col("o_orderpriority").alias("priority"), lists.alias("grid"),
        F.when(n > 0, F.struct(by.alias("uid"), last.alias("last"))).alias("by"),
    )).alias("json"))
    rows = json_open.to_triples(texts, "json")
    return rows.select("subject", "predicate", "object", "value", "value_type")


@query(
    "a04_json_sink",
    f"""WITH {CONTAINS}, c AS (SELECT src, string_agg('{{"uid":"' || {hexa('dst')} || '","contains|quantity":' || quantity || ',"contains|lines":' || lines || '}}', ',' ORDER BY dst) AS t
      FROM contains GROUP BY src)
    SELECT {ORDER} AS uid, 0::BIGINT AS page, '{{"uid":"' || {hexa(ORDER)} || '","node.type":["Order"],"o_orderstatus":"' || o_orderstatus || '","o_totalprice":' || o_totalprice
      || coalesce(',"contains":[' || t || ']', '') || '}}' AS json FROM orders LEFT JOIN c ON src = {ORDER}""",
)
def json_sink(g: Graph):
    lines = json_io.Block(
        g.contains().select("src", "dst", "quantity", "lines"),
        ["dst"],
        F.struct(uids.to_text(F.col("dst")).alias("uid"), F.col("quantity").alias("contains|quantity"), F.col("lines").alias("contains|lines")),
    )
    return json_io.documents(g.orders(), ["o_orderstatus", "o_totalprice"], {"contains": lines}, ["Order"])


@query(
    "a05_response_reader",
    f"""SELECT {hexa(u('Customer', 'c_custkey'))} AS uid, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT {hexa(u('Supplier', 's_suppkey'))}, s_name, s_acctbal FROM supplier
    UNION ALL SELECT {hexa(u('Part', 'p_partkey'))}, p_name, p_retailprice FROM part""",
)
def response_reader(g: Graph):
    """Wrapped in `data`, with the block at top level, and a bare list."""
    def row(uid, name, balance):
        return F.struct(uids.to_text(F.col(uid)).alias("uid"), F.col(name).alias("name"), F.col(balance).alias("balance"))

    wrapped = g.customer().select(
        F.to_json(F.struct(F.struct(F.array(row("uid", "c_name", "c_acctbal")).alias("me")).alias("data"))).alias("json"))
    plain = g.supplier().select(F.to_json(F.struct(F.array(row("uid", "s_name", "s_acctbal")).alias("me"))).alias("json"))
    bare = g.part().select(F.to_json(F.array(row("uid", "p_name", "p_retailprice"))).alias("json"))
    responses = wrapped.unionByName(plain).unionByName(bare)
    return json_io.read_response(responses, "json", "me", "uid: string, name: string, balance: double")


@query(
    "a10_predicate_scan",
    f"""SELECT {ORDER} AS uid, o_totalprice FROM orders WHERE o_totalprice > 250000""",
)
def predicate_scan(g: Graph):
    """Facts on disk by predicate; the read touches one partition directory."""
    stored = written(g.order_facts(), "facts", partition_by=["predicate"])
    one = stored.where("predicate = 'o_totalprice'")
    return one.select(F.col("subject").alias("uid"), F.col("value").cast("double").alias("o_totalprice")).where("o_totalprice > 250000")
