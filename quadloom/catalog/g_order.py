"""Sorting, paging and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom.catalog.common import EVENTS, query, u
from quadloom.catalog.i_facets import TEXTS, node_texts
from quadloom.operators import order
from quadloom.plans.pages import nest
from quadloom.plans.rank import positions
from quadloom.sources.tables import Graph, key_of


@query(
    "g01_root_sort",
    f"""SELECT {u('Order', 'o_orderkey')} AS uid, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders""",
)
def root_sort(g: Graph):
    return positions(g.orders().select("uid", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("uid").asc()])


@query(
    "g02_child_sort",
    f"""SELECT {u('Customer', 'o_custkey')} AS customer, page, string_agg(o_orderpriority || ' ' || o_orderkey, ', ' ORDER BY o_orderpriority, o_orderkey) AS orders
    FROM (SELECT *, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) - 1) // 6 AS page FROM orders) GROUP BY o_custkey, page""",
)
def child_sort(g: Graph):
    rows = g.orders().select(F.col("placed_by").alias("customer"), "o_orderpriority", "o_orderkey")
    item = F.concat_ws(" ", "o_orderpriority", F.col("o_orderkey").cast("string"))
    lists = nest(rows, ["customer"], ["o_orderpriority", "o_orderkey"], item, "orders", page_size=6)
    return lists.select("customer", "page", F.array_join("orders", ", ").alias("orders"))


@query(
    "g03_multi_key_sort",
    """SELECT doc_id, lang, source, row_number() OVER (ORDER BY source, lang DESC, n_chars DESC, doc_id) AS position FROM documents""",
)
def multi_key_sort(g: Graph):
    rows = g.documents().select("doc_id", "lang", "source", "n_chars")
    keys = [F.col("source").asc(), F.col("lang").desc(), F.col("n_chars").desc(), F.col("doc_id").asc()]
    return positions(rows, keys).select("doc_id", "lang", "source", "position")


@query(
    "g03_language_sort",
    f"""WITH {TEXTS}, v AS (SELECT namespace, uid, coalesce(max(text) FILTER (WHERE lang = 'de'), max(text) FILTER (WHERE lang = 'fr')) AS body FROM texts GROUP BY ALL)
    SELECT namespace, uid, body, row_number() OVER (ORDER BY body DESC NULLS LAST, namespace, uid) AS position FROM v""",
)
def language_sort(g: Graph):
    """Nodes by their German text, else the French one."""
    texts = node_texts(g)
    nodes = texts.select("namespace", F.col("subject").alias("uid")).distinct()
    return order.by_language(nodes, texts, "body", ["de", "fr"], descending=True)


LOCALES = ("de", "fr", "es", "en")


@query(
    "g03_locale_sort",
    r"WITH w AS (SELECT doc_id, lang, regexp_extract(text, '\p{L}+') AS word FROM documents) " + " UNION ALL ".join(
        f"SELECT doc_id, lang, word, row_number() OVER (ORDER BY word COLLATE {tag} NULLS LAST, word NULLS LAST, doc_id) AS position FROM w WHERE lang = '{tag}'" for tag in LOCALES)
    + f" UNION ALL SELECT doc_id, lang, word, row_number() OVER (PARTITION BY lang ORDER BY word NULLS LAST, doc_id) FROM w WHERE lang IS NULL OR lang NOT IN {LOCALES}",
)
def locale_sort(g: Graph):
    """Documents by their first word in the dictionary order of their language."""
    rows = g.raw("documents").select("doc_id", "lang", F.regexp_extract("text", r"\p{L}+", 0).alias("word"))
    return order.by_locale(rows, "word", "lang", LOCALES, [F.asc("doc_id")])


@query(
    "g04_first",
    f"""SELECT {u('Order', 'o_orderkey')} AS uid, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def first(g: Graph):
    return order.first(g.orders(), [F.desc("o_totalprice"), F.asc("uid")], 10).select("uid", "o_totalprice")


@query(
    "g05_page",
    f"""SELECT {u('Order', 'o_orderkey')} AS uid, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 50 OFFSET 100""",
)
def page(g: Graph):
    return order.page(g.orders().select("uid", "o_orderdate"), [F.asc("o_orderdate"), F.asc("uid")], 50, 100)


@query(
    "g06_after",
    f"""SELECT {u('Customer', 'c_custkey')} AS uid, c_name FROM customer WHERE {u('Customer', 'c_custkey')} > 4398046511154 ORDER BY c_custkey LIMIT 25""",
)
def after(g: Graph):
    cursor = key_of("Customer", (4 << 40) + 50)
    return order.after(g.customer(), cursor, 25, key="c_custkey").select("uid", "c_name")


@query(
    "g07_top_per_parent",
    f"""SELECT {u('Customer', 'o_custkey')} AS placed_by, {u('Order', 'o_orderkey')} AS uid, o_totalprice,
      row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INTEGER AS rank FROM orders
    QUALIFY rank <= 3""",
)
def top_per_parent(g: Graph):
    rows = g.orders().select("placed_by", "uid", "o_totalprice")
    return order.top_per_parent(rows, "placed_by", [F.desc("o_totalprice"), F.asc("uid")], 3)


@query(
    "g08_latest",
    f"""WITH {EVENTS}, done AS (SELECT max(event_id) AS m FROM ev WHERE event_type = 'error' AND k < 50)
    SELECT event_id, event_type, k FROM ev, done WHERE event_id >= m""",
)
def latest(g: Graph):
    """The newest finished row and everything after it."""
    events = g.events().select("event_id", "event_type", "k")
    done = events.where("event_type = 'error' AND k < 50")
    return order.latest(done, "event_id").unionByName(order.newer_than_latest(events, done, "event_id"))
