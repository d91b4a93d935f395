"""Index-backed search."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quadloom.catalog.common import query, u
from quadloom.functions import geo
from quadloom.operators import patterns, search, vector_index
from quadloom.plans.cut import fresh_path, written
from quadloom.plans.pages import PAGE_SIZE
from quadloom.plans.spread import spread_out
from quadloom.sources.tables import Graph

DOC, PART, CUST = u("Document", "doc_id"), u("Part", "p_partkey"), u("Customer", "c_custkey")
TERMS = r"terms AS (SELECT doc_id, lang, unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> ''))) AS term FROM documents)"
LON, LAT = "cast((c_custkey * 37) % 360 - 180 AS DOUBLE)", "cast((c_custkey * 17) % 180 - 90 AS DOUBLE)"


@query("k01_exact", f"SELECT {PART} AS uid, p_name FROM part WHERE p_name = 'small ring'")
def exact(g: Graph):
    path = fresh_path(g.spark, "exact")
    search.write_sorted(g.part().select("uid", "p_name"), path, "p_name", "uid")
    return g.spark.read.parquet(path).where("p_name = 'small ring'").select("uid", "p_name")


@query(
    "k02_hash",
    f"""SELECT {DOC} AS uid, text AS value FROM documents WHERE text IN (SELECT text FROM documents JOIN labels USING (doc_id) WHERE quality = 1)""",
)
def hashed(g: Graph):
    """Every document whose text equals that of a good one: exact copies included."""
    good = g.raw("labels").where("quality = 1").join(g.raw("documents"), "doc_id").select("text")
    return search.hash_lookup(search.hash_index(g.documents(), "text"), good, "text")


@query(
    "k03_terms",
    f"""WITH {TERMS} SELECT 'all' AS kind, {DOC} AS uid FROM terms WHERE term IN ('que', 'les', 'des') GROUP BY doc_id HAVING count(*) = 3
    UNION ALL SELECT DISTINCT 'any', {DOC} FROM terms WHERE term IN ('der', 'the')""",
)
def terms(g: Graph):
    index = search.stored(search.term_index(spread_out(g.documents(), "uid"), "text"), fresh_path(g.spark, "terms"), "term")
    found_all = search.all_terms(index, "Les que, des!").select(F.lit("all").alias("kind"), "uid")
    return found_all.unionByName(search.any_term(index, "der The").select(F.lit("any").alias("kind"), "uid"))


STOP_SQL = "stops AS (" + " UNION ALL ".join(
    f"SELECT '{lang}' AS lang, unnest([{', '.join(repr(w) for w in words)}]) AS term" for lang, words in search.STOP_WORDS.items()
) + ")"


@query(
    "k04_fulltext",
    f"""WITH {TERMS}, {STOP_SQL} SELECT term, count(*) AS docs, cast(sum({DOC}) AS BIGINT) AS uid_sum FROM terms
    WHERE (lang, term) NOT IN (SELECT (lang, term) FROM stops) GROUP BY term""",
)
def fulltext(g: Graph):
    index = search.fulltext_index(spread_out(g.documents(), "uid"), "text", "lang")
    return index.groupBy("term").agg(F.count(F.lit(1)).alias("docs"), F.sum("uid").alias("uid_sum"))


@query(
    "k05_trigram",
    f"""SELECT 're.*widget' AS pattern, {PART} AS uid, p_name FROM part WHERE regexp_matches(p_name, 're.*widget')
    UNION ALL SELECT '/RING$/i', {PART}, p_name FROM part WHERE regexp_matches(p_name, '(?i)RING$')
    UNION ALL SELECT '^blue b?olt', {PART}, p_name FROM part WHERE regexp_matches(p_name, '^blue b?olt')""",
)
def trigram(g: Graph):
    parts = g.part().select("uid", "p_name")
    index = search.stored(search.trigram_index(parts, "p_name"), fresh_path(g.spark, "trigrams"), "trigram")
    out = None
    for pattern in ("re.*widget", "/RING$/i", "^blue b?olt"):
        rows = search.regexp_search(parts, index, "p_name", pattern).select(F.lit(pattern).alias("pattern"), "uid", "p_name")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("k05_trigram_index", f"""SELECT DISTINCT {PART} AS uid, substr(p_name, i, 3) AS trigram FROM part, (SELECT unnest(range(1, 200)) AS i) WHERE i <= length(p_name) - 2""")
def trigram_index(g: Graph):
    return search.trigram_index(g.part(), "p_name").select("uid", "trigram")


PART_PATTERNS = ("(ring|bolt)$", "/RING$/i", "[a-c][a-z]+ widget", "^(small|large) [bg]", "re.*wid(get)+", "(?:blue|green) (?:b?olt|gear)", "n.*n")
TEXT_PATTERNS = ("licen[sc]e", "(token|secret|key) = \"[0-9a-f]{4}", "/copyright \\(c\\)/i", "(der|die|das) [a-z]*ung ", "(qu)+e les", "[0-9]{3}\\.[0-9]{2,3}")


def _any_sql(patterns_: tuple[str, ...], uid: str, column: str, source: str) -> str:
    forms = {p: "(?i)" + p[1:-2] if p.startswith("/") else p for p in patterns_}
    rows = ", ".join(f"($a${p}$a$, $a${java}$a$)" for p, java in forms.items())
    return f"SELECT pattern, {uid} AS uid, length({column})::INTEGER AS n_chars FROM {source}, (VALUES {rows}) t(pattern, re) WHERE regexp_matches({column}, re)"


@query("k05_trigram_any", _any_sql(PART_PATTERNS, PART, "p_name", "part") + " UNION ALL " + _any_sql(TEXT_PATTERNS, DOC, "text", "documents"))
def trigram_any(g: Graph):
    """Patterns with alternatives, groups, classes and ignored case, by their formulas."""
    out = []
    for rows, column, asked in ((g.part(), "p_name", PART_PATTERNS), (spread_out(g.documents(), "uid"), "text", TEXT_PATTERNS)):
        rows = rows.select("uid", column)
        index = search.stored(patterns.pattern_index(rows, column), fresh_path(g.spark, "patterns"), "trigram")
        out.append(patterns.search_patterns(rows, index, column, asked).select("pattern", "uid", F.length(column).alias("n_chars")))
    return out[0].unionByName(out[1])


@query(
    "k06_ranges",
    f"""SELECT 'int' AS kind, {PART} AS uid FROM part WHERE p_size BETWEEN 10 AND 20 UNION ALL SELECT 'float', {PART} FROM part WHERE p_retailprice < 950
    UNION ALL SELECT 'bool', {CUST} FROM customer WHERE c_acctbal < 0""",
)
def ranges(g: Graph):
    path = fresh_path(g.spark, "sorted")
    search.write_sorted(g.part().select("uid", "p_size", "p_retailprice"), path, "p_size", "uid")
    parts = g.spark.read.parquet(path)
    ints = parts.where("p_size >= 10 AND p_size <= 20").select(F.lit("int").alias("kind"), "uid")
    floats = parts.where("p_retailprice < 950").select(F.lit("float").alias("kind"), "uid")
    bools = g.customer().select("uid", (F.col("c_acctbal") < 0).alias("in_debt")).where("in_debt").select(F.lit("bool").alias("kind"), "uid")
    return ints.unionByName(floats).unionByName(bools)


@query(
    "k07_date_bucket",
    f"""SELECT {u('Order', 'o_orderkey')} AS uid, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-02-10' AND o_orderdate < TIMESTAMP '1998-05-20'""",
)
def date_bucket(g: Graph):
    path = fresh_path(g.spark, "buckets")
    search.with_bucket(g.orders().select("uid", "o_orderdate"), "o_orderdate", "year").write.partitionBy("bucket").parquet(path)
    stored = g.spark.read.schema("uid long, o_orderdate timestamp_ntz, bucket timestamp_ntz").parquet(path)
    return search.bucket_lookup(stored, "o_orderdate", "year", dt.datetime(1997, 2, 10), dt.datetime(1998, 5, 20)).select("uid", "o_orderdate")


def points(g: Graph):
    return g.customer().select("uid", "c_custkey", F.expr(LON).alias("lon"), F.expr(LAT).alias("lat"))


HAVERSINE = "2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin(radians(lat - clat) / 2), 2) + cos(radians(clat)) * cos(radians(lat)) * pow(sin(radians(lon - clon) / 2), 2))))"


@query(
    "k08_geo_radius",
    f"""WITH p AS (SELECT {CUST} AS uid, {LON} AS lon, {LAT} AS lat FROM customer),
    c AS (SELECT {u('Nation', 'n_nationkey')} AS centre, cast(n_nationkey * 15 - 180 AS DOUBLE) AS clon, cast(n_nationkey * 7 - 84 AS DOUBLE) AS clat, 1200000.0::DOUBLE AS radius FROM nation)
    SELECT centre, uid, round({HAVERSINE}, 1) AS metres FROM p, c WHERE {HAVERSINE} <= radius""",
)
def geo_radius(g: Graph):
    """Customers within 1,200 km of each nation's point, poles and date line included."""
    centres = g.nation().select(
        F.col("uid").alias("centre"), (F.col("n_nationkey") * 15 - 180).cast("double").alias("lon"),
        (F.col("n_nationkey") * 7 - 84).cast("double").alias("lat"), F.lit(1_200_000.0).alias("radius"),
    )
    return search.near(points(g), centres).select("centre", "uid", F.round("metres", 1).alias("metres"))


@query(
    "k08_geo_box",
    f"""WITH p AS (SELECT {CUST} AS uid, {LON} AS lon, {LAT} AS lat FROM customer)
    SELECT 'inside' AS box, uid FROM p WHERE lon BETWEEN -20 AND 35 AND lat BETWEEN 0 AND 60 UNION ALL SELECT 'date line', uid FROM p WHERE (lon >= 170 OR lon <= -160) AND lat BETWEEN -45 AND 45""",
)
def geo_box(g: Graph):
    rows, lon, lat = points(g), F.col("lon"), F.col("lat")
    inside = rows.where(geo.in_box(lon, lat, -20, 0, 35, 60)).select(F.lit("inside").alias("box"), "uid")
    return inside.unionByName(rows.where(geo.in_box(lon, lat, 170, -45, -160, 45)).select(F.lit("date line").alias("box"), "uid"))


def label_centres(g: Graph):
    """One query vector per label: the mean of its vectors, to six digits."""
    cells = g.raw("embeddings").select(F.col("label").cast("long").alias("query"), F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("query", "i").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    lists = means.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("e"))  # 64 cells per label
    return lists.select("query", F.col("e.x").alias("embedding"))


def _vector_sql(metric: str) -> str:
    score = {"euclidean": "sqrt(sum(pow(v.x - c.x, 2)))", "dot": "sum(v.x * c.x)",
             "cosine": "sum(v.x * c.x) / (sqrt(sum(v.x * v.x)) * sqrt(sum(c.x * c.x)))"}[metric]
    way = "ASC" if metric == "euclidean" else "DESC"
    return f"""WITH v AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
    c AS (SELECT label AS query, i, round(avg(x), 6) AS x FROM v GROUP BY label, i),
    s AS (SELECT query::BIGINT AS query, {u('Vector', 'vec_id')} AS uid, round({score}, 9) AS score FROM v JOIN c USING (i) GROUP BY query, vec_id)
    SELECT query, uid, round(score, 6) AS score, row_number() OVER (PARTITION BY query ORDER BY score {way}, uid)::INTEGER AS rank FROM s QUALIFY rank <= 5"""


def _vectors(metric: str):
    @query(f"k09_vector_{metric}", _vector_sql(metric))
    def run(g: Graph):
        best = search.top_k(g.vectors(), label_centres(g), 5, metric)
        return best.select("query", "uid", F.round("score", 6).alias("score"), "rank")

    return run


for _metric in ("euclidean", "dot", "cosine"):
    _vectors(_metric)


@query("k09_vector_lsh", "SELECT DISTINCT label::BIGINT AS query, true AS all_within, true AS recall_ok FROM embeddings")
def vector_lsh(g: Graph):
    """Approximate neighbours of every label's centre against the exact ones: all that are
    reported lie within the threshold, and at least 0.7 of the true ones are reported."""
    limit = 1.0
    centres = label_centres(g)
    found = search.similar_pairs(g.vectors(), centres, limit).groupBy("query").agg(
        F.count(F.lit(1)).alias("n"), F.max("distance").alias("most"))
    asked = centres.agg(F.collect_list(F.struct("query", "embedding"))).scalar()  # one per label
    exact = g.vectors().select("embedding", F.explode(asked).alias("q")).where(
        search.similarity("euclidean", F.col("embedding"), F.col("q.embedding")) <= limit
    ).groupBy(F.col("q.query").alias("query")).agg(F.count(F.lit(1)).alias("true_n"))
    rows = centres.select("query").join(found, "query", "left").join(exact, "query", "left")
    return rows.select(
        "query", F.coalesce(F.col("most") <= limit + 1e-9, F.lit(True)).alias("all_within"),
        (F.coalesce("n", F.lit(0)) >= 0.7 * F.coalesce("true_n", F.lit(0))).alias("recall_ok"),
    )


VECTOR, ASKED = u("Vector", "vec_id"), "vec_id % 20 = 0"


def _index_sql(metric: str) -> str:
    """All vectors with an id divisible by 20 against all vectors."""
    of = {"euclidean": "list_distance", "dot": "list_dot_product", "cosine": "list_cosine_similarity"}[metric]
    return f"""WITH v AS (SELECT {VECTOR} AS uid, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
    s AS (SELECT q.uid AS query, v.uid, round({of}(q.e, v.e), 9) AS score FROM v q, v WHERE q.{ASKED})
    SELECT query, uid, round(score, 6) AS score, row_number() OVER (PARTITION BY query ORDER BY score {"ASC" if metric == "euclidean" else "DESC"}, uid)::INTEGER AS rank
    FROM s QUALIFY rank <= 5"""


def _asked(g: Graph):
    return g.vectors().where(ASKED).select(F.col("uid").alias("query"), "embedding")


def _indexed(metric: str):
    @query(f"k09_index_{metric}", _index_sql(metric))
    def run(g: Graph):
        """The true neighbours by the stored index: the nearest cells, then all that may hold better ones."""
        index = vector_index.build(g.vectors().select("uid", "embedding"), fresh_path(g.spark, f"vectors-{metric}"), metric)
        return index.search(_asked(g), 5, exact=True).select("query", "uid", F.round("score", 6).alias("score"), "rank")

    return run


for _metric in vector_index.METRICS:
    _indexed(_metric)


@query(
    "k09_index_recall",
    f"""SELECT metric, query, least(10, n)::BIGINT AS found, true AS recall_ok FROM (VALUES ('euclidean'), ('dot'), ('cosine')) m(metric),
    (SELECT {VECTOR} AS query FROM embeddings WHERE {ASKED}), (SELECT count(*) AS n FROM embeddings)""",
)
def index_recall(g: Graph):
    """The nearest cells alone, as many as the index measured: ten neighbours for every query,
    and over all queries of a metric at least nine tenths of the true ones."""
    out = None
    vectors, asked = g.vectors().select("uid", "embedding"), _asked(g)
    for metric in vector_index.METRICS:
        index = vector_index.build(vectors, fresh_path(g.spark, f"vectors-{metric}"), metric)
        hits = written(vector_index.recall_of(index.search(asked, 10), vectors, asked, 10, metric), "hits")  # read twice
        whole = hits.agg((F.sum("hits") >= 0.9 * F.sum("true")).alias("recall_ok"))  # one row
        rows = hits.select(F.lit(metric).alias("metric"), "query", "found", whole.scalar().alias("recall_ok"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _inverted(name: str, page_size: int):
    @query(
        name,
        f"""WITH {TERMS}, p AS (SELECT *, (row_number() OVER (PARTITION BY term ORDER BY doc_id) - 1) // {page_size} AS page FROM terms)
        SELECT 'text' AS predicate, term, page, count(*)::INTEGER AS n, string_agg(({DOC})::VARCHAR, ' ' ORDER BY doc_id) AS uids FROM p GROUP BY term, page""",
    )
    def run(g: Graph):
        index = search.term_index(spread_out(g.documents(), "uid"), "text").select(F.lit("text").alias("predicate"), "term", "uid")
        lists = search.inverted_lists(index, page_size)
        return lists.select("predicate", "term", "page", F.size("uids").alias("n"), F.array_join(F.col("uids").cast("array<string>"), " ").alias("uids"))

    return run


_inverted("k10_inverted_index", PAGE_SIZE)
_inverted("k10_inverted_pages", 50)


@query(
    "k11_reverse_index",
    f"""SELECT DISTINCT {u('Part', 'l_partkey')} AS src, {u('Order', 'l_orderkey')} AS dst FROM lineitem""",
)
def reverse_index(g: Graph):
    return search.reverse_index(g.contains_pairs())
