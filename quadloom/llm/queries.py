"""The registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quadloom.llm import (
    conversations, decontamination, hard_negatives, language, near_copies, packing, page_text, personal_data, quality_rules, repeats, resampling,
    shards, token_counts,
)
from quadloom.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return keep


@query("op1_page_text")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


@query("op2_near_copies")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.groups(table(spark, sf_dir, "documents"))


@query("op3_quality_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


@query("op4_resample")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (
  SELECT item_id, least(len(w), 13) AS n, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda i: array_to_string(w[i:i+12], ' '))) AS g
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, sizes WHERE len(w) >= n),
hit AS (
  SELECT DISTINCT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON bw.n = dw.n AND bw.g = array_to_string(dw.w[dw.i:dw.i + dw.n - 1], ' ')),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT CAST(item_id AS VARCHAR)) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT CAST(d.doc_id AS BIGINT) AS doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
  coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN items i USING (doc_id)
"""


@query("op5_decontaminate", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.digest(found)


@query("op6_personal_data")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(personal_data.find(table(spark, sf_dir, "documents")))


@query("op7_pack")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op8_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(table(spark, sf_dir, "documents"), 8)


@query("op9_language")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
often AS (SELECT hash(s) AS h, s FROM g GROUP BY s HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM g JOIN often ON often.h = hash(g.s) AND often.s = g.s),
lost AS (SELECT r, list(p) AS ps FROM gone GROUP BY r)
SELECT CAST(d.doc_id AS BIGINT) AS doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN ps IS NULL THEN array_to_string(d.w, ' ')
    ELSE array_to_string(list_transform(list_sort(list_filter(range(1, len(d.w) + 1), lambda p: NOT list_contains(ps, p))), lambda p: d.w[p]), ' ') END) AS kept_sha256
FROM d LEFT JOIN lost USING (r)
"""


@query("op10_repeats", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


OP11_SQL = r"""
WITH v AS (
  SELECT row_number() OVER () AS r, CAST(vec_id AS BIGINT) AS vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS r, b.vec_id AS vec_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.e) = len(b.e)),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST, r) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.ar, p.r ORDER BY n.score DESC, n.vec_id NULLS LAST, n.r) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.ar = p.ar AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""


@query("op11_hard_negatives", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(rows, "vec_id % 50 = 0")


@query("op12_conversations")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.digest(conversations.damage(rows), rows)


@query("op13_token_counts")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), model, 4096).drop("cuts")
