"""Quality by importance resampling.

Two bag-of-n-gram models over hashed buckets are counted: one of target texts (a bounded sample
of texts labelled good), one of all raw texts. A text's importance weight is the ratio of its
probabilities under both (`per_ngram=False`), or that ratio per n-gram and sharpened, so that a
text is judged by what it says and not by how long it is. Gumbel noise on the log weights and the
largest sums give a sample without replacement in proportion to the weights. Every row has its
own noise, repeated rows too. Buckets grow with the root of the texts' bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quadloom.llm.shards import prefix_sums
from quadloom.llm.tables import text_of
from quadloom.llm.words import Words, byte_texts, chunks, mixed, sums_by_text
from quadloom.plans.cut import written

#: The fewest buckets; `buckets_for` gives more to larger inputs.
BUCKETS = 1 << 14
_NEXT = np.uint64(0x9E3779B97F4A7C15)


def buckets_for(n_bytes: int) -> int:
    """A power of two, at least four times the root of the bytes: distinct n-grams grow about
    with the root of a text, so as many share a bucket at every size."""
    return max(BUCKETS, 1 << (4 * math.isqrt(n_bytes)).bit_length())


def ngrams(texts: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, Words]:
    """Buckets of every word and of every two words in a row (-1 where the second word is of
    another text), for a chunk; words are compared in lower case."""
    w = Words([t.lower() for t in texts])
    h = w.hashes()
    one = (h & np.uint64(buckets - 1)).astype(np.int32)
    two = np.full(len(h), -1, np.int32)
    if len(h) > 1:
        two[:-1] = (mixed(h[:-1] * _NEXT + h[1:]) & np.uint64(buckets - 1)).astype(np.int32)
        ends = w.first[1:][w.count > 0] - 1
        two[ends] = -1
    return one, two, w


def target_ids(labels: DataFrame, limit: int, doc_id: str, good: Column) -> np.ndarray:
    """Ids labelled good; of more than `limit` those with the smallest hash."""
    ids = labels.where(good & F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("bigint").alias("id")).distinct()
    rows = ids.orderBy(F.xxhash64("id"), "id").limit(limit).collect()
    return np.sort(np.array([r["id"] for r in rows], np.int64))


def log_ratios(rows: DataFrame, ids: np.ndarray, buckets: int) -> np.ndarray:
    """Log of target over raw probability of every bucket, smoothed by one. Raw counts cover
    all texts; a task adds up its counts before the shuffle, the driver gets one line per bucket."""
    shared = rows.sparkSession.sparkContext.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            texts = byte_texts(batch.column(1))
            own = batch.column(0)
            is_target = np.isin(own.fill_null(0).to_numpy(), known) & own.is_valid().to_numpy(zero_copy_only=False)
            for a, b in chunks(texts):
                one, two, w = ngrams(texts[a:b], buckets)
                mine = np.repeat(is_target[a:b], w.count)
                for g in (one, two):
                    raw += np.bincount(g[g >= 0], minlength=buckets)
                    target += np.bincount(g[(g >= 0) & mine], minlength=buckets)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(seen.astype(np.int32)), "raw": pa.array(raw[seen]), "target": pa.array(target[seen])})

    counts = rows.mapInArrow(run, "bucket int, raw bigint, target bigint").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.ones(buckets), np.ones(buckets)
    at = counts["bucket"].to_numpy()
    raw[at] += counts["raw"].to_numpy()
    target[at] += counts["target"].to_numpy()
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def gumbel(seed: int, *keys: str) -> Column:
    """Standard Gumbel noise, the same for the same keys."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11)
    return -F.log(-F.log((bits + 0.5) / float(1 << 53)))


def resample(
    docs: DataFrame,
    labels: DataFrame,
    fraction: float = 0.85,
    sharpness: float = 100.0,
    sample: int = 20_000,
    seed: int = 11,
    good: Column | None = None,
    per_ngram: bool = True,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_ngrams, log_weight (mean log ratio, or with
    `per_ngram=False` the log ratio of the whole text, times `sharpness`), noisy (log weight plus
    Gumbel noise) and selected, true for the `fraction` of all rows with the largest noisy weight.

    The target model is fitted on at most `sample` texts whose label is `good` (default quality
    = 1 and not toxic); the raw model and the weights cover all texts. Texts without words have
    no weight and are never selected. Equal weights go by id; repeated rows, also those of null
    ids, are counted and drawn each, with noise of their own; null ids are rows like others, but
    never targets. Without any target all weights are 0 and the noise alone decides. The draw is
    a function of `seed` and the rows, not of how they lie in files."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) if good is None else good
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), text_of(docs, text).alias("text"))
    ids = target_ids(labels, sample, "doc_id", good)
    buckets = buckets_for(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) if len(ids) else BUCKETS
    ratios = log_ratios(rows, ids, buckets) if len(ids) else np.zeros(buckets)
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = np.concatenate([shared.value, [0.0]])  # -1 is the last entry
        micro = np.rint(ratio * 2**32).astype(np.int64)  # whole numbers: sums do not depend on order
        for batch in batches:
            texts = byte_texts(batch.column(1))
            for a, b in chunks(texts):
                one, two, w = ngrams(texts[a:b], buckets)
                n = w.count + np.maximum(w.count - 1, 0)
                total = sums_by_text(micro[one] + micro[two], w.first)
                weight = sharpness * total / 2**32 / (np.maximum(n, 1) if per_ngram else 1)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(a, b - a), "n_ngrams": pa.array(n.astype(np.int64)),
                    "log_weight": pa.array(weight, mask=n == 0), "print": batch.column(2).slice(a, b - a),
                })

    weighed = rows.withColumn("print", F.xxhash64("text")).mapInArrow(run, "doc_id bigint, n_ngrams bigint, log_weight double, print bigint")
    one = F.lit(1).cast("bigint")
    # The written place only parts equal rows, which may change places.
    weighed = written(weighed.select("*", F.monotonically_increasing_id().alias("place"), one.alias("one")), "weighed")
    numbered = prefix_sums(weighed, ["doc_id", "print", "place"], "one").withColumnRenamed("index", "number").drop("start")
    noisy = numbered.withColumn("noisy", F.col("log_weight") + gumbel(seed, "doc_id", "print", "number"))
    ranked = prefix_sums(
        noisy.withColumn("order", -F.coalesce(F.col("noisy"), F.lit(float("-inf")))), ["order", "doc_id", "number"], "one",
    )
    total = ranked.count()
    return ranked.select(
        "doc_id", "n_ngrams", "log_weight", "noisy",
        ((F.col("index") < int(fraction * total)) & F.col("noisy").isNotNull()).alias("selected"),
    )
