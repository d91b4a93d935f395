"""Search backed by index tables: exact, hash, term, full text, trigram, ranges, date
buckets, geo cells, vectors, inverted and reverse indexes.

An index is a table of (key, uid) rows. Rows, not lists: a frequent term spreads over
tasks, and lists are only built page by page (`inverted_lists`)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from quadloom.functions import geo, text as tx
from quadloom.operators.roots import to_java_pattern
from quadloom.plans.blocks import BLOCK_TYPES, BLOCKS, CHUNK, CHUNK_TYPES, CHUNKS, best_of, block_name, emitted, packed_bytes, product_error
from quadloom.plans.cut import written
from quadloom.plans.pages import PAGE_SIZE, nest

# Stop words per language tag (ours; no stemming).
STOP_WORDS = {
    "en": "a an and are as at be by for from has he in is it its of on that the to was were will with this".split(),
    "de": "der die das ein eine und oder ist sind war in im am an auf für mit von zu den dem des nicht".split(),
    "fr": "le la les un une des et ou est sont dans en au aux de du que qui pour par avec ce ne pas".split(),
    "es": "el la los las un una y o es son en al de del que por para con se no su lo como más".split(),
}


# exact and hash --------------------------------------------------------------
def write_sorted(df: DataFrame, path: str, *columns: str) -> None:
    """Store range-partitioned and sorted by the indexed columns, so equality and range
    filters skip files and row groups by their min/max. Add the uid as last column: equal
    values then split over files."""
    df.repartitionByRange(*columns).sortWithinPartitions(*columns).write.parquet(path)


def stored(index: DataFrame, path: str, column: str, key: str = "uid") -> DataFrame:
    """An index written once, sorted by its entries: a search reads the files and row groups
    that hold the wanted ones."""
    write_sorted(index, path, column, key)
    return index.sparkSession.read.schema(index.schema).parquet(path)


def hash_index(df: DataFrame, column: str, key: str = "uid") -> DataFrame:
    return df.select(F.xxhash64(column).alias("hash"), F.col(column).alias("value"), key)


def hash_lookup(index: DataFrame, probes: DataFrame, column: str, key: str = "uid") -> DataFrame:
    """Nodes whose value is one of the probes: join on the 8-byte hash, recheck the value."""
    wanted = probes.select(F.xxhash64(column).alias("hash"), F.col(column).alias("_probe")).distinct()
    rows = index.join(wanted, (index["hash"] == wanted["hash"]) & (index["value"] == wanted["_probe"]), "left_semi")
    return rows.select(key, "value")


# terms -----------------------------------------------------------------------
def term_index(df: DataFrame, column: str, key: str = "uid") -> DataFrame:
    return df.select(F.explode(tx.terms(F.col(column))).alias("term"), key)


def fulltext_index(df: DataFrame, column: str, lang: str, key: str = "uid") -> DataFrame:
    """Terms without the stop words of the row's language, filtered before the explode."""
    stops = F.create_map(
        *[c for tag, words in STOP_WORDS.items() for c in (F.lit(tag), F.array(*[F.lit(w) for w in words]))]
    )
    stop = F.coalesce(F.try_element_at(stops, F.col(lang)), F.array().cast("array<string>"))
    return df.select(F.explode(F.array_except(tx.terms(F.col(column)), stop)).alias("term"), key)


def query_terms(text: str) -> list[str]:
    return sorted({t for t in re.split(r"[\W_]+", text.lower()) if t})


def holding_all(index: DataFrame, column: str, wanted: list[str], key: str = "uid") -> DataFrame:
    """Keys that have every wanted entry: one bit per entry, so one aggregation on a number
    and one shuffle; very long lists are counted instead."""
    rows = index.where(F.col(column).isin(wanted))
    if len(wanted) > 62:
        hits = rows.groupBy(key).agg(F.count_distinct(column).alias("n"))
        return hits.where(F.col("n") == len(wanted)).select(key)
    bits = F.lit(0).cast("long")
    for i, entry in enumerate(wanted):
        bits = F.when(F.col(column) == entry, F.lit(1 << i).cast("long")).otherwise(bits)
    hits = rows.groupBy(key).agg(F.bit_or(bits).alias("held"))
    return hits.where(F.col("held") == (1 << len(wanted)) - 1).select(key)


def all_terms(index: DataFrame, text: str, key: str = "uid") -> DataFrame:
    return holding_all(index, "term", query_terms(text), key)


def any_term(index: DataFrame, text: str, key: str = "uid") -> DataFrame:
    return index.where(F.col("term").isin(query_terms(text))).select(key).distinct()


# trigrams --------------------------------------------------------------------
def trigram_index(df: DataFrame, column: str, key: str = "uid") -> DataFrame:
    return df.select(F.explode(tx.trigrams(F.col(column))).alias("trigram"), key)


def required_trigrams(pattern: str) -> list[str]:
    """Trigrams every match must contain, from plain runs of the pattern. Empty (no
    prefilter) where that is not certain: alternatives, groups, or ignored case."""
    java = to_java_pattern(pattern)
    if java.startswith("(?") or re.search(r"[|()\[\]\\{]", java):
        return []
    runs = re.sub(r".[*?][?+]*", "\0", java)  # an optional character ends a run
    runs = re.sub(r"[.+*?^$]", "\0", runs)
    return sorted({run[i : i + 3] for run in runs.split("\0") for i in range(len(run) - 2)})


def regexp_search(df: DataFrame, index: DataFrame, column: str, pattern: str, key: str = "uid") -> DataFrame:
    """Candidates that hold all required trigrams, rechecked with the pattern; without
    required trigrams every row is rechecked."""
    needed = required_trigrams(pattern)
    matches = F.col(column).rlike(to_java_pattern(pattern))
    if not needed:
        return df.where(matches)
    hits = holding_all(index, "trigram", needed, key).withColumn("_hit", F.monotonically_increasing_id() >= 0)
    # The test needs a column of the hits, so it runs behind the join, on candidates only.
    return df.join(hits, key).where(F.when(F.col("_hit"), matches).otherwise(False)).select(*df.columns)


# date buckets ----------------------------------------------------------------
def with_bucket(df: DataFrame, column: str, unit: str) -> DataFrame:
    return df.withColumn("bucket", F.date_trunc(unit, F.col(column)).cast("timestamp_ntz"))


def bucket_lookup(bucketed: DataFrame, column: str, unit: str, low, high) -> DataFrame:
    """Rows with low <= time < high: whole buckets first (partition or file pruning), then
    the exact bounds."""
    trunc = lambda t: F.date_trunc(unit, F.lit(t)).cast("timestamp_ntz")
    within = (F.col("bucket") >= trunc(low)) & (F.col("bucket") <= trunc(high))
    return bucketed.where(within & (F.col(column) >= F.lit(low)) & (F.col(column) < F.lit(high)))


# geo -------------------------------------------------------------------------
def geo_index(points: DataFrame, levels: Column) -> DataFrame:
    """(level, x, y) cells of every point at the given levels (an array)."""
    filed = points.select("uid", "lon", "lat", F.explode(levels).alias("_level"))
    return filed.withColumns({"_x": geo.cell_x(F.col("lon"), F.col("_level")), "_y": geo.cell_y(F.col("lat"), F.col("_level"))})


def near(points: DataFrame, centres: DataFrame) -> DataFrame:
    """(centre, uid, metres) for points within each centre's radius. `points` has uid, lon,
    lat; `centres` has centre, lon, lat, radius. An equi-join on grid cells, exact recheck. A
    centre looks at the level that fits its radius, so a cell holds about as many points as a
    few results; points are filed under the levels in use only."""
    asked = centres.withColumn("_level", geo.level_of(F.col("lat"), F.col("radius")))
    filed = geo_index(points, asked.agg(F.collect_set("_level")).scalar())  # 25 levels at most
    wanted = asked.select(
        "centre", F.col("lon").alias("_lon"), F.col("lat").alias("_lat"), "radius", "_level",
        F.explode(geo.covering_cells(F.col("lon"), F.col("lat"), F.col("radius"), F.col("_level"))).alias("_c"),
    ).select("centre", "_lon", "_lat", "radius", "_level", F.col("_c.x").alias("_x"), F.col("_c.y").alias("_y"))
    metres = geo.haversine(F.col("_lon"), F.col("_lat"), F.col("lon"), F.col("lat"))
    return (
        filed.join(wanted, ["_level", "_x", "_y"])
        .withColumn("metres", metres)
        .where(F.col("metres") <= F.col("radius"))
        .select("centre", "uid", "metres")
    )


# vectors ---------------------------------------------------------------------
MAX_QUERIES, QUERY_BLOCK = 256, 2048


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def similarity(metric: str, a: Column, b: Column) -> Column:
    """Euclidean distance, dot product or cosine, in double; null cosine for a zero vector."""
    if metric == "euclidean":
        squares = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, p: acc + p))
    if metric == "dot":
        return _dot(a, b)
    if metric == "cosine":
        norm = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
        return F.when(norm > 0, _dot(a, b) / norm)
    raise ValueError(f"unknown metric {metric}")


def _score_batches(metric: str, k: int, ids: list, matrix):
    """Score whole Arrow batches against the query matrix; each batch hands on only its
    best k rows per query (ties at the edge included), so the shuffle stays small."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    size = matrix.shape[1]
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    sign = 1.0 if metric == "euclidean" else -1.0

    def run(batches):
        for batch in batches:
            batch = batch.filter(pc.equal(pc.list_value_length(batch.column("embedding")), size))
            if batch.num_rows == 0:
                continue
            cells = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
            data = cells.astype(np.float64).reshape(-1, size)
            if metric == "euclidean":
                score = np.stack([np.sqrt(((data - q) ** 2).sum(axis=1)) for q in matrix], axis=1)
            else:
                score = data @ matrix.T
            if metric == "cosine":
                with np.errstate(divide="ignore", invalid="ignore"):
                    score = score / (np.sqrt((data * data).sum(axis=1))[:, None] * norms[None, :])
            uids = batch.column("uid").to_numpy(zero_copy_only=False)
            for j, query_id in enumerate(ids):
                column = np.round(score[:, j], 9)
                usable = np.flatnonzero(np.isfinite(column))
                if len(usable) > k:
                    edge = np.partition(sign * column[usable], k - 1)[k - 1]
                    usable = usable[sign * column[usable] <= edge]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(usable), query_id, dtype=np.int64)), pa.array(uids[usable]), pa.array(column[usable])],
                    names=["query", "uid", "score"],
                )

    return run


def other_length(vectors: DataFrame, size: int) -> DataFrame:
    """Vectors `top_k` cannot compare with queries of `size` cells: nulls and other lengths."""
    return vectors.where(F.coalesce(F.size("embedding") != size, F.lit(True)))


def top_k(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "euclidean") -> DataFrame:
    """Exact k best vectors per query: (query, uid, score, rank); ties by uid.

    `vectors` has uid, embedding; `queries` has query (long), embedding. Up to MAX_QUERIES query
    vectors are parameters of one scan; more are packed into blocks of QUERY_BLOCK, and chunks of the
    vectors stream past every block (`plans.blocks`), so the work is the product of the two numbers,
    as matrix products over all tasks, and no task holds more than one block. Vectors of another length
    are left out (`other_length` has them), as are undefined cosines."""
    import numpy as np

    queries = queries.select("query", "embedding")
    first = F.col("score").asc() if metric == "euclidean" else F.col("score").desc()
    best = Window.partitionBy("query").orderBy(first, F.col("uid").asc())
    rows = queries.limit(MAX_QUERIES + 1).collect()
    if not rows:
        return vectors.sparkSession.createDataFrame([], "query long, uid long, score double, rank int")
    if len(rows) > MAX_QUERIES:
        scored = _scored_blocks(vectors, queries, k, metric)
    else:
        ids, matrix = [r["query"] for r in rows], np.array([r["embedding"] for r in rows], dtype=np.float64)
        scored = vectors.select("uid", "embedding").mapInArrow(
            _score_batches(metric, k, ids, matrix), "query long, uid long, score double"
        )
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _scored_blocks(vectors: DataFrame, queries: DataFrame, k: int, metric: str) -> DataFrame:
    """(query, uid, score) of what can be among the best `k`: every vector against every query. Matrix
    products with their error bounds sift the pairs; those left are scored as in `_score_batches`."""
    import numpy as np

    def matrix(batch):
        cells = batch.column("embedding")
        size = cells.value_lengths().to_numpy(zero_copy_only=False)
        if len(set(size)) > 1 or np.isnan(size).any():
            raise ValueError("queries of one block have vectors of one length")
        return cells.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(cells), int(size[0]))

    def blocks(batch):
        for at in range(0, batch.num_rows, QUERY_BLOCK):
            part = batch.slice(at, QUERY_BLOCK)
            points = matrix(part)
            yield {"block": block_name(), "size": points.shape[1], "queries": packed_bytes(part.column("query").to_numpy()), "points": packed_bytes(points)}

    def chunks(batch):
        batch = batch.filter(batch.column("embedding").is_valid())
        sizes = batch.column("embedding").value_lengths().to_numpy(zero_copy_only=False)
        for size in set(sizes.tolist()):
            rows = np.flatnonzero(sizes == size)
            for at in range(0, len(rows), CHUNK):
                part = batch.take(rows[at : at + CHUNK])
                yield {"kind": 0, "size": int(size), "uids": packed_bytes(part.column("uid").to_numpy()), "body": packed_bytes(matrix(part))}

    def bounds(points, wanted, chunk):
        if chunk["size"] != points.shape[1]:
            return None
        data = np.frombuffer(chunk["body"]).reshape(len(chunk["uids"]) // 8, chunk["size"])
        a, b, product = (points**2).sum(axis=1)[:, None], (data**2).sum(axis=1)[None, :], points @ data.T
        with np.errstate(divide="ignore", invalid="ignore"):
            if metric == "euclidean":
                off = (a + b) * product_error(chunk["size"])
                about = a + b - 2 * product
            elif metric == "dot":
                about, off = -product, (a + b) * product_error(chunk["size"])
            else:
                norm = np.sqrt(a) * np.sqrt(b)
                about, off = -product / np.where(norm > 0, norm, np.nan), product_error(chunk["size"])
            off = off + 1e-8 * (1 + np.abs(about))  # scores are compared to nine digits
            bad = ~np.isfinite(about)
            return np.where(bad, np.nan, about - off), np.where(bad, np.nan, about + off)

    asked = written(queries.select(F.monotonically_increasing_id().alias("row"), F.col("query").cast("long").alias("query"), F.col("embedding").alias("asked")), "asked")
    full = asked.select(F.col("row").alias("query"), F.col("asked").alias("embedding")).repartition(-(-asked.count() // QUERY_BLOCK), "query")
    packed = written(emitted(full, blocks, BLOCKS, BLOCK_TYPES), "blocks")
    rows = emitted(vectors.select(F.col("uid").cast("long"), "embedding"), chunks, CHUNKS, CHUNK_TYPES)
    names = packed.agg(F.collect_list("block")).scalar()  # one for QUERY_BLOCK queries
    found = best_of(packed, rows.select(F.explode(names).alias("block"), F.lit(0).alias("place"), "*"), k, bounds)

    def score(batches):
        for batch in batches:
            a, b = (np.asarray(batch.column(n).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, -1) for n in ("asked", "embedding"))
            if metric == "euclidean":
                exact = np.sqrt(((a - b) ** 2).sum(axis=1))
            else:
                exact = (a * b).sum(axis=1)
            if metric == "cosine":
                exact = exact / (np.sqrt((b * b).sum(axis=1)) * np.sqrt((a * a).sum(axis=1)))
            yield type(batch).from_pydict({"query": batch.column("query"), "uid": batch.column("uid"), "score": np.round(exact, 9)})

    pairs = found.select(F.col("query").alias("row"), "uid").distinct().join(vectors.select(F.col("uid").cast("long").alias("uid"), "embedding"), "uid").join(asked, "row")
    pairs = pairs.where(F.size("asked") == F.size("embedding")).select("query", "uid", "asked", "embedding")
    return pairs.mapInArrow(score, "query long, uid long, score double").where(~F.isnan("score") & (F.abs("score") < F.lit(float("inf"))))


def similar_pairs(vectors: DataFrame, queries: DataFrame, threshold: float, bucket: float | None = None, tables: int = 4, seed: int = 7) -> DataFrame:
    """Approximate Euclidean neighbours by random projections: (query, uid, distance) within
    `threshold`. Recall is below one; `top_k` is the exact form.

    Without `bucket` its length is four deviations of what a projection makes of two vectors at
    the threshold, by the cells of the vectors: such a pair shares a bucket in 0.8 of the tables."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    if bucket is None:
        cells = queries.agg(F.max(F.size("embedding"))).first()[0]
        bucket = 4 * threshold / max(1, cells or 1) ** 0.5
    data = vectors.select("uid", array_to_vector("embedding").alias("v"))
    asked = queries.select("query", array_to_vector("embedding").alias("v"))
    model = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=bucket, numHashTables=tables, seed=seed).fit(data)
    pairs = model.approxSimilarityJoin(asked, data, threshold, distCol="distance")
    return pairs.select(F.col("datasetA.query").alias("query"), F.col("datasetB.uid").alias("uid"), "distance")


# materialised indexes --------------------------------------------------------
def inverted_lists(index: DataFrame, page_size: int = PAGE_SIZE, key: str = "uid") -> DataFrame:
    """(predicate, term, page) -> sorted uids, for an index of (predicate, term, uid) rows.
    A common term becomes several pages instead of one huge list."""
    rows = index.select("predicate", "term", key)
    return nest(rows, ["predicate", "term"], [key], out="uids", page_size=page_size, keep=True)


def reverse_index(edges: DataFrame) -> DataFrame:
    """Edges by target, range-partitioned by (target, source): a hot target is split over
    partitions, and a lookup of one target touches adjacent files only."""
    others: Sequence[str] = [c for c in edges.columns if c not in ("src", "dst")]
    flipped = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *others)
    return flipped.repartitionByRange("src", "dst").sortWithinPartitions("src", "dst")
