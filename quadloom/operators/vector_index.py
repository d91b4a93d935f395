"""A stored vector index: an inverted file of k-means cells with residual codes.

All metrics become Euclidean distance between points: a vector as it is (euclidean), of length one
(cosine), or with one more component that brings every vector to the length of the longest (dot).
Cells are fitted on a bounded sample; every vector is filed in the cell of its nearest centre as eight
bits a component of what it differs from the centre by, with the exact error of that code. So a code
bounds the distance from both sides, and only vectors whose bound can be among the best are read
and scored. A search looks into the cells nearest to the query; with `exact` it goes on with every
cell whose radius lets it hold a better vector, and its result is that of a full scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quadloom.operators.search import top_k, write_sorted
from quadloom.plans.blocks import BLOCK_TYPES, BLOCKS, CHUNK, CHUNK_TYPES, CHUNKS, best_of, block_name, emitted, packed_bytes, product_error
from quadloom.plans.cut import written

#: Vectors the cells are fitted on at most (SAMPLE, and PER_CELL for each cell), cells at most, and
#: sample queries the number of probes is measured with.
SAMPLE, PER_CELL, MAX_CELLS, TRIALS = 65_536, 64, 4096, 256
METRICS = ("euclidean", "dot", "cosine")
#: Queries of a block.
BLOCK = 512
ASKED = "query long, point array<double>, cells array<int>"
CODES = "uid long, code binary, scale double, error double, away double, cell int"


def lifted(matrix: np.ndarray, metric: str, longest: float, query: bool = False) -> np.ndarray:
    """Rows as points whose Euclidean order is that of the metric."""
    if metric == "cosine":
        return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    if metric == "dot":
        rest = np.zeros((len(matrix), 1)) if query else np.sqrt(np.maximum(0.0, longest**2 - (matrix * matrix).sum(axis=1, keepdims=True)))
        return np.hstack([matrix, rest])
    return matrix


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def _lists(matrix: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1], pa.array(matrix.ravel()))


def _mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(fn(batch))

    return df.mapInArrow(run, schema)


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None, :] - 2 * points @ centres.T
    return np.sqrt(np.maximum(squares, 0.0))


def comparable(vectors: DataFrame, size: int, metric: str) -> DataFrame:
    """Vectors of `size` finite components, with cosine also of some length."""
    fine = (F.size("embedding") == size) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    if metric == "cosine":
        fine = fine & F.exists("embedding", lambda x: x != 0)
    return vectors.where(F.coalesce(fine, F.lit(False)))


@dataclass
class VectorIndex:
    """What a search needs of a stored index: the centres, their radii and row counts (at most
    MAX_CELLS of them) and two tables, `codes` (in folders by cell) and `vectors` (by uid)."""

    spark: SparkSession
    folder: str
    metric: str
    size: int
    longest: float
    probes: int
    centres: np.ndarray
    radius: np.ndarray
    rows: np.ndarray

    def codes(self) -> DataFrame:
        return self.spark.read.schema(CODES).parquet(f"{self.folder}/codes")

    def vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/vectors")

    def point(self, matrix: np.ndarray) -> np.ndarray:
        return lifted(matrix, self.metric, self.longest, query=True)

    def share_read(self, queries: DataFrame, probes: int | None = None) -> float:
        """The share of rows whose codes a search reads, over all queries."""
        looked = self._probed(queries, probes or self.probes).select(F.explode("cells").alias("cell")).groupBy("cell").count().collect()  # one line per cell
        asked = sum(r["count"] for r in looked)
        read = sum(r["count"] * int(self.rows[r["cell"]]) for r in looked)
        return read / max(1, self.rows.sum() * asked / (min(probes or self.probes, len(self.rows)) or 1))

    def _probed(self, queries: DataFrame, probes: int) -> DataFrame:
        """(query, point, cells) with the cells nearest to each query, the nearest first."""
        shared = self.spark.sparkContext.broadcast((self.centres, self.metric, self.longest))

        def nearest(batch: pa.RecordBatch) -> dict:
            centres, metric, longest = shared.value
            points = lifted(_matrix(batch.column("embedding")), metric, longest, query=True)
            cells = np.argsort(_distances(points, centres), axis=1, kind="stable")[:, :probes]
            return {"query": batch.column("query"), "point": _lists(points), "cells": _lists(cells.astype(np.int32))}

        asked = comparable(queries, self.size, self.metric).select(F.col("query").cast("long").alias("query"), "embedding")
        return _mapped(asked, nearest, ASKED)

    def _others(self, queries: DataFrame, limits: DataFrame, probes: int) -> DataFrame:
        """(query, point, cells) with the cells behind the first `probes` that may hold a point as
        near as the query's limit."""
        shared = self.spark.sparkContext.broadcast((self.centres, self.radius, self.metric, self.longest))

        def possible(batch: pa.RecordBatch) -> dict:
            centres, radius, metric, longest = shared.value
            points = lifted(_matrix(batch.column("embedding")), metric, longest, query=True)
            away, limit = _distances(points, centres), batch.column("limit").to_numpy(zero_copy_only=False)
            order = np.argsort(away, axis=1, kind="stable")[:, probes:]
            near = np.maximum(0.0, away - radius[None, :]) <= limit[:, None] * (1 + 1e-9) + 1e-9
            cells = [row[near[i, row]].astype(np.int32) for i, row in enumerate(order)]
            return {"query": batch.column("query"), "point": _lists(points), "cells": pa.array(cells, pa.list_(pa.int32()))}

        asked = comparable(queries, self.size, self.metric).select(F.col("query").cast("long").alias("query"), "embedding")
        asked = asked.join(limits, "query", "left").select("query", "embedding", F.coalesce("limit", F.lit(float("inf"))).alias("limit"))
        return _mapped(asked, possible, ASKED).where(F.size("cells") > 0)

    def _bounded(self, asked: DataFrame, k: int) -> DataFrame:
        """(query, uid, lower, upper) bounds of the distances to the vectors of the cells asked for.
        Blocks of queries with near first cells meet the codes of a cell as a whole; what can be among
        the best k of a query is handed on."""
        shared = self.spark.sparkContext.broadcast(self.centres)

        def blocks(batch: pa.RecordBatch) -> Iterator[dict]:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                cells = [np.asarray(c, np.int32) for c in part.column("cells").to_pylist()]
                wanted, place = np.zeros((len(cells), len(shared.value)), bool), np.full(len(shared.value), 1 << 30, np.int32)
                for i, c in enumerate(cells):
                    wanted[i, c], place[c] = True, np.minimum(place[c], np.arange(len(c)))
                points, some = _matrix(part.column("point")), np.flatnonzero(wanted.any(axis=0))
                yield {"block": block_name(), "size": points.shape[1], "queries": packed_bytes(part.column("query").to_numpy()), "points": packed_bytes(points),
                       "wanted": packed_bytes(np.packbits(wanted, axis=1)), "cells": [{"kind": int(c), "place": int(place[c])} for c in some]}

        def chunks(batch: pa.RecordBatch) -> Iterator[dict]:
            cell, uid, scale, error = (batch.column(n).to_numpy() for n in ("cell", "uid", "scale", "error"))
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.int8).reshape(batch.num_rows, -1)
            for c in np.unique(cell):
                rows = np.flatnonzero(cell == c)
                for at in range(0, len(rows), CHUNK):
                    x = rows[at : at + CHUNK]
                    yield {"kind": int(c), "size": code.shape[1], "uids": packed_bytes(uid[x]), "body": packed_bytes(code[x]), "scale": packed_bytes(scale[x]), "error": packed_bytes(error[x])}

        def bounds(points: np.ndarray, wanted: np.ndarray, chunk: dict) -> tuple | None:
            rows = np.flatnonzero(wanted[:, chunk["kind"]])
            scale, error = np.frombuffer(chunk["scale"]), np.frombuffer(chunk["error"])
            rest = np.frombuffer(chunk["body"], np.int8).reshape(len(scale), -1) * scale[:, None]
            residual = points[rows] - shared.value[chunk["kind"]]
            both = (residual**2).sum(axis=1)[:, None] + (rest**2).sum(axis=1)[None, :]
            square, off = both - 2 * residual @ rest.T, both * product_error(rest.shape[1])
            nearest, farthest = np.sqrt(np.maximum(square - off, 0.0)), np.sqrt(np.maximum(square + off, 0.0))
            slack = error[None, :] + 1e-9 * (1 + farthest)
            lower, upper = np.full((2, len(points), len(scale)), np.nan)
            lower[rows], upper[rows] = np.maximum(0.0, nearest - slack), farthest + slack
            return lower, upper

        near = asked.repartitionByRange(F.col("cells")[0], "query").sortWithinPartitions(F.col("cells")[0], "query")
        packed = written(emitted(near, blocks, BLOCKS, BLOCK_TYPES), "blocks")
        looked = packed.select("block", F.inline("cells"))
        return best_of(packed, looked.join(emitted(self.codes(), chunks, CHUNKS, CHUNK_TYPES), "kind"), k, bounds)

    def _scored(self, found: DataFrame, queries: DataFrame) -> DataFrame:
        """(query, uid, score, away): the exact similarity and the distance of the points."""
        metric, longest = self.metric, self.longest

        def score(batch: pa.RecordBatch) -> dict:
            a, b = _matrix(batch.column("asked")), _matrix(batch.column("embedding"))
            points = lifted(a, metric, longest, query=True) - lifted(b, metric, longest)
            away = np.sqrt((points**2).sum(axis=1))
            exact = np.sqrt(((a - b) ** 2).sum(axis=1)) if metric == "euclidean" else (a * b).sum(axis=1)
            if metric == "cosine":
                exact = exact / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
            return {"query": batch.column("query"), "uid": batch.column("uid"), "score": pa.array(np.round(exact, 9)), "away": pa.array(away)}

        asked = queries.select(F.col("query").cast("long").alias("query"), F.col("embedding").alias("asked"))
        rows = found.select("query", "uid").join(self.vectors(), "uid").join(asked, "query").select("query", "uid", "asked", "embedding")
        return _mapped(rows, score, "query long, uid long, score double, away double")

    def search(self, queries: DataFrame, k: int, probes: int | None = None, exact: bool = False) -> DataFrame:
        """The best `k` vectors per query: (query, uid, score, rank), ties by uid.

        Looks into the `probes` cells nearest to each query, by default the number measured when the
        index was built. With `exact`, all other cells that may hold a better vector follow. Scores
        are exact either way. Queries the metric cannot compare give no rows."""
        probes = probes or self.probes
        near = written(self._bounded(self._probed(queries, probes), k), "bounds")
        nearest = Window.partitionBy("query").orderBy("upper")
        limits = near.withColumn("n", F.row_number().over(nearest)).where(F.col("n") == k).select("query", (F.col("upper") * (1 + 1e-7) + 1e-7).alias("limit"))
        open_end = lambda column: F.coalesce(column, F.lit(float("inf")))
        found = near.join(limits, "query", "left").where(F.col("lower") <= open_end(F.col("limit")))
        scored = self._scored(found, queries)
        first = F.col("score").asc() if self.metric == "euclidean" else F.col("score").desc()
        best = Window.partitionBy("query").orderBy(first, F.col("uid").asc())
        if exact:
            scored = written(scored, "scored")
            reached = scored.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("away"))).where(F.col("n") == k)
            reached = written(reached.select("query", (F.col("away") * (1 + 1e-7) + 1e-7).alias("limit")), "limits")
            more = self._bounded(self._others(queries, reached, probes), k).join(reached, "query", "left")
            scored = scored.unionByName(self._scored(more.where(F.col("lower") <= open_end(F.col("limit"))), queries))
        ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return ranked.select("query", "uid", "score", "rank")


def build(vectors: DataFrame, folder: str, metric: str = "euclidean", cells: int | None = None, recall: float = 0.95, k: int = 10, seed: int = 7) -> VectorIndex:
    """Index every row of `vectors` (uid, embedding) into `folder`.

    Cells (default the root of the number of rows, MAX_CELLS at most) are k-means centres of at most
    PER_CELL vectors a cell and SAMPLE in all, taken by a hash of the uid. How many of them a search
    looks into is measured: the fewest that hold `recall` of the true `k` neighbours of at most
    TRIALS sample vectors. Vectors of another length than the longest, with null or non-finite
    components, or of no length (cosine) are not indexed (`search.other_length` has the first)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}")
    spark, folder = vectors.sparkSession, folder.rstrip("/")
    size = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    rows = comparable(vectors.select(F.col("uid").cast("long").alias("uid"), "embedding"), size, metric)
    write_sorted(rows, f"{folder}/vectors", "uid")
    rows = spark.read.schema(rows.schema).parquet(f"{folder}/vectors")
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    n, longest = rows.agg(F.count(F.lit(1)), F.max(length)).first()
    longest = float(longest or 0.0) * (1 + 1e-12)
    cells = max(1, min(cells or round(n**0.5), MAX_CELLS, n or 1))

    sample = written(rows.orderBy(F.xxhash64("uid", F.lit(seed))).limit(min(SAMPLE, PER_CELL * cells)), "sample")
    points = _mapped(sample, lambda b: {"point": _lists(lifted(_matrix(b.column("embedding")), metric, longest))}, "point array<double>")
    if cells > 1:
        model = KMeans(k=cells, seed=seed, maxIter=10, featuresCol="v").fit(points.select(array_to_vector("point").alias("v")).repartition(8))
        centres = np.array(model.clusterCenters(), np.float64)
    else:  # any point serves as the centre of a single cell
        centres = np.array([p["point"] for p in points.limit(1).collect()] or np.zeros((1, size + (metric == "dot"))), np.float64)
    shared = spark.sparkContext.broadcast(centres)  # MAX_CELLS rows at most

    def filed(batch: pa.RecordBatch) -> dict:
        at = lifted(_matrix(batch.column("embedding")), metric, longest)
        cell = _distances(at, shared.value).argmin(axis=1)
        rest = at - shared.value[cell]
        scale = np.abs(rest).max(axis=1, initial=0.0) / 127
        scale[scale == 0] = 1.0
        code = np.rint(rest / scale[:, None]).astype(np.int8)
        error = np.sqrt(((rest - code * scale[:, None]) ** 2).sum(axis=1))
        return {"uid": batch.column("uid"), "cell": pa.array(cell.astype(np.int32)), "code": pa.array([c.tobytes() for c in code], pa.binary()),
                "scale": pa.array(scale), "error": pa.array(error), "away": pa.array(np.sqrt((rest**2).sum(axis=1)))}

    codes = _mapped(rows, filed, "uid long, cell int, code binary, scale double, error double, away double")
    codes.hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{folder}/codes")
    sums = spark.read.schema(CODES).parquet(f"{folder}/codes").groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("rows"))
    radius, held = np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    for r in sums.collect():  # one line per cell
        radius[r["cell"]], held[r["cell"]] = r["radius"] * (1 + 1e-9), r["rows"]
    index = VectorIndex(spark, folder, metric, size, longest, min(8, len(centres)), centres, radius, held)
    index.probes = _measured(index, sample.limit(TRIALS), k, recall)
    lines = [(i, c.tolist(), float(r), int(h)) for i, (c, r, h) in enumerate(zip(centres, radius, held))]
    spark.createDataFrame(lines, "cell int, centre array<double>, radius double, rows long").coalesce(1).write.parquet(f"{folder}/cells")
    spark.createDataFrame([(metric, size, longest, index.probes)], "metric string, size int, longest double, probes int").coalesce(1).write.parquet(f"{folder}/meta")
    return index


def _measured(index: VectorIndex, sample: DataFrame, k: int, recall: float) -> int:
    """The fewest cells that hold `recall` of the sample's true neighbours, from the rank of the
    cell each of them is filed in."""
    queries = written(sample.select(F.col("uid").alias("query"), "embedding"), "trials")
    true = index.search(queries, k, exact=True).where("query != uid")
    cells = index.codes().select("uid", "cell")
    places = index._probed(queries, len(index.centres)).select("query", F.posexplode("cells").alias("place", "cell")).withColumn("place", F.col("place") + 1)
    counts = dict(true.join(cells, "uid").join(places, ["query", "cell"]).groupBy("place").count().collect())  # one line per cell at most
    total, seen = sum(counts.values()), 0
    for probes in range(1, len(index.centres) + 1):
        seen += counts.get(probes, 0)
        if seen >= recall * total:
            return probes
    return len(index.centres)


def open_index(spark: SparkSession, folder: str) -> VectorIndex:
    """An index written by `build`."""
    folder = folder.rstrip("/")
    meta = spark.read.parquet(f"{folder}/meta").first()
    cells = sorted(spark.read.parquet(f"{folder}/cells").collect())
    return VectorIndex(spark, folder, meta["metric"], meta["size"], meta["longest"], meta["probes"], np.array([c["centre"] for c in cells], np.float64).reshape(len(cells), -1),
                       np.array([c["radius"] for c in cells]), np.array([c["rows"] for c in cells], np.int64))


def recall_of(found: DataFrame, vectors: DataFrame, queries: DataFrame, k: int, metric: str) -> DataFrame:
    """(query, found, true, hits) against the full scan; equally good neighbours count as hits."""
    true = top_k(vectors, queries, k, metric)
    sign = 1 if metric == "euclidean" else -1
    edge = written(true.groupBy("query").agg(F.max(sign * F.col("score")).alias("edge"), F.count(F.lit(1)).alias("true")), "edges")  # read twice
    near = found.join(edge, "query").groupBy("query").agg(
        F.count(F.lit(1)).alias("found"), F.sum((sign * F.col("score") <= F.col("edge") + 1e-9).cast("long")).alias("hits"))
    return edge.select("query", "true").join(near, "query", "left").select("query", F.coalesce("found", F.lit(0)).alias("found"), "true", F.coalesce("hits", F.lit(0)).alias("hits"))
