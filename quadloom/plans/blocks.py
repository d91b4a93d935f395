"""Many queries against many rows, block by block.

Queries are packed into blocks, the rows they are compared with into chunks, both as bytes of numpy
arrays. Chunks meet the blocks that ask for them, in `PARTS` shares a block, and stream through a
task that holds one block and the best of each of its queries so far: no row is made per pair."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Shares of a block's chunks, and rows of a chunk at most.
PARTS, CHUNK = 8, 4096
CHUNKS = "kind int, size int, uids binary, body binary, scale binary, error binary"
BLOCKS = "block string, size int, queries binary, points binary, wanted binary, cells array<struct<kind: int, place: int>>"
FOUND = "query long, uid long, lower double, upper double"
_B, _I = pa.binary(), pa.int32()
CHUNK_TYPES = pa.schema([("kind", _I), ("size", _I), ("uids", _B), ("body", _B), ("scale", _B), ("error", _B)])
BLOCK_TYPES = pa.schema([("block", pa.string()), ("size", _I), ("queries", _B), ("points", _B), ("wanted", _B), ("cells", pa.list_(pa.struct([("kind", _I), ("place", _I)])))])


def emitted(df: DataFrame, fn: Callable, schema: str, types: pa.Schema) -> DataFrame:
    """Rows that `fn` makes of a batch, handed on one by one: each holds many input rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in fn(batch) if batch.num_rows else ():
                yield pa.RecordBatch.from_pylist([row], types)

    return df.mapInArrow(run, schema)


def packed_bytes(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def block_name() -> str:
    return uuid.uuid4().hex


def product_error(size: int) -> float:
    """What |a|^2 + |b|^2 - 2ab of vectors of `size` cells may be off by, as a share of |a|^2 + |b|^2;
    ten times the proven bound."""
    return 20 * (size + 4) * np.finfo(np.float64).eps


class Best:
    """The pairs that can be among the best `k` of their query: lower bound up to the k-th least upper bound."""

    def __init__(self, n: int, k: int):
        self.n, self.k, self.limit = n, k, np.full(n, np.inf)
        self.kept, self.fresh, self.held = [], 0, 0

    def add(self, uids: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> None:
        """Bounds of every query (row) and uid (column); nan where a pair does not count."""
        hit = lower <= self.limit[:, None]
        if hit.sum() > 4 * self.k * self.n and lower.shape[1] > self.k:
            nearest = np.partition(np.where(np.isnan(upper), np.inf, upper), self.k - 1, axis=1)[:, self.k - 1]
            self.limit = np.minimum(self.limit, nearest)
            hit = lower <= self.limit[:, None]
        i, j = np.nonzero(hit)
        if len(i):
            self.kept.append((i, uids[j], lower[i, j], upper[i, j]))
            self.fresh += len(i)
            if self.fresh > max(1 << 16, self.held):
                self.prune()

    def prune(self) -> tuple[np.ndarray, ...]:
        """(row, uid, lower, upper) of what is left."""
        if not self.kept:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        row, uid, lower, upper = (np.concatenate(c) for c in zip(*self.kept))
        order = np.lexsort((upper, row))
        first = np.flatnonzero(np.r_[True, row[order][1:] != row[order][:-1]])
        sizes = np.diff(np.r_[first, len(order)])
        full = sizes >= self.k
        at = row[order][first[full]]
        self.limit[at] = np.minimum(self.limit[at], upper[order][first[full] + self.k - 1])
        keep = np.flatnonzero(lower <= self.limit[row])
        self.kept = [(row[keep], uid[keep], lower[keep], upper[keep])]
        self.fresh, self.held = 0, len(keep)
        return self.kept[0]


def best_of(blocks: DataFrame, chunks: DataFrame, k: int, bounds: Callable) -> DataFrame:
    """(query, uid, lower, upper) of the pairs that can be among the best `k` of a query, by a share of
    its chunks.

    `blocks` has block, queries, points, wanted and size, one row each; `chunks` has block, place (the
    order to look into them) and CHUNKS. `bounds(points, wanted, chunk)` gives the lower and upper
    bounds of all queries and rows, nan for pairs that do not count, or nothing at all."""
    none = lambda kind: F.lit(None).cast(kind)
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    heads = blocks.select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"), F.lit(-1).alias("place"), F.lit(-1).alias("kind"), "size",
        F.col("queries").alias("uids"), F.col("points").alias("body"), F.col("wanted").alias("scale"), none("binary").alias("error"))
    rows = chunks.select("block", F.pmod(F.xxhash64("uids"), F.lit(PARTS)).cast("int").alias("part"), "place", *names)
    streams = heads.unionByName(rows).repartition("block", "part").sortWithinPartitions("block", "part", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = queries = points = wanted = None

        def left() -> pa.RecordBatch:
            row, uid, lower, upper = best.prune()
            return pa.RecordBatch.from_pydict({"query": pa.array(queries[row]), "uid": pa.array(uid), "lower": pa.array(lower), "upper": pa.array(upper)})

        for batch in batches:
            for line in batch.to_pylist():
                if line["place"] < 0:
                    if best is not None:
                        yield left()
                    queries = np.frombuffer(line["uids"], np.int64)
                    points = np.frombuffer(line["body"], np.float64).reshape(len(queries), line["size"])
                    wanted = None if line["scale"] is None else np.unpackbits(np.frombuffer(line["scale"], np.uint8).reshape(len(queries), -1), axis=1)
                    best = Best(len(queries), k)
                elif (found := bounds(points, wanted, line)) is not None:
                    best.add(np.frombuffer(line["uids"], np.int64), *found)
        if best is not None:
            yield left()

    return streams.mapInArrow(run, FOUND)
