"""Hard negatives by segment summaries: bounds of a score from each segment's mean and deviation.

The part of an inner product that falls to a segment of d components is d * (mean * mean') plus the
product of what is left of both, which is at most d * (deviation * deviation') in size. So the sums
over segments bound a score from both sides by a few numbers a segment. Summaries are stored for 1, 4,
16, ... segments of a vector, each of which splits those before it: a pair is first bounded by one
segment, what may still count is bounded by the next finer ones, and what is left is scored exactly.

Anchors are a stated set, asked in blocks against all rows: rows are spread over slices, a cell is
a block of anchors and a slice of rows, and streams its rows past its anchors. Limits get tighter
as the stream goes on (the scores an anchor has already), so most rows fall to the bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from quadloom.llm.tables import map_batches
from quadloom.plans.cut import written

#: Components of a cell's anchors (64 MB), rows of a slice, anchors and rows compared at a time.
BLOCK, SLICE, ANCHORS_AT_ONCE, ROWS_AT_ONCE = 1 << 23, 1_000_000, 1024, 512
LONG = (-(1 << 63), (1 << 63) - 1)
#: Sums of products up to here are whole numbers in a double.
EXACT = 1 << 53


def levels(size: int) -> list[np.ndarray]:
    """Bounds of 1, 4, 16, ... segments, of four components or more each."""
    out, n = [np.array([0, size])], 4
    while 4 * n <= size:
        out.append(np.linspace(0, size, n + 1).astype(int))
        n *= 4
    return out


def summaries(vectors: np.ndarray) -> np.ndarray:
    """Per row and level the segments' means, then their deviations, each times the root of the
    segment's length, so that sums over segments are plain inner products."""
    out = []
    for bounds in levels(vectors.shape[1]):
        length = np.maximum(np.diff(bounds), 1)
        starts = bounds[:-1]
        if vectors.shape[1] == 0:
            out += [np.zeros((len(vectors), 1))] * 2
            continue
        mean = np.add.reduceat(vectors, starts, axis=1) / length
        rest = vectors - np.repeat(mean, length, axis=1)
        out += [mean * np.sqrt(length), np.sqrt(np.add.reduceat(rest * rest, starts, axis=1))]
    return np.hstack(out) if out else np.zeros((len(vectors), 0))


def spans(size: int) -> list[tuple[slice, slice]]:
    """Where in a summary a level's means and deviations are."""
    out, at = [], 0
    for bounds in levels(size):
        n = len(bounds) - 1
        out.append((slice(at, at + n), slice(at + n, at + 2 * n)))
        at += 2 * n
    return out


class Vectors:
    """Some rows: number, id, label, components and summaries. Ids may be null."""

    def __init__(self, number, vec_id, no_id, label, cells, summary, bands=None):
        self.number, self.vec_id, self.no_id, self.label = number, vec_id, no_id, label
        self.cells, self.summary, self.bands = cells, summary, bands
        self.most = np.abs(cells).max(axis=1, initial=0.0)

    def part(self, which) -> "Vectors":
        return Vectors(self.number[which], self.vec_id[which], self.no_id[which], self.label[which], self.cells[which], self.summary[which],
                       None if self.bands is None else self.bands[which])


def of_batch(batch: pa.RecordBatch) -> Vectors:
    ids = batch.column("vec_id")
    n = batch.num_rows
    table = lambda name: np.asarray(batch.column(name).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, -1)
    bands = None
    if "bands" in batch.schema.names and n and batch.column("bands").null_count == 0:
        bands = np.array(batch.column("bands").to_pylist(), np.int64)
    return Vectors(
        batch.column("number").to_numpy(), pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False),
        batch.column("label").to_numpy(), table("cells"), table("summary"), bands,
    )


def bounds(a: Vectors, b: Vectors, level: tuple[slice, slice]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores of `a` against `b`, widened by what rounding may cost."""
    means, deviations = level
    middle = a.summary[:, means] @ b.summary[:, means].T
    width = a.summary[:, deviations] @ b.summary[:, deviations].T
    width += 1e-9 * (np.abs(middle) + width) + 1e-6
    return middle - width, middle + width


def scores(a: Vectors, b: Vectors) -> np.ndarray:
    """Inner products as longs; what a double cannot hold is added up in whole numbers, and held
    at the ends of a long."""
    if a.cells.size and b.cells.size and a.most.max() * b.most.max() * a.cells.shape[1] > EXACT:
        whole = lambda v: np.array([[int(x) for x in row] for row in v.cells], object)
        products = whole(a) @ whole(b).T
        return np.array([[min(max(int(x), LONG[0]), LONG[1]) for x in row] for row in products], np.int64).reshape(len(a.cells), len(b.cells))
    return (a.cells @ b.cells.T).astype(np.int64)


class Best:
    """The best `k` rows of each key so far: score down, then id (null last), then number."""

    def __init__(self, keys: int, k: int):
        self.keys, self.k = keys, k
        self.kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        #: A row with a lower score than its key's limit cannot come in.
        self.limit = np.full(keys, LONG[0], np.int64)

    def add(self, key: np.ndarray, score: np.ndarray, rows: Vectors, which: np.ndarray) -> None:
        if not len(key):
            return
        new = [key, score, rows.no_id[which], rows.vec_id[which], rows.number[which]]
        key, score, no_id, vec_id, number = (np.concatenate(p) for p in zip(self.kept, new))
        order = np.lexsort((number, vec_id, no_id, ~score, key))  # ~score falls as score rises, without overflow
        sorted_key = key[order]
        begins = np.flatnonzero(np.r_[True, sorted_key[1:] != sorted_key[:-1]])
        rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.r_[begins, len(order)]))
        keep = order[rank < self.k]
        self.kept = [c[keep] for c in (key, score, no_id, vec_id, number)]
        last = order[rank == self.k - 1]
        self.limit[key[last]] = score[last]


class Positives:
    """What a cell looks for first: each anchor's best other rows of its label."""

    def __init__(self, anchors: Vectors, k: int):
        self.anchors, self.best = anchors, Best(len(anchors.number), k)

    def allowed(self, a: slice, rows: Vectors) -> np.ndarray:
        anchors = self.anchors
        return (anchors.label[a, None] == rows.label[None, :]) & (anchors.number[a, None] != rows.number[None, :])

    def possible(self, a: slice, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return high >= self.best.limit[a, None]

    def take(self, at: np.ndarray, rows: Vectors, score: np.ndarray, alive: np.ndarray) -> None:
        i, j = np.nonzero(alive & (score >= self.best.limit[at][:, None]))
        self.best.add(at[i], score[i, j], rows, j)


class Negatives:
    """What it looks for next: for each anchor and band of scores the best rows of other labels."""

    def __init__(self, anchors: Vectors, k: int):
        self.anchors = anchors
        self.low, self.high = anchors.bands[:, :, 0], anchors.bands[:, :, 1]
        self.best = Best(self.low.size, k)
        self.best.limit[:] = self.low.ravel()

    def allowed(self, a: slice, rows: Vectors) -> np.ndarray:
        return self.anchors.label[a, None] != rows.label[None, :]

    def need(self) -> np.ndarray:
        return np.maximum(self.low, self.best.limit.reshape(self.low.shape))

    def possible(self, a: slice, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = np.zeros(low.shape, bool)
        need, most = self.need()[a], self.high[a]
        for j in range(need.shape[1]):  # a band holds nothing if its ends are the wrong way round
            out |= (high >= need[:, j, None]) & (low <= most[:, j, None]) & (need[:, j] <= most[:, j])[:, None]
        return out

    def take(self, at: np.ndarray, rows: Vectors, score: np.ndarray, alive: np.ndarray) -> None:
        n = self.low.shape[1]
        need = self.need()
        for band in range(n):
            i, j = np.nonzero(alive & (score >= need[at, band][:, None]) & (score <= self.high[at, band][:, None]))
            self.best.add(at[i] * n + band, score[i, j], rows, j)


class Counts:
    """Pairs left after each level and pairs scored, for the figures."""

    def __init__(self):
        self.pairs: list[int] = []

    def add(self, level: int, n: int) -> None:
        self.pairs += [0] * (level + 1 - len(self.pairs))
        self.pairs[level] += n


def compare(looking: Positives | Negatives, rows: Vectors, counts: Counts | None = None) -> None:
    """Some rows against all anchors of a cell: bounds level by level, then exact scores. Between
    levels the anchors and rows without a possible pair are left behind."""
    size = rows.cells.shape[1]
    for first in range(0, len(looking.anchors.number), ANCHORS_AT_ONCE):
        a = slice(first, min(first + ANCHORS_AT_ONCE, len(looking.anchors.number)))
        at = np.arange(a.start, a.stop)
        left, alive = rows, looking.allowed(a, rows)
        if counts:
            counts.add(0, int(alive.sum()))
        for n, level in enumerate(spans(size), 1):
            up, across = alive.any(axis=1), alive.any(axis=0)
            at, left, alive = at[up], left.part(across), alive[np.ix_(up, across)]
            if not len(at):
                break
            low, high = bounds(looking.anchors.part(at), left, level)
            alive &= looking.possible(at, low, high)
            if counts:
                counts.add(n, int(alive.sum()))
        up, across = alive.any(axis=1), alive.any(axis=0)
        at, left, alive = at[up], left.part(across), alive[np.ix_(up, across)]
        if len(at):
            looking.take(at, left, scores(looking.anchors.part(at), left), alive)


# the tables --------------------------------------------------------------------


def segments(embeddings: DataFrame, scale: float = 256.0, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """The stored form: number (unique), vec_id, label, size, cells (components times `scale`,
    rounded down) and the summary of every level's segments. Rows with a null label or vector or
    with a null or non-finite component are left out."""
    finite = F.forall(F.col("cells"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = embeddings.select(
        F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{label}`").cast("bigint").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("cells")
    ).where(F.col("label").isNotNull() & F.col("cells").isNotNull()).where(finite)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        sizes = pc.list_value_length(batch.column("cells")).to_numpy()
        for size in np.unique(sizes):
            part = batch.filter(pa.array(sizes == size))
            cells = np.floor(np.asarray(part.column("cells").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(part.num_rows, -1) * scale)
            summary = summaries(cells)
            lists = lambda m: pa.ListArray.from_arrays(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1], pa.array(m.ravel()))
            yield {"vec_id": part.column("vec_id"), "label": part.column("label"), "size": pa.array(np.full(part.num_rows, size, np.int32)),
                   "cells": lists(cells), "summary": lists(summary)}

    made = map_batches(rows, run, "vec_id bigint, label bigint, size int, cells array<double>, summary array<double>")
    return written(made.withColumn("number", F.monotonically_increasing_id()), "segments")


def _search(rows: DataFrame, anchors: DataFrame, kind: type, k: int, blocks: int, slices: int) -> DataFrame:
    """(number of the anchor, band, score, vec_id and number found): the best `k` of each cell.

    Rows go to every block of anchors, anchors to every slice; a task streams its cells one by
    one, anchors first, and holds the anchors of one cell and a batch of rows."""
    columns = ["size", "number", "vec_id", "label", "cells", "summary"]
    bands = "bands" if "bands" in anchors.columns else F.lit(None).cast("array<array<bigint>>").alias("bands")
    block = lambda number: F.pmod(F.xxhash64(number), F.lit(blocks)).cast("int")
    part = F.pmod(F.xxhash64("number", F.lit(1)), F.lit(slices)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = anchors.select(*columns, bands, block("number").alias("block"), each(slices).alias("slice"), F.lit(0).alias("kind"))
    given = rows.select(*columns, F.lit(None).cast("array<array<bigint>>").alias("bands"), each(blocks).alias("block"), part.alias("slice"), F.lit(1).alias("kind"))
    cells = asked.unionByName(given).repartition(blocks * slices, "block", "slice").sortWithinPartitions("block", "slice", "size", "kind", "number")

    def found(looking, cell) -> pa.RecordBatch:
        key, score, no_id, vec_id, number = looking.best.kept
        bands = looking.low.shape[1] if isinstance(looking, Negatives) else 1
        return pa.RecordBatch.from_pydict({
            "anchor": pa.array(looking.anchors.number[key // bands]), "band": pa.array((key % bands).astype(np.int32)), "score": pa.array(score),
            "found_id": pa.array(vec_id, pa.int64(), mask=no_id), "found": pa.array(number),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, looking = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(n).to_numpy() for n in ("block", "slice", "size", "kind")])
            cuts = np.r_[0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                *here, is_row = keys[:, lo].tolist()
                if here != cell:
                    if looking:
                        yield found(looking, cell)
                    cell, waiting, looking = here, [], None
                own = batch.slice(lo, hi - lo)
                if not is_row:
                    waiting.append(own)
                elif waiting or looking:
                    if looking is None:
                        table = pa.Table.from_batches(waiting).combine_chunks().to_batches()
                        looking, waiting = kind(of_batch(table[0]), k), []
                    for i in range(0, own.num_rows, ROWS_AT_ONCE):
                        compare(looking, of_batch(own.slice(i, ROWS_AT_ONCE)))
        if looking:
            yield found(looking, cell)

    return cells.mapInArrow(run, "anchor bigint, band int, score bigint, found_id bigint, found bigint")


def mine(
    embeddings: DataFrame, anchors: str, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
    scale: float = 256.0, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """For every anchor and each of its positives the first hard negatives: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.

    `anchors` is a condition on vec_id. An anchor's positives are its first `positives` other rows of
    its label by score, ties by smaller id; the negatives of a positive are the first `negatives` rows of other
    labels with `least` to `most` hundredths of its score. Scores are inner products of the components
    times `scale`, rounded down; beyond a long they are held at its ends. Rows with a null label or
    vector or a null or infinite component take no part; vectors of different lengths are not
    compared; a null id is no anchor and comes last among equals; repeated rows are rows of their own,
    so an anchor given twice is an anchor twice. An empty table gives no rows; other columns are not
    looked at. Results are exact: bounds only leave out what cannot count."""
    rows = segments(embeddings, scale, vec_id, vector, label)
    asked = written(rows.where(anchors), "anchors")
    n, wanted = rows.count(), asked.agg(F.sum(F.size("cells").cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-wanted // BLOCK))
    cores = embeddings.sparkSession.sparkContext.defaultParallelism
    slices = max(-(-2 * cores // blocks), -(-n // SLICE))
    first = Window.orderBy(F.col("score").desc(), F.col("found_id").asc_nulls_last(), "found")
    near = _search(rows, asked, Positives, positives, blocks, slices)
    near = near.withColumn("place", F.row_number().over(first.partitionBy("anchor"))).where(F.col("place") <= positives)
    near = written(near.select("anchor", F.col("score").alias("positive_score"), F.col("found_id").alias("positive_id"), (F.col("place") - 1).alias("band")), "positives")

    # least * score <= 100 * negative <= most * score, in whole numbers; decimals cannot overflow
    wide = F.col("positive_score").cast("decimal(20,0)")
    low, high = F.ceil(wide * least / 100), F.floor(wide * most / 100)
    band = F.array(low.cast("bigint"), high.cast("bigint"))
    none = F.array(F.lit(1).cast("bigint"), F.lit(0).cast("bigint"))  # no score lies between
    lists = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("band", band.alias("ends")))).alias("b"))  # `positives` at most
    lists = lists.select(F.col("anchor").alias("number"), F.concat("b.ends", F.array_repeat(none, F.lit(positives) - F.size("b"))).alias("bands"))
    hard = _search(rows, asked.join(lists, "number"), Negatives, negatives, blocks, slices)
    hard = hard.withColumn("rank", F.row_number().over(first.partitionBy("anchor", "band"))).where(F.col("rank") <= negatives)
    named = asked.select(F.col("number").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return hard.join(near, ["anchor", "band"]).join(named, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
