"""Removal of long passages that occur more than once, by a compacted de Bruijn graph.

1. Edges. Token k-mers (k about half a window) at places that depend on their own words only
   (closed syncmers: the least of a k-mer's s-mers is its first or last) are the edges kept of
   the graph. Each window holds at least one, two neighbours in a text lie at most k apart, so a
   pair of neighbours and their distance fix all words between them.
2. Repeated edges. Edges are counted (map-side) and joined back to their coordinates; only
   those with two or more occurrences go on.
3. Compaction. An edge whose occurrences all have the same right (left) neighbour does not
   branch there. Chains of such edges, read off the coordinates in each text, are paths that all
   occurrences of an edge share, so a window that such a path around one of its own edges covers
   is repeated.
4. Verification. The other windows that consist of repeated edges, at branches and at the ends
   of paths, are compared by 128-bit hashes of all their words. Whether a window is proved by
   step 3 or goes to step 4 depends on its words alone, so equal windows always take one way.

Nothing is compared pairwise, hot edges are folded before the shuffle, and coordinates of one
text are the largest group that is gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quadloom.llm.tables import map_batches, text_of
from quadloom.llm.words import Words, byte_texts, chunks, window_hashes, window_owner
from quadloom.plans.cut import written

_SECOND_BASE = 0xA0761D6478BD642D


def sizes(window: int) -> tuple[int, int]:
    """k and s: any `window` words hold k - s k-mers or more, so at least one kept edge."""
    k = (window + 1) // 2
    return k, min(2, k)


def sliding_least(a: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        a = np.minimum(a[: len(a) - span], a[span:])
        span *= 2
    rest = width - span
    return np.minimum(a[: len(a) - rest], a[rest:]) if rest else a


def kept_edges(words: np.ndarray, first: np.ndarray, k: int, s: int) -> np.ndarray:
    """Word positions at which a kept k-mer begins, none across texts."""
    n = len(words)
    if n < k:
        return np.empty(0, np.int64)
    parts = window_hashes(words, s)
    least = sliding_least(parts, k - s + 1)
    keep = (parts[: n - k + 1] == least) | (parts[k - s :] == least)
    return np.flatnonzero(keep & window_owner(first, k))


def row_key(doc_id: str, text: Column) -> Column:
    return F.xxhash64(F.col(f"`{doc_id}`"), text)


def edges(rows: DataFrame, window: int) -> DataFrame:
    """(edge, key, pos) for every kept edge of texts that have a window."""
    k, s = sizes(window)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        keys = batch.column(0).to_numpy()
        texts = byte_texts(batch.column(1))
        for a, b in chunks(texts):
            w = Words(texts[a:b])
            h = w.hashes()
            at = kept_edges(h, w.first, k, s)
            text = np.searchsorted(w.first, at, "right") - 1
            long = w.count[text] >= window
            at, text = at[long], text[long]
            yield {
                "edge": pa.array(window_hashes(h, k)[at].view(np.int64)), "key": pa.array(keys[a:b][text]),
                "pos": pa.array((at - w.first[text]).astype(np.int32)),
            }

    return map_batches(rows.select("key", "text"), run, "edge bigint, key bigint, pos int")


def repeated_edges(all_edges: DataFrame, k: int) -> DataFrame:
    """(key, hits): coordinates of the repeated edges of every text, with whether all
    occurrences share the right and the left neighbour."""
    often = all_edges.groupBy("edge").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("edge")
    often = written(often, "often")  # so that the join reads two shuffles, and Spark can split a hot edge
    found = written(all_edges.join(often, "edge"), "repeated-edges")
    # A repeated row has one key: its coordinates count once as neighbours. Not before, as a
    # distinct right behind the join would keep Spark from splitting it.
    once = found.repartition("key").dropDuplicates(["key", "pos", "edge"])
    in_text = Window.partitionBy("key").orderBy("pos")  # one text at most

    def neighbour(step) -> Column:
        far = F.abs(step("pos").over(in_text) - F.col("pos"))
        return F.when(far <= k, F.xxhash64(step("edge").over(in_text), far))

    linked = once.select("edge", "key", "pos", neighbour(F.lead).alias("right"), neighbour(F.lag).alias("left"))

    def same(side: str) -> Column:
        return (F.count(side) == F.count(F.lit(1))) & (F.min(side) == F.max(side))

    nodes = linked.groupBy("edge").agg(F.coalesce(same("right"), F.lit(False)).alias("right_same"), F.coalesce(same("left"), F.lit(False)).alias("left_same"))
    # A set: copies of a row have one key, and their equal coordinates meet ahead of the shuffle.
    return found.join(written(nodes, "edge-nodes"), "edge").groupBy("key").agg(F.collect_set(F.struct("pos", "edge", "right_same", "left_same")).alias("hits"))


def proved_and_open(n: int, kept: np.ndarray, is_repeated: np.ndarray, right_same: np.ndarray, left_same: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For one text of n words: window starts proved repeated by paths, and those to compare.
    `kept` are the kept edges' positions; the flags run along with them."""
    starts = n - window + 1
    m = len(kept)
    chain = np.concatenate([is_repeated[1:], [False]]) & is_repeated
    right_on = right_same & chain  # the path goes on from edge i to i + 1
    left_on = left_same & np.concatenate([[False], chain[:-1]])
    index = np.arange(m)
    right_end = np.minimum.accumulate(np.where(right_on, m, index)[::-1])[::-1]
    left_end = np.maximum.accumulate(np.where(left_on, -1, index))
    lo = np.maximum(np.maximum(kept - (window - k), kept[left_end]), 0)
    hi = np.minimum(np.minimum(kept, kept[right_end] + k - window), starts - 1)
    ok = is_repeated & (lo <= hi)
    step = np.zeros(starts + 1, np.int32)
    np.add.at(step, lo[ok], 1)
    np.add.at(step, hi[ok] + 1, -1)
    proved = np.cumsum(step[:-1]) > 0
    inside = np.zeros(n + 2, np.int32)
    inside[kept + 1] = 1
    alone = np.zeros(n + 2, np.int32)
    alone[kept[~is_repeated] + 1] = 1
    total, other = np.cumsum(inside), np.cumsum(alone)
    x = np.arange(starts)
    end = x + window - k + 1
    candidate = (total[end] > total[x]) & (other[end] == other[x])
    return np.flatnonzero(proved), np.flatnonzero(candidate & ~proved)


def cover(starts: np.ndarray, window: int, n: int) -> np.ndarray:
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + window, -1)
    return np.cumsum(step[:-1]) > 0


def result(text: bytes, gone: np.ndarray | None, n: int) -> tuple[int, list[int], str]:
    """Words removed, their spans (flat) and the kept words joined by a blank."""
    words = text.split()
    if gone is None or not gone.any():
        return 0, [], b" ".join(words).decode()
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    kept = b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])
    return int(gone.sum()), edge.tolist(), kept.decode()


FINAL = "doc_id bigint, n_words bigint, n_removed bigint, spans array<int>, kept_sha256 string, kept string"


def final_columns(doc_ids: pa.Array, counts: list[int], found: list[tuple[int, list[int], str]], with_text: bool) -> dict:
    return {
        "doc_id": doc_ids, "n_words": pa.array(counts, pa.int64()), "n_removed": pa.array([f[0] for f in found], pa.int64()),
        "spans": pa.array([f[1] for f in found], pa.list_(pa.int32())),
        "kept_sha256": pa.array([hashlib.sha256(f[2].encode()).hexdigest() for f in found], pa.string()),
        "kept": pa.array([f[2] if with_text else None for f in found], pa.string()),
    }


def first_reading(joined: DataFrame, window: int, with_text: bool) -> DataFrame:
    """Rows (doc_id, key, text, hits): the result of texts that need no comparison; of the others
    the text, the proved starts and the windows to compare (x, one, two)."""
    k, s = sizes(window)

    def read(text: bytes, hits: list | None):
        w = Words([text])
        n = len(w.start)
        if not hits or n < window:
            return n, None, None, None
        h = w.hashes()
        kept = kept_edges(h, w.first, k, s)
        own = window_hashes(h, k)[kept].view(np.int64)
        pos = np.array([x["pos"] for x in hits], np.int64)
        at = np.minimum(np.searchsorted(kept, pos), len(kept) - 1)
        true = (kept[at] == pos) & (own[at] == np.array([x["edge"] for x in hits], np.int64))  # not another text's
        flags = np.zeros((3, len(kept)), bool)
        flags[0, at[true]] = True
        flags[1, at[true]] = np.array([x["right_same"] for x in hits], bool)[true]
        flags[2, at[true]] = np.array([x["left_same"] for x in hits], bool)[true]
        proved, open_ = proved_and_open(n, kept, *flags, window, k)
        return n, proved, open_, h

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = byte_texts(batch.column(2))
        hits = batch.column(3)
        for a, b in chunks(texts):
            part = batch.slice(a, b - a)
            counts, found, held, starts, x, one, two = [], [], [], [], [], [], []
            for text, hit in zip(texts[a:b], hits.slice(a, b - a)):
                n, proved, open_, h = read(text, hit.as_py())
                counts.append(n)
                wait = open_ is not None and len(open_) > 0
                gone = cover(proved, window, n) if proved is not None and len(proved) else None
                found.append((0, [], "") if wait else result(text, gone, n))
                held.append(text.decode() if wait else None)
                starts.append(proved.tolist() if wait else [])
                x.append(open_.tolist() if wait else [])
                one.append(window_hashes(h, window)[open_].view(np.int64).tolist() if wait else [])
                two.append(window_hashes(h, window, _SECOND_BASE)[open_].view(np.int64).tolist() if wait else [])
            yield final_columns(part.column(0), counts, found, with_text) | {
                "key": part.column(1), "text": pa.array(held, pa.string()), "proved": pa.array(starts, pa.list_(pa.int32())),
                "x": pa.array(x, pa.list_(pa.int32())), "one": pa.array(one, pa.list_(pa.int64())), "two": pa.array(two, pa.list_(pa.int64())),
            }

    more = ", key bigint, text string, proved array<int>, x array<int>, one array<bigint>, two array<bigint>"
    return map_batches(joined.select("doc_id", "key", "text", "hits"), run, FINAL + more)


def compared(read: DataFrame) -> DataFrame:
    """(key, starts): windows among those to compare that occur twice or more, each start once
    however many rows have the key."""
    waiting = read.where("text is not null").select("key", F.explode(F.arrays_zip("x", "one", "two")).alias("w"))
    rows = waiting.select("key", F.col("w.x").alias("x"), F.col("w.one").alias("one"), F.col("w.two").alias("two"))
    often = written(rows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("one", "two"), "often")
    return rows.join(often, ["one", "two"]).groupBy("key").agg(F.collect_set("x").alias("starts"))


def second_reading(waiting: DataFrame, window: int, with_text: bool) -> DataFrame:
    def run(batch: pa.RecordBatch) -> dict:
        counts, found = batch.column(1).to_pylist(), []
        for text, n, proved, starts in zip(byte_texts(batch.column(2)), counts, batch.column(3), batch.column(4)):
            at = np.concatenate([np.array(x.as_py() or [], np.int64) for x in (proved, starts)])
            found.append(result(text, cover(np.unique(at), window, n) if len(at) else None, n))
        return final_columns(batch.column(0), counts, found, with_text)

    return map_batches(waiting.select("doc_id", "n_words", "text", "proved", "starts"), run, FINAL)


def remove_repeats(docs: DataFrame, window: int = 35, with_text: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, `spans` (flat positions of removed
    words), kept_sha256 (of the kept words joined by a blank) and, `with_text`, `kept`.

    A word goes if a window of `window` words that covers it occurs anywhere else, in the same
    text or another; the first occurrence goes like the others. Null texts have no words, texts
    shorter than a window lose none; repeated rows are each other's copies; null ids are rows
    like others; an empty table gives no rows; other columns are not looked at."""
    k, _ = sizes(window)
    body = F.coalesce(text_of(docs, text), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), body.alias("text")).select("doc_id", row_key("doc_id", F.col("text")).alias("key"), "text")
    hits = repeated_edges(edges(rows, window), k)
    read = written(first_reading(rows.join(hits, "key", "left"), window, with_text), "first-reading")
    names = [x.split()[0] for x in FINAL.split(", ")]
    done = read.where("text is null").select(names)
    waiting = read.where("text is not null").select("doc_id", "n_words", "key", "text", "proved").join(compared(read), "key", "left")
    out = done.unionAll(second_reading(waiting, window, with_text))
    return out if with_text else out.drop("kept")
