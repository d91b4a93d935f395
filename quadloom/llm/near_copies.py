"""Near-duplicate groups by SimHash, candidates by the pigeonring principle.

A link needs at most 3 differing bits of 64. Cut the bits into a ring of 4 segments: some
segment must start a chain in which the first l segments differ in at most 3 * l / 4 bits, for
every l. So one segment (16 bits) is equal, and among the 48 bits behind it, cut into 4 parts,
again one part (12 bits) is equal: 28 equal bits are the join key, 16 keys per fingerprint. A
key that many fingerprints share is made longer the same way (one of 4 parts of the bits left
is equal) until its bucket is small, so no bucket is compared as a whole and no pair is lost.
In a bucket the chain condition is tested first, then all bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh64_digest

from quadloom.llm.components import components
from quadloom.llm.tables import map_batches, text_of
from quadloom.llm.words import byte_texts
from quadloom.plans.cut import written

BITS, SEGMENTS, LIMIT, SEED = 64, 4, 3, 42
#: A bucket with more fingerprints gets longer keys; the last level is bounded by its free bits.
BUCKET, FREE_BITS = 1024, 12


def fingerprint(text: bytes, shingle: int = 3) -> bytes:
    """8 bytes, highest bit first: a bit is 1 if set in over half of the shingles' hashes."""
    words = text.lower().split()  # both are ASCII only for bytes
    if not words:
        return bytes(8)
    norm = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: max(1, len(words) - shingle + 1)].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    ones, n = np.zeros(BITS, np.int64), len(starts)
    for i in range(0, n, 1 << 14):
        hashes = b"".join([xxh64_digest(norm[a:b], SEED) for a, b in zip(starts[i : i + (1 << 14)], ends[i : i + (1 << 14)])])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash and `print`, the 64 bits as a signed bigint, for every row."""

    def run(batch: pa.RecordBatch) -> dict:
        raw = b"".join(map(fingerprint, byte_texts(batch.column(2))))
        return {"doc_id": batch.column(0), "text_hash": batch.column(1), "print": pa.array(np.frombuffer(raw, ">i8").astype(np.int64))}

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), _text_hash(docs, text).alias("text_hash"), text_of(docs, text).alias("text"))
    return map_batches(rows, run, "doc_id bigint, text_hash bigint, print bigint")


def _text_hash(docs: DataFrame, text: str) -> Column:
    return F.xxhash64(F.coalesce(text_of(docs, text), F.lit("")))


def parts(bits: list[int], n: int) -> list[list[int]]:
    at = [len(bits) * k // n for k in range(n + 1)]
    return [bits[at[k] : at[k + 1]] for k in range(n)]


def first_paths() -> list[frozenset[int]]:
    """The key bits of the first level: a segment, and a part of the rest in ring order."""
    ring = parts(list(range(BITS)), SEGMENTS)
    out = []
    for i in range(SEGMENTS):
        rest = [b for k in range(1, SEGMENTS) for b in ring[(i + k) % SEGMENTS]]
        out += [frozenset(ring[i] + p) for p in parts(rest, LIMIT + 1)]
    return out


def longer_paths(paths: list[frozenset[int]]) -> list[frozenset[int]]:
    """Each path's key and one of four parts of its free bits; path p goes to 4 p .. 4 p + 3."""
    return [path | frozenset(p) for path in paths for p in parts(sorted(set(range(BITS)) - path), LIMIT + 1)]


def masks(paths: list[frozenset[int]]) -> Column:
    values = [sum(1 << b for b in p) for p in paths]
    return F.array(*[F.lit(v - (1 << 64) if v >> 63 else v) for v in values])


def keyed(rows: DataFrame, paths: list[frozenset[int]]) -> DataFrame:
    """Rows (path, print) with the key of their bucket; equal keys of different buckets by
    chance only add tests."""
    mask = F.element_at(masks(paths), F.col("path") + 1)
    return rows.select("path", "print", F.xxhash64("path", F.col("print").bitwiseAND(mask)).alias("key"))


CHAIN = [np.uint64(((1 << 16) - 1) << (16 * k)) for k in range(SEGMENTS)]


def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs that pass a chain from some segment (prefix sums within l * 3 / 4 for all l; for
    l = 4 this is the full Hamming test)."""
    differ = a ^ b
    count = [np.bitwise_count(differ & m).astype(np.int16) for m in CHAIN]
    ok = np.zeros(differ.shape, bool)
    for i in range(SEGMENTS):
        total, viable = 0, True
        for size in range(1, SEGMENTS + 1):
            total = total + count[(i + size - 1) % SEGMENTS]
            viable = viable & (SEGMENTS * total <= LIMIT * size)
        ok |= viable
    return ok


def bucket_links(prints: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the links of a bucket connect: each print with the first print
    of its group (prints of a group need not be within the limit of its first one)."""
    near = np.stack([linked(prints, p) for p in prints])
    label = np.arange(len(prints))
    while True:
        low = np.where(near, label[None, :], len(prints)).min(axis=1)
        low = np.minimum(low, label)[np.minimum(low, label)]
        if (low == label).all():
            break
        label = low
    return [(i, int(g)) for i, g in enumerate(label) if g != i]


def links_in_buckets(rows: DataFrame) -> DataFrame:
    """Links (a, b) from rows (key, print); a partition is read in key order, one bucket held."""

    def emit(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        size = np.diff(edge)
        left, right = [], []
        small = np.repeat(size <= 16, size)
        for d in range(1, min(16, int(size.max()))):
            i = np.flatnonzero((keys[d:] == keys[:-d]) & small[d:])
            i = i[linked(prints[i], prints[i + d])]
            left.append(prints[i])
            right.append(prints[i + d])
        for at, n in zip(edge[:-1][size > 16].tolist(), size[size > 16].tolist()):
            own = prints[at : at + n]
            found = np.array(bucket_links(own), np.int64).reshape(-1, 2)
            left.append(own[found[:, 0]])
            right.append(own[found[:, 1]])
        if left:
            yield pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate(left).view(np.int64)), "b": pa.array(np.concatenate(right).view(np.int64))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            prints = np.concatenate([prints, batch.column(1).to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on
            if whole:
                yield from emit(keys[:whole], prints[:whole])
                keys, prints = keys[whole:], prints[whole:]
        if len(keys):
            yield from emit(keys, prints)

    return rows.select("key", "print").sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint")


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between different fingerprints that connect all within the limit. `prints`
    has one row per fingerprint."""
    paths = first_paths()
    rows = prints.select("print", F.explode(F.sequence(F.lit(0), F.lit(len(paths) - 1))).alias("path"))
    found = None
    while True:
        here = keyed(rows, paths)
        size = written(here.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "key-sizes")
        sized = written(here.join(size, "key"), "shared-keys")
        last = BITS - min(map(len, paths)) <= FREE_BITS
        light = sized if last else sized.where(F.col("n") <= BUCKET)
        level = links_in_buckets(light.repartition("key"))
        found = level if found is None else found.unionAll(level)
        if last:
            return found
        heavy = sized.where(F.col("n") > BUCKET)
        if heavy.isEmpty():
            return found
        paths = longer_paths(paths)
        part = F.explode(F.sequence(F.lit(0), F.lit(LIMIT))).alias("part")
        rows = heavy.select("print", "path", part).select("print", (F.col("path") * (LIMIT + 1) + F.col("part")).alias("path"))


def _named(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """All rows (doc_id, text_hash, print), and per print its component and the first of the
    component: (null id last, id, text_hash)."""
    prints = written(fingerprints(docs, doc_id, text), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    distinct = prints.groupBy("print").agg(first.alias("first"))
    member = components(links(distinct.select("print")))  # (node, component), linked prints only
    of = distinct.join(member.withColumnRenamed("node", "print"), "print", "left").withColumn("component", F.coalesce("component", "print"))
    return prints, of.join(of.groupBy("component").agg(F.min("first").alias("chosen")), "component").select("print", "chosen")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, `fingerprint` (16 hex digits) and component_id, the
    smallest doc_id reachable over links of at most 3 differing bits, its own included.

    Null and empty texts have the fingerprint zero and are linked like any other. Null ids have
    a row but never name a group (component_id is null where a group has no id). Repeated rows
    all stay. An empty table gives no rows; other columns are not looked at."""
    prints, named = _named(docs, doc_id, text)
    return prints.join(named, "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), F.col("chosen.doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` without near copies: of each group of `groups` the row with the
    smallest doc_id stays (ids before null; of rows with one id the smallest text hash, of
    repeated rows one), with all its columns."""
    _, named = _named(docs, doc_id, text)
    id_text = lambda c: F.coalesce(c.cast("bigint").cast("string"), F.lit("none"))  # noqa: E731  never null: one shuffle serves the join and what follows
    keep = named.select(F.col("chosen.text_hash").alias("own_hash"), id_text(F.col("chosen.doc_id")).alias("own_id")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, _text_hash(docs, text).alias("own_hash"), id_text(F.col(f"`{doc_id}`")).alias("own_id"))
    return rows.join(keep, ["own_hash", "own_id"]).dropDuplicates(["own_hash", "own_id"]).select("row.*")
