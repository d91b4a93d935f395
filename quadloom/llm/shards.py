"""Contiguous shards of near equal bytes from global prefix sums.

Rows are range-partitioned by (hash of the text, id), so equal texts lie side by side and a hot
text is spread over partitions by id. Each partition adds up its own sizes; one total per
partition gives the offsets of all prefix sums; the cuts stand at equal byte targets. A cut that
falls into a group of equal texts moves to the nearer end of the group if that shifts it by at
most `tolerance` of a shard; larger groups are cut where the target is, as balance comes first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quadloom.llm.tables import text_of
from quadloom.plans.cut import written


def prefix_sums(rows: DataFrame, keys: list[str], size: str) -> DataFrame:
    """`rows` in the global order of `keys` with `start` (sum of the sizes before) and `index`
    (rows before). One shuffle; the driver sees one line per partition. Ties of all keys may
    fall either way. The ranged rows are written once, as sampled bounds can differ when a lost
    stage is computed again."""
    names = rows.columns

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0, 0
        for batch in batches:
            sizes = np.asarray(batch.column(names.index(size)).to_numpy(zero_copy_only=False), np.int64)
            before = total + np.cumsum(sizes) - sizes
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(before), pa.array(np.arange(seen, seen + len(sizes)))],
                names=[*names, "start_in_slice", "index_in_slice"],
            )
            total, seen = total + int(sizes.sum()), seen + len(sizes)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    summed = ranged.mapInArrow(add_up, f"{fields}, start_in_slice bigint, index_in_slice bigint")
    summed = written(summed.withColumn("slice", F.spark_partition_id()), "prefix-sums")
    totals = summed.groupBy("slice").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    lines = sorted(totals.collect())  # one line per partition
    offsets, byte_sum, row_sum = [], 0, 0
    for line in lines:
        offsets.append((line["slice"], byte_sum, row_sum))
        byte_sum, row_sum = byte_sum + line["bytes"], row_sum + line["rows"]
    places = F.broadcast(rows.sparkSession.createDataFrame(offsets, "slice int, byte_offset bigint, row_offset bigint"))
    return summed.join(places, "slice").select(
        *names,
        (F.col("byte_offset") + F.col("start_in_slice")).alias("start"),
        (F.col("row_offset") + F.col("index_in_slice")).alias("index"),
    )


def cuts(placed: DataFrame, shards: int, tolerance: float) -> list[int]:
    """Byte positions at which shards 1, 2, ... begin. The driver sees a row or two per cut."""
    total = placed.agg(F.sum("size")).first()[0] or 0
    targets = [total * k // shards for k in range(1, shards)]
    if not total:
        return targets
    hit = F.lit(False)
    for t in set(targets):
        hit = hit | ((F.col("start") <= t) & (F.col("start") + F.col("size") > t))
    at = placed.where(hit).select("group").distinct().collect()
    groups = (
        placed.where(F.col("group").isin([r["group"] for r in at]))
        .groupBy("group").agg(F.min("start").alias("lo"), F.max(F.col("start") + F.col("size")).alias("hi"))
        .collect()
    )
    out = []
    for t in targets:
        lo, hi = next(((g["lo"], g["hi"]) for g in groups if g["lo"] <= t < g["hi"]), (t, t))
        near = lo if t - lo <= hi - t else hi
        out.append(near if abs(near - t) <= tolerance * total / shards else t)
    return out


def shard(docs: DataFrame, shards: int = 8, tolerance: float = 0.001, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of `docs` with its shard of near equal bytes and its slot in it.

    Size is the UTF-8 bytes of the text (null: none) plus 1, so empty texts count too. A row
    belongs to the shard in which its middle lies, so a shard misses its target by at most the
    longest document plus twice `tolerance` of a shard. Null ids sort first, repeated rows are all kept,
    an empty table gives no rows, other columns are not looked at."""
    body = F.coalesce(text_of(docs, text), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        (F.octet_length(body) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("group"),
    )
    placed = prefix_sums(rows, ["group", "doc_id"], "size")
    number = F.lit(0)
    for cut in cuts(placed, shards, tolerance):
        number = number + F.when(2 * F.col("start") + F.col("size") >= 2 * cut, 1).otherwise(0)
    numbered = placed.withColumn("shard", number.cast("int"))
    begins = numbered.groupBy("shard").agg(F.min("index").alias("begin"))
    return numbered.join(F.broadcast(begins), "shard").select(  # at most `shards` lines
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("index") - F.col("begin")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
