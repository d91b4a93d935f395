"""Positions in a sorted order without one task seeing a whole group.

Rows are range-partitioned by (group, order), so a hot group spreads over many
partitions. Each partition numbers its own sorted rows; the offsets come from one count
row per (partition, group). The ranged rows are written once, because sampled
range bounds may differ when a lost stage is computed again. Without groups that is the only
shuffle of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quadloom.plans.cut import written


def positions(
    df: DataFrame,
    order: list[Column],
    group: list[str] | None = None,
    out: str = "position",
    partitions: int | None = None,
) -> DataFrame:
    """Add a 1-based bigint position of every row in `order`, per `group` if given.
    `order` must be total within the group."""
    group = group or []
    keys = [F.col(g).asc() for g in group] + order
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    # Upper bits: the partition; lower 33 bits: the row's place in it.
    row = F.monotonically_increasing_id()
    ranged = written(ranged.sortWithinPartitions(*keys).withColumn("_row", row), "ranged")
    place = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    ranged = ranged.withColumn("_slice", F.shiftright("_row", 33).cast("int"))

    counts = ranged.groupBy("_slice", *group).agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"))
    # One row per slice (and group): the window is over slices, never over data rows.
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_slice").alias("_s"), *[F.col(g).alias(f"_g_{g}") for g in group],
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).cast("long").alias("_before"),
    )
    on = F.col("_slice") == F.col("_s")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    if not group:  # as many rows as there are partitions
        offsets = F.broadcast(offsets)
    return ranged.join(offsets, on).select(
        *df.columns, (F.col("_before") + place + 1).cast("long").alias(out)
    )
