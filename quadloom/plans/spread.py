"""Spreading rows: join keys where most rows have nothing to look up, and scans with few splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SPREAD = 4096

#: Rows of a scan that one task makes facts of.
DEAL_ROWS = 1 << 17


def spread_key(key: Column, applies: Column, *by: Column) -> Column:
    """`key` where it applies; elsewhere one of many keys that match nothing. Null keys
    would all hash to one task, these spread over all of them."""
    other = F.concat(F.lit("#"), F.pmod(F.xxhash64(*by), F.lit(SPREAD)).cast("string"))
    return F.when(applies, key).otherwise(other)


def spread_out(scan: DataFrame, key: str) -> DataFrame:
    """Rows of a scan over all cores, ahead of costly work per row, where the files have
    fewer splits than there are cores (one large row group, one compressed file). An input
    with enough splits, as any large table has, is returned as it is: no shuffle. `key`
    should be unique. Only for scans and projections of them."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    splits = scan._jdf.queryExecution().toRdd().getNumPartitions()
    return scan if splits >= cores else scan.repartition(cores, key)


def dealt(scan: DataFrame, rows: int = DEAL_ROWS) -> DataFrame:
    """Rows of a scan in tasks of about `rows` each, ahead of work that makes several rows of each and
    sorts them. A split is bounded by its bytes as stored: a file that compresses well, or has one
    row group, puts any number of rows into one task. The count comes from the files' footers; rows
    are dealt by their place in the scan, so equal and null keys spread as well. Small scans are returned as they are. Only for scans."""
    tasks = -(-scan.count() // rows)
    if tasks < 2:
        return scan
    return scan.withColumn("_place", F.monotonically_increasing_id()).repartition(tasks, "_place").drop("_place")
