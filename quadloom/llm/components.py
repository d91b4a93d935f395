"""Connected components by alternating large-star and small-star joins.

Per node only its smallest neighbour is aggregated (map-side combine), so a node with very many
neighbours costs no more than its links. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quadloom.plans.cut import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node is linked to the smallest of node and
    neighbours. Small star: the same for the neighbours that are smaller, and the node itself."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = near.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    pairs = near.join(smallest, "a")
    if large:
        out = pairs.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = pairs.select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(
            smallest.select("a", F.col("low").alias("b"))
        )
    return out.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node that has a link; the component is its smallest node.
    Self links are ignored, repeated links count once, no links give no rows."""
    now = written(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        now = written(_star(_star(now, True), False), "links")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:  # a star round that changes nothing: all links lead to the smallest node
            break
        before = state
    lows = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(lows)
