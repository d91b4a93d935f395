"""Stored sketches: statistics of any range of commits without reading the facts again.

One row per tenant, predicate and span of commit timestamps holds counts and mergeable sketches: of
the nodes (HyperLogLog) and of numeric values (KLL). A question about a range merges the rows of its
spans; new commits add rows, nothing is rebuilt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quadloom.functions.values import is_float

#: Bits of a node sketch and size of a value sketch, and what they promise: relative error of a count
#: of nodes (three deviations of 1.04 over the root of 2 ** BITS), error of a rank in shares.
BITS, VALUES = 12, 400
NODE_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (BITS / 2), 0.02


def build(log: DataFrame, width: int) -> DataFrame:
    """(namespace, predicate, span, rows, bytes, nodes, values) of a change log, `width` commit
    timestamps a span. One aggregation with map-side combine; what is shuffled is a sketch per task,
    tenant, predicate and span. Changes that are not committed are left out; values that
    are no numbers count as rows only."""
    size = F.coalesce(F.octet_length("value"), F.lit(8)).cast("long")
    number = F.when(is_float(F.col("value")), F.col("value").try_cast("double"))
    span = F.call_function("div", F.col("commit_ts"), F.lit(width).cast("long"))
    return log.where("commit_ts is not null").groupBy("namespace", "predicate", span.alias("span")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(size).cast("long").alias("bytes"),
        F.hll_sketch_agg("subject", BITS).alias("nodes"), F.kll_sketch_agg_double(number, VALUES).alias("values"),
    )


def merged(stored: DataFrame, width: int, after: int | None = None, until: int | None = None) -> DataFrame:
    """The same columns per tenant and predicate, over the spans within after < commit <= until;
    both must be the end of a span (one less than a multiple of `width`), as sketches cannot be cut."""
    for end in (after, until):
        if end is not None and (end + 1) % width:
            raise ValueError(f"{end} is not the last commit of a span of {width}")
    rows = stored
    if after is not None:
        rows = rows.where(F.col("span") >= (after + 1) // width)
    if until is not None:
        rows = rows.where(F.col("span") < (until + 1) // width)
    return rows.groupBy("namespace", "predicate").agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.hll_union_agg("nodes").alias("nodes"), F.kll_merge_agg_double("values").alias("values"))


def node_count(nodes: str = "nodes") -> Column:
    """Distinct nodes, within NODE_ERROR."""
    return F.hll_sketch_estimate(nodes)


def quantile(share: float, values: str = "values") -> Column:
    """The value at a share of the numeric values, null without any; its rank is within RANK_ERROR."""
    return F.when(F.kll_sketch_get_n_double(values) > 0, F.kll_sketch_get_quantile_double(values, F.lit(share)))
