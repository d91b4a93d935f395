"""Set operations on uid variables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from quadloom.plans.semi import having, lacking


def union(*variables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [v.select("uid") for v in variables]).distinct()


def intersection(first: DataFrame, *others: DataFrame) -> DataFrame:
    kept = first.select("uid").distinct()
    return reduce(lambda a, b: having(a, b, "uid"), others, kept)


def difference(first: DataFrame, *others: DataFrame) -> DataFrame:
    kept = first.select("uid").distinct()
    return reduce(lambda a, b: lacking(a, b, "uid"), others, kept)


def distinct_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the smallest by `order`, so the choice is the same on every run."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return best.select(*keys, "r.*").select(*df.columns)


def blocks(named: dict[str, DataFrame]) -> DataFrame:
    """Several query blocks as one result: the rows of each under its name, in `block`. Columns
    a block does not have are null."""
    parts = [df.select(F.lit(name).alias("block"), "*") for name, df in named.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
