"""Semi, anti and outer joins.

Spark can split a skewed left side of such a join at run time but never the right side,
which has to be seen whole for a key. So the right side of a semi or anti join is reduced to
its distinct keys (folded before the shuffle)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def having(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Left rows with a partner."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return left.join(_keys(right, keys), keys, "left_semi")


def lacking(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Left rows without a partner."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return left.join(_keys(right, keys), keys, "left_anti")


def with_partners(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left outer join: all left columns, then the right ones without their key, null for left
    rows without a partner. Each input is planned once. Spark splits a hot left key at run
    time; where the right side may repeat one key very often, keep it as rows of its own
    (`traverse.expand_all`) instead of joining it to the parent."""
    renamed = right.withColumnRenamed(right_key, "_key")
    return left.join(renamed, F.col(f"`{left_key}`") == F.col("_key"), "left").drop("_key")
