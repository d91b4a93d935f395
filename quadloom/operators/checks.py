"""Schema flags as data-quality jobs; each returns the rows that break the rule."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from quadloom.functions.values import conforms
from quadloom.model import namespace_of, tenant_key, with_tenant
from quadloom.plans.semi import lacking


def not_unique(facts: DataFrame, predicate: str) -> DataFrame:
    """Values of a unique predicate held by more than one node of a namespace."""
    rows = facts.where((F.col("predicate") == predicate) & F.col("value").isNotNull())
    return rows.groupBy("namespace", "value").agg(F.count_distinct("subject").alias("subjects")).where("subjects > 1")


def missing(members: DataFrame, facts: DataFrame, predicate: str, key: str = "uid") -> DataFrame:
    """Nodes of a type without the non-null predicate in their tenant."""
    have = facts.where((F.col("predicate") == predicate) & (F.col("value").isNotNull() | F.col("object_uid").isNotNull()))
    nodes = members.select(namespace_of(members).alias("namespace"), key)
    return lacking(nodes, have.select("namespace", F.col("subject").alias(key)), ["namespace", key]).select(
        "namespace", key, F.lit(predicate).alias("predicate")
    )


def null_elements(df: DataFrame, column: str, key: str = "uid") -> DataFrame:
    """Rows whose list holds a null element."""
    return df.where(F.exists(column, lambda x: x.isNull())).select(key)


def repeated_keys(batch: DataFrame, key: str, state: DataFrame | None = None) -> DataFrame:
    """Upsert keys occurring more than once in a batch (and tenant), and whether the state has
    them there."""
    tenant = tenant_key(*[batch] + [state] * (state is not None))
    keys = [*tenant, key]
    rows = with_tenant(batch, tenant).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if state is None:
        return rows
    known = with_tenant(state, tenant).select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [rows[k] == known[f"_{k}"] for k in keys])
    return rows.join(known, same, "left").select(*keys, "n", F.col(f"_{key}").isNotNull().alias("known"))


def several_values(facts: DataFrame, single: Sequence[str] | None = None) -> DataFrame:
    """Single-valued predicates with more than one value on a subject (and language)."""
    rows = facts if single is None else facts.where(F.col("predicate").isin(list(single)))
    held = F.coalesce(F.col("object_uid").cast("string"), F.col("value"))
    return rows.groupBy("namespace", "subject", "predicate", "lang").agg(F.count_distinct(held).alias("n")).where("n > 1")


def wrong_type(facts: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Values that do not parse as the type declared for their predicate. The declarations are
    metadata and become literals of the scan; no join on the predicate, a handful of hot keys."""
    types = F.create_map(*[F.lit(x) for pair in declared.items() for x in pair])
    rows = facts.where(F.col("predicate").isin(list(declared))).withColumn("declared", F.try_element_at(types, F.col("predicate")))
    return rows.where(F.col("value").isNotNull() & ~conforms(F.col("value"), F.col("declared"))).select(
        "namespace", "subject", "predicate", "value", "declared"
    )


def dangling(edges: DataFrame, nodes: DataFrame, key: str = "uid") -> DataFrame:
    """Edges whose target is missing in their tenant or not of the declared type: `nodes` are the
    nodes of that type."""
    tenant = tenant_key(edges, nodes)
    known = with_tenant(nodes, tenant).select(*tenant, F.col(key).alias("dst"))
    return lacking(with_tenant(edges, tenant), known, [*tenant, "dst"]).select(*tenant, "src", "dst")
