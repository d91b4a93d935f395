"""Counts over variables, edges and predicates. All are hash aggregations with
map-side combine; distinct counts go through Spark's two-step distinct plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quadloom.functions.values import is_bool, is_float, is_int, is_time
from quadloom.model import tenant_key, with_tenant
from quadloom.operators.roots import compare
from quadloom.plans.pages import PAGE_SIZE, nest


def size_of(variable: DataFrame, key: str = "uid") -> DataFrame:
    """len(v): the number of distinct uids of a variable, as a one-row frame."""
    return variable.agg(F.count_distinct(key).alias("len"))


def out_counts(nodes: DataFrame, edges: DataFrame, key: str = "uid") -> DataFrame:
    """Edges leaving each node in its tenant, zero included."""
    return _counted(nodes, edges, key, "src", "dst")


def in_counts(nodes: DataFrame, edges: DataFrame, key: str = "uid") -> DataFrame:
    """Edges arriving at each node in its tenant, zero included."""
    return _counted(nodes, edges, key, "dst", "src")


def _counted(nodes: DataFrame, edges: DataFrame, key: str, end: str, other: str) -> DataFrame:
    tenant = tenant_key(nodes, edges)
    counts = with_tenant(edges, tenant).groupBy(*tenant, F.col(end).alias(key)).agg(F.count_distinct(other).alias("n"))
    return with_tenant(nodes, tenant).join(counts, [*tenant, key], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def count_index(edges: DataFrame) -> DataFrame:
    """(cnt, uid) rows, per tenant where edges have one: the nodes behind each edge count, as rows
    so no list grows."""
    return edges.groupBy(*tenant_key(edges), F.col("src").alias("uid")).agg(F.count_distinct("dst").alias("cnt"))


def with_count(edges: DataFrame, how: str, n: int) -> DataFrame:
    return count_index(edges).where(compare("cnt", how, n))


def uids_per_predicate(facts: DataFrame, approximate: bool = False) -> DataFrame:
    """Nodes per tenant and predicate."""
    n = F.approx_count_distinct("subject") if approximate else F.count_distinct("subject")
    return facts.groupBy("namespace", "predicate").agg(n.alias("num_uids"))


def predicate_sizes(facts: DataFrame, per_tenant: bool = True) -> DataFrame:
    """Rows and uncompressed bytes per tenant and predicate, or per predicate of the whole
    store: value bytes, or 8 per uid."""
    size = F.coalesce(F.octet_length("value"), F.lit(8)).cast("long")
    return facts.groupBy(*["namespace"] * per_tenant, "predicate").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(size).cast("long").alias("bytes")
    )


def posting_lists(facts: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """(namespace, predicate, subject, page) -> sorted postings; a posting is a uid or a value."""
    rows = facts.select("namespace", "predicate", "subject", "object_uid", "value")
    return nest(
        rows,
        ["namespace", "predicate", "subject"],
        ["object_uid", "value"],
        F.coalesce(F.col("object_uid").cast("string"), F.col("value")),
        "postings",
        page_size,
        unique=True,
    )


# One bit per type a text can be read as.
_INT, _FLOAT, _BOOL, _TIME = 1, 2, 4, 8


def observed_types(facts: DataFrame) -> DataFrame:
    """Narrowest type every value of a tenant's predicate parses as, and whether any subject
    holds more than one value in one language. The types fold to one row per predicate before
    any shuffle; only (predicate, subject) counts are shuffled for the hint."""
    v = F.col("value")
    readings = (
        F.when(v.isNull(), _INT | _FLOAT | _BOOL | _TIME)
        .when(is_int(v), _INT | _FLOAT)
        .when(is_float(v), _FLOAT)
        .when(is_bool(v), _BOOL)
        .when(is_time(v), _TIME)
        .otherwise(0)
    )
    key = ["namespace", "predicate"]
    kinds = facts.groupBy(*key).agg(
        F.count(F.lit(1)).alias("rows"), F.count("object_uid").alias("edges"), F.bit_and(readings).alias("r")
    )
    most = facts.groupBy(*key, "subject", "lang").agg(F.count(F.lit(1)).alias("n")).groupBy(*key).agg(F.max("n").alias("most"))

    def reads(bit: int):
        return F.col("r").bitwiseAND(F.lit(bit)) != 0

    return kinds.join(most, key).select(
        "namespace",
        "predicate",
        "rows",
        "edges",
        F.when(F.col("edges") == F.col("rows"), "uid")
        .when(reads(_INT), "int")
        .when(reads(_FLOAT), "float")
        .when(reads(_BOOL), "bool")
        .when(reads(_TIME), "dateTime")
        .otherwise("string")
        .alias("observed"),
        F.when(F.col("most") > 1, "LIST").otherwise("SINGLE").alias("hint"),
    )
