"""Root functions and filters: which nodes a query block starts from or keeps."""

from __future__ import annotations

import datetime as dt
import operator as op
import re
from collections.abc import Iterable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quadloom.model import tenant_key, with_tenant
from quadloom.plans.semi import having, lacking

_COMPARE = {"eq": op.eq, "lt": op.lt, "le": op.le, "gt": op.gt, "ge": op.ge}

# Fixed value: the letters accepted as trailing flags of a pattern.
REGEX_FLAGS = "imsU"


def compare(column: Column | str, how: str, value) -> Column:
    """eq / lt / le / gt / ge against a literal; a plain comparison, so it reaches the scan."""
    column = F.col(column) if isinstance(column, str) else column
    return _COMPARE[how](column, value if isinstance(value, Column) else F.lit(value))


def by_uid(nodes: DataFrame, uids: Iterable[int] | DataFrame, key: str = "uid") -> DataFrame:
    """Nodes with one of the given uids: literals become an IN filter, a variable a semi join."""
    if isinstance(uids, DataFrame):
        return having(nodes, uids.select(F.col("uid").alias(key)), key)
    return nodes.where(F.col(key).isin(list(uids)))


def of_type(nodes: DataFrame, type_name: str, labels: str = "labels") -> DataFrame:
    return nodes.where(F.array_contains(labels, type_name))


def has_value(nodes: DataFrame, predicate: str) -> DataFrame:
    return nodes.where(F.col(predicate).isNotNull())


def has_edge(nodes: DataFrame, edges: DataFrame, key: str = "uid", reverse: bool = False) -> DataFrame:
    """Nodes with an edge, of their own tenant where nodes or edges have one."""
    tenant, end = tenant_key(nodes, edges), "dst" if reverse else "src"
    ends = with_tenant(edges, tenant).select(*tenant, F.col(end).alias(key))
    return having(with_tenant(nodes, tenant), ends, [*tenant, key]).select(*nodes.columns)


def lacks_edge(nodes: DataFrame, edges: DataFrame, key: str = "uid", reverse: bool = False) -> DataFrame:
    """Nodes without an edge in their own tenant."""
    tenant, end = tenant_key(nodes, edges), "dst" if reverse else "src"
    ends = with_tenant(edges, tenant).select(*tenant, F.col(end).alias(key))
    return lacking(with_tenant(nodes, tenant), ends, [*tenant, key]).select(*nodes.columns)


def subjects_with(facts: DataFrame, predicate: str) -> DataFrame:
    """has(p) over the long form: distinct (namespace, uid) of one predicate partition."""
    return facts.where(F.col("predicate") == predicate).select("namespace", F.col("subject").alias("uid")).distinct()


def filter_tree(tree) -> Column:
    """Fold ("and"|"or", [..]) / ("not", x) / Column into one Column."""
    if isinstance(tree, Column):
        return tree
    kind, body = tree
    if kind == "not":
        return ~filter_tree(body)
    parts = [filter_tree(t) for t in body]
    return reduce(op.and_ if kind == "and" else op.or_, parts)


# parameters ------------------------------------------------------------------
def parameter_type(value) -> str:
    """Only integers up to 64 bit are `int`; everything else travels as `string`."""
    is_int = isinstance(value, int) and not isinstance(value, bool)
    return "int" if is_int and -(2**63) <= value < 2**63 else "string"


def parameter_text(value) -> str:
    """Text of one query parameter (the column form of these casts is in functions.values)."""
    if value is None:
        raise ValueError("a parameter needs a value")
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, dt.datetime):
        zone = value.strftime("%z")
        offset = f"{zone[:3]}:{zone[3:]}" if zone else ""
        return value.strftime("%Y-%m-%dT%H:%M:%S.%f") + "0" + offset
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple, set)):
        return "[" + ",".join(parameter_text(v) for v in value) + "]"
    return str(value).replace('"', '\\"')


def declare(**values) -> dict[str, tuple[str, str]]:
    """name -> (declared type, text) for a set of query parameters."""
    return {f"${name}": (parameter_type(v), parameter_text(v)) for name, v in values.items()}


def with_parameters(spark: SparkSession, text: str, values: dict, **frames: DataFrame) -> DataFrame:
    """Run SQL with named markers; values are bound as literals, never pasted into the text."""
    return spark.sql(text, args=values, **frames)


# patterns --------------------------------------------------------------------
def to_java_pattern(pattern: str) -> str:
    """`/body/flags` or a plain body to the form `rlike` takes. `U` has no effect."""
    body, flags = pattern, ""
    delimited = re.fullmatch(rf"/(.*)/([{REGEX_FLAGS}]*)", pattern, re.S)
    if delimited:
        body, flags = delimited.group(1), delimited.group(2)
    inline = "".join(f for f in "ims" if f in flags)
    return f"(?{inline}){body}" if inline else body


def split_patterns(spark: SparkSession, patterns: Iterable[str]) -> tuple[dict[str, str], list[str]]:
    """Compile-check patterns with the engine's own regex dialect: (valid, rejected)."""
    valid, rejected = {}, []
    for p in patterns:
        java = to_java_pattern(p)
        try:  # a test of one literal: the optimiser works it out, no job runs
            spark.sql("SELECT '' RLIKE :pattern", {"pattern": java}).collect()
            valid[p] = java
        except PySparkException:
            rejected.append(p)
    return valid, rejected


def match_patterns(df: DataFrame, column: str, patterns: dict[str, str], out: str = "pattern") -> DataFrame:
    """One row per (row, matching pattern). The patterns are parameters, so this is a
    projection, not a join."""
    hits = F.array_compact(
        F.array(*[F.when(F.col(column).rlike(java), F.lit(p)) for p, java in patterns.items()])
    )
    return df.withColumn(out, F.explode(hits))


def allowed(df: DataFrame, allow_list: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose (user, predicate) pair is on the allow-list."""
    return having(df, allow_list, keys)
