"""Sorting, paging and top-k. Every limit has a total order."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quadloom.plans.rank import positions

# Beyond this many rows to skip, a page is cut by distributed positions: a limit
# with an offset keeps offset + n rows in every task and then in one.
DEEP_OFFSET = 100_000


def first(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, order: list[Column], count: int, offset: int = 0) -> DataFrame:
    if offset + count <= DEEP_OFFSET:
        return df.orderBy(*order).offset(offset).limit(count)
    ranked = positions(df, order, out="_pos")
    return ranked.where((F.col("_pos") > offset) & (F.col("_pos") <= offset + count)).drop("_pos")


def after(df: DataFrame, cursor: int, n: int, key: str = "uid") -> DataFrame:
    """Keyset paging: the range filter reaches the scan, so page depth costs nothing."""
    return df.where(F.col(key) > cursor).orderBy(key).limit(n)


def top_per_parent(df: DataFrame, parent: str, order: list[Column], k: int) -> DataFrame:
    """First k rows per parent. The rank filter is pushed below the shuffle, so each
    task sends at most k rows per parent, however hot the parent is."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(parent).orderBy(*order)))
    return ranked.where(F.col("_rank") <= k).withColumnRenamed("_rank", "rank")


def by_language(nodes: DataFrame, facts: DataFrame, predicate: str, preference: list[str], descending: bool = False, out: str = "position") -> DataFrame:
    """Nodes (namespace, uid) with the predicate's value in the first language present and
    their position in the order of it, nodes without a value last, ties by node."""
    from quadloom.operators.facet_ops import in_language

    value = in_language(facts, predicate, preference)
    rows = nodes.join(value, ["namespace", "uid"], "left")
    first = F.desc_nulls_last(predicate) if descending else F.asc_nulls_last(predicate)
    return positions(rows, [first, F.asc("namespace"), F.asc("uid")], out=out)


def known_locales(spark: SparkSession) -> set[str]:
    """The locales the engine has dictionary orders of."""
    rows = spark.sql("SELECT name FROM collations()").collect()  # a fixed list of the engine
    return {r["name"] for r in rows if not r["name"].startswith(("UTF8", "UNICODE")) and not r["name"].endswith(("_CI", "_AI", "_RTRIM"))}


def by_locale(df: DataFrame, column: str, lang: str, languages: Iterable[str], ties: list[Column], descending: bool = False, out: str = "position") -> DataFrame:
    """Rows with their position in the dictionary order of `column`, language by language.

    `languages` are tags from metadata; each list is ordered by the rules of its own language (base
    letters first, then accents, then case), texts the rules hold equal by code point, then by
    `ties`. Rows of other tags, of none, and of tags without rules are one list each by code point.
    Null texts come last. Range bounds, ties and positions all go by the collated text, so a hot
    language is spread over partitions as any order is."""
    known, listed = known_locales(df.sparkSession), sorted(set(languages))
    way = (lambda c: c.desc_nulls_last()) if descending else (lambda c: c.asc_nulls_last())
    lists = []
    for tag in listed:
        own = df.where(F.col(lang) == tag)
        text = F.collate(F.col(column), tag) if tag in known else F.col(column)
        lists.append(positions(own.withColumn("_key", text), [way(F.col("_key")), way(F.col(column)), *ties], out=out).drop("_key"))
    rest = df.where(~F.coalesce(F.col(lang).isin(listed), F.lit(False)))
    lists.append(positions(rest, [way(F.col(column)), *ties], group=[lang], out=out))
    return reduce(DataFrame.unionByName, lists)


def latest(df: DataFrame, order: str) -> DataFrame:
    """The one newest row, as one aggregation without a sort."""
    whole = F.struct(*df.columns)
    return df.agg(F.max_by(whole, F.col(order)).alias("r")).select("r.*")


def newer_than_latest(candidates: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Candidates after the newest finished one; all of them if none is finished."""
    newest = done.agg(F.max(key)).scalar()
    return candidates.where(newest.isNull() | (F.col(key) > newest))
