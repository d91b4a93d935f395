"""Nested lists of bounded size.

A parent may own a third of all rows, so its children never go into one array
unless their number is known to fit. Parents above `page_size` are split into
pages in the order of the list; the pages of one parent, read in page order, are
the whole list. Nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quadloom.plans.cut import written
from quadloom.plans.rank import positions

PAGE_SIZE = 100_000


#: Groups above the page size, up to so many, are sent to all tasks: no shuffle of the rows to find theirs.
FEW_GROUPS = 1 << 16


def _largest(df: DataFrame, group: list[str], page_size: int = PAGE_SIZE) -> tuple[int, int]:
    """Rows of the largest group, and the number of groups above `page_size`."""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    most, above = sizes.agg(F.max("_n"), F.count_if(F.col("_n") > page_size)).first()
    return most or 0, above


def with_page(df: DataFrame, group: Sequence[str], order: Sequence[str], page_size: int = PAGE_SIZE, stored: bool = False) -> DataFrame:
    """Add `page`: 0 for every row of a parent that fits, else position // page_size.

    The size check is one pre-aggregated count over the group columns alone; only
    when some parent is too large are its rows ranked by range partitions. `stored`: `df` is a
    written table already."""
    group = list(group)
    most, above = _largest(df, group, page_size)
    if most <= page_size:
        return df.withColumn("page", F.lit(0).cast("long"))
    if not stored:
        df = written(df, "paged")  # read three times below
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    big = sizes.where(F.col("_n") > page_size).select(*group)  # at most rows / page_size rows
    if above <= FEW_GROUPS:
        big = F.broadcast(big)
    small_rows = df.join(big, group, "left_anti").withColumn("page", F.lit(0).cast("long"))
    big_rows = positions(
        df.join(big, group, "left_semi"), [F.col(o).asc() for o in order], group=group, out="_pos"
    )
    big_rows = big_rows.withColumn("page", F.floor((F.col("_pos") - 1) / page_size).cast("long")).drop("_pos")
    return small_rows.unionByName(big_rows)


def nest(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    items: Column | None = None,
    out: str = "items",
    page_size: int = PAGE_SIZE,
    keep: bool = False,
    unique: bool = False,
) -> DataFrame:
    """One row per (group, page) with the sorted array of children.

    `order` names the sort columns (ascending, total within the group); `items` is the
    element built from a row, by default the struct of all non-group columns (or the
    order column itself, if there is no other).
    With `keep`, the rows are written once first: right where they come from a join or
    an aggregation that the size check would otherwise run a second time. With `unique`,
    equal children count once; lists that fit are made as sets, without a shuffle of their
    own to remove repetitions."""
    group, order = list(group), list(order)
    if keep:
        df = written(df, "children")
    gather, fits = F.collect_list, False
    if unique:
        fits = _largest(df, group)[0] <= page_size
        gather, df, keep = (F.collect_set, df, keep) if fits else (F.collect_list, df.distinct(), False)
    rest = [c for c in df.columns if c not in group]
    element = items if items is not None else F.struct(*rest)
    rows = df.withColumn("page", F.lit(0).cast("long")) if fits else with_page(df, group, order, page_size, stored=keep)
    if len(order) == 1 and items is None and rest == order:
        return rows.groupBy(*group, "page").agg(F.sort_array(gather(order[0])).alias(out))
    rows = rows.select(*group, "page", F.struct(*[F.col(o) for o in order], element.alias("_item")).alias("_e"))
    lists = rows.groupBy(*group, "page").agg(F.sort_array(gather("_e")).alias("_list"))
    return lists.select(*group, "page", F.col("_list._item").alias(out))
