"""Edge expansion. Joins are equi-joins on BIGINT; Spark picks broadcast or
sort-merge from sizes it has checked, and splits skewed partitions at run time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quadloom.plans.cut import written
from quadloom.plans.pages import FEW_GROUPS, PAGE_SIZE, nest
from quadloom.plans.semi import with_partners

#: Rows of a level, above which a node they reach is followed in parts.
HUB_ROWS = 1 << 9


def reverse(edges: DataFrame) -> DataFrame:
    """The same edges read from target to source."""
    others = [c for c in edges.columns if c not in ("src", "dst")]
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *others)


def expand(
    parents: DataFrame,
    edges: DataFrame,
    children: DataFrame,
    where: Column | None = None,
    keep_childless: bool = False,
    key: str = "uid",
    child_key: str = "uid",
    prefix: str = "",
) -> DataFrame:
    """Parent rows joined to the children an edge leads to.

    `where` filters children before the join (parents stay). With `keep_childless`
    a parent without a surviving child keeps its own fields and null child fields."""
    if where is not None:
        children = children.where(where)
    target = f"{prefix}{child_key}"
    renamed = children.select(*[F.col(c).alias(f"{prefix}{c}") for c in children.columns])
    hop = edges.withColumnRenamed("dst", target)
    if keep_childless:
        return with_partners(parents, hop.join(renamed, target), key, "src")
    # Roots are usually few: they cut the edges down before the children are read.
    return parents.join(hop, parents[key] == hop["src"]).join(renamed, target).drop("src")


def follow(nodes: DataFrame, link: str, targets: DataFrame, key: str = "uid", how: str = "inner") -> DataFrame:
    """Expand a single-valued edge held as a uid column of the node row."""
    return nodes.join(targets, nodes[link] == targets[key], how)


def follow_path(nodes: DataFrame, steps: Sequence[tuple[str, DataFrame]], how: str = "inner") -> DataFrame:
    """Expand a chain of single-valued edges: each step names the edge column and the frame
    that has it as its key; the next step may use an edge column of that frame."""
    for link, targets in steps:
        nodes = nodes.join(targets, link, how)
    return nodes


def uid_matrix(edges: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Sorted distinct targets per source: (src, page, uids)."""
    return nest(
        edges.select("src", "dst"), ["src"], ["dst"], out="uids", page_size=page_size, unique=True
    )


def value_matrix(facts: DataFrame, order: Sequence[str], value: Column, page_size: int = PAGE_SIZE) -> DataFrame:
    """All values per node, in `order`: (namespace, subject, page, values)."""
    return nest(facts, ["namespace", "subject"], list(order), value, "values", page_size)


@dataclass
class TypeInfo:
    """What metadata says about one type: its node frame, value predicates and edges."""

    nodes: DataFrame
    values: Sequence[str]
    edges: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)


def typed_edges(types: dict[str, TypeInfo], names: Sequence[str] | None = None) -> list[DataFrame]:
    """(type, predicate, src, dst, target) of every edge of the named types (all by default)."""
    return [
        edges.select(F.lit(name).alias("type"), F.lit(predicate).alias("predicate"), "src", "dst", F.lit(target).alias("target"))
        for name in names or types for predicate, (edges, target) in types[name].edges.items()
    ]


def typed_nodes(types: dict[str, TypeInfo], name: str, key: str = "uid") -> DataFrame:
    """(uid, type, fields): a type's nodes with labels and values as a JSON object."""
    info = types[name]
    labels = [c for c in ("labels",) if c in info.nodes.columns and c not in info.values]
    return info.nodes.select(F.col(key).alias("uid"), F.lit(name).alias("type"), F.to_json(F.struct(*labels, *info.values)).alias("fields"))


def _in_parts(level: DataFrame, links: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a hop with `part`, one more key. A node where more than `rows` rows of the level
    meet deals them out over parts of about so many, and each part has all links of the node. Dealt by
    value: a task that runs again deals alike."""
    sizes = level.where("uid is not null").groupBy("type", F.col("uid").alias("src")).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("parts"))
    hubs = sizes.where("parts > 1").orderBy(F.col("parts").desc()).limit(FEW_GROUPS).collect()
    if not hubs:
        return level.withColumn("part", F.lit(0)), links.withColumn("part", F.lit(0))
    dealt = F.broadcast(level.sparkSession.createDataFrame(hubs, "type int, src long, parts int"))
    parts = F.coalesce("parts", F.lit(1))
    return (
        level.join(dealt.withColumnRenamed("src", "uid"), ["type", "uid"], "left").withColumn("part", F.pmod(F.xxhash64("root", "path", "parent"), parts).cast("int")).drop("parts"),
        links.join(dealt, ["type", "src"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts"),
    )


def expand_all(types: dict[str, TypeInfo], type_name: str, depth: int = 0, key: str = "uid", hub_rows: int | None = None) -> DataFrame:
    """Every predicate of a type, edges followed while depth > 0 (list and reverse edges too).

    One row per node reached: root, path (predicates joined by dots, empty for the root), the
    parent's uid, uid, type and `fields`, the node's labels and values as a JSON object. Sibling
    edges are rows of their own, so their lists do not multiply each other, and a hot
    parent is as many rows as it has children. Nodes, all levels but the last and the edges that lead
    to them are written once, so each table of edges or nodes is read once. The last level, which can
    be as large as the product of the numbers of ways into and out of its hubs, is never written or
    shuffled: its edges get the fields of their targets before they are followed. Nodes that more than `hub_rows` rows (HUB_ROWS)
    of a level reach are followed in parts, and a part's rows of one edge come in a row, so
    files of the result stay small. Types and predicates are numbers until the end. `reach` goes to any depth."""
    seen = [{type_name}]
    while len(seen) <= depth and (further := {target for name in seen[-1] for _, target in types[name].edges.values()}):
        seen.append(further)
    depth, leading = len(seen) - 1, [name for name in sorted(set().union(*seen[:-1])) if types[name].edges]
    names = sorted(set().union(*seen))
    kinds = [(name, predicate, target) for name in leading for predicate, (_, target) in types[name].edges.items()]

    def one_of(values: Sequence[str | int], at: str) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col(at))

    def of(rows: DataFrame, some: set[str]) -> DataFrame:
        return rows.where(F.col("type").isin([names.index(name) for name in sorted(some)]))

    def links(some: set[str]) -> list[DataFrame]:
        return [types[name].edges[predicate][0].select(F.lit(names.index(name)).alias("type"), F.lit(kind).alias("kind"), "src", "dst")
                for kind, (name, predicate, _) in enumerate(kinds) if name in some]

    def shown(rows: DataFrame) -> DataFrame:
        return rows.select("root", "path", "parent", "uid", one_of(names, "type").alias("type"), "fields")

    nodes = reduce(DataFrame.unionByName, [typed_nodes(types, name, key).withColumn("type", F.lit(names.index(name))) for name in names])
    start = types[type_name].nodes.select(
        F.col(key).alias("root"), F.lit("").alias("path"), F.lit(None).cast("long").alias("parent"), F.col(key).alias("uid"), F.lit(names.index(type_name)).alias("type"))
    if not kinds:
        return shown(start.join(nodes, ["type", "uid"]))
    nodes, target = written(nodes, "nodes"), one_of([names.index(target) for _, _, target in kinds], "kind")

    def hop(depth: int, edges: DataFrame, *more: str) -> DataFrame:
        level, keys = levels[depth], ["type", "src"]
        if depth:
            level, edges = _in_parts(of(level, seen[depth] & set(leading)), edges, hub_rows or HUB_ROWS)
            keys = [*keys, "part"]
        predicate = one_of([predicate for _, predicate, _ in kinds], "kind")
        step = F.when(F.col("path") == "", predicate).otherwise(F.concat_ws(".", "path", predicate))
        met = edges.join(level.drop("parent").withColumnRenamed("uid", "src"), keys)
        return met.select("root", step.alias("path"), F.col("src").alias("parent"), F.col("dst").alias("uid"), target.alias("type"), *more)

    levels, early = [start], set().union(*seen[:depth - 1])
    last = links(seen[depth - 1] - early)
    if early:
        edges = written(reduce(DataFrame.unionByName, links(early)), "edges")
        last += [of(edges, seen[depth - 1] & early)] if seen[depth - 1] & early else []
    for i in range(depth - 1):
        levels.append(written(hop(i, of(edges, seen[i])), "level"))
    upper = reduce(DataFrame.unionByName, levels).join(of(nodes, set().union(*seen[:depth])), ["type", "uid"])
    ends = reduce(DataFrame.unionByName, last).withColumn("target", target).join(
        of(nodes, seen[depth]).select(F.col("type").alias("target"), F.col("uid").alias("dst"), "fields"), ["target", "dst"]).drop("target")
    return shown(upper).unionByName(shown(hop(depth - 1, ends, "fields")))


def wide(
    facts: DataFrame,
    values: dict[str, str],
    edges: Sequence[str] = (),
    key: str = "uid",
) -> DataFrame:
    """Triples back to one row per node, (namespace, uid), for a known predicate list (from
    metadata). Values in a language stay out; `facet_ops.in_language` reads those.

    One aggregation with map-side combine; `values` maps predicate -> Spark type.
    List predicates are read with `value_matrix` instead."""
    untagged = F.col("lang").isNull()
    aggs = [
        F.max(F.when(untagged & (F.col("predicate") == p), F.col("value").try_cast(t))).alias(p)
        for p, t in values.items()
    ] + [F.max(F.when(F.col("predicate") == e, F.col("object_uid"))).alias(e) for e in edges]
    wanted = list(values) + list(edges)
    return (
        facts.where(F.col("predicate").isin(wanted))
        .groupBy("namespace", F.col("subject").alias(key))
        .agg(*aggs)
    )
