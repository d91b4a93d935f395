"""Expansion to any depth: a fixpoint over a frontier table.

Every round follows the edges of the nodes found last, drops the nodes a root has reached before and
writes what is new; a cycle ends where it meets a reached node, and the whole ends when a round finds
nothing. Edges and reached nodes are stored in buckets of their node, and a round reads the
buckets of its frontier only, so a small frontier reads little of a large graph. Lineage never grows
beyond a round.

Roots whose uids share a word of 64 travel together: a node has one row per round and word, with a bit
per root, and only the result has a row per root. Roots with uids far apart have words of their own."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quadloom.model import namespace_of
from quadloom.operators.traverse import TypeInfo, typed_edges, typed_nodes
from quadloom.plans.cut import fresh_path

#: Edges of a bucket, and buckets at least and at most; the driver sees one number a bucket and round.
BUCKET_EDGES, LEAST_BUCKETS, MOST_BUCKETS = 1 << 20, 8, 4096
#: `bits` are the roots of `word` that reach the node in this round; `by` says which of them by what edge, in 64 parts at most.
REACHED = "namespace long, word long, uid long, bits long, by array<struct<bits: long, parent: long, via: string>>, depth int, bucket int"
KEY = ["namespace", "bucket", "uid", "word"]
#: Ranges of uids, at most, that describe a large frontier.
ZONES = 64


@dataclass
class Rounds:
    """What the rounds did: new nodes and buckets of the edges read, round by round."""

    found: list[int] = field(default_factory=list)
    read: list[int] = field(default_factory=list)


def bucket_of(node: str | Column, buckets: int) -> Column:
    """The hash by which Spark deals rows out, so that `repartition(buckets, node)` has a bucket a task."""
    return F.pmod(F.hash(node), F.lit(buckets)).cast("int")


@contextmanager
def joined_as_they_lie(spark: SparkSession) -> Iterator[None]:
    """Joins planned here take sides dealt out alike by a part of their key as they are."""
    conf, key = spark.conf, "spark.sql.requireAllClusterKeysForCoPartition"
    before = conf.get(key, None)
    conf.set(key, "false")
    try:
        yield
    finally:
        conf.set(key, before) if before is not None else conf.unset(key)


def one_bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def places(bits: Column) -> Column:
    """One row per bit that is set: its place."""
    return F.explode(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit(bits, i) == 1))


def within(column: str, frontier: DataFrame, least: int, most: int) -> Column:
    """Whether a uid lies in one of the ranges of the frontier's uids, ZONES or so from `least` to `most`."""
    zone = F.call_function("div", F.col("uid"), F.lit((most - least) // ZONES + 1).cast("long"))
    zones = frontier.groupBy(zone).agg(F.min("uid").alias("low"), F.max("uid").alias("high")).collect()
    return reduce(Column.__or__, [F.col(column).between(z["low"], z["high"]) for z in zones])


def reach(
    roots: DataFrame, edges: DataFrame, max_depth: int | None = None, buckets: int | None = None, rounds: Rounds | None = None, words: bool = False
) -> DataFrame:
    """(namespace, root, uid, depth, parent, via): every node each root reaches, at its least
    number of steps, with the least (parent, predicate) that leads there in so many.

    `roots` has uid, `edges` src, dst and, if it has one, predicate; both may have namespace, and
    an edge is followed in its own tenant only. A root reaches itself at depth 0, without a parent.
    Edges to nodes without edges of their own are followed too; repeated edges and roots count once;
    null ends lead nowhere. Without `max_depth` the rounds go on until nothing new is found. `words`: rows as
    they are stored, 64 roots a row, for `per_root` after a join."""
    found = reach_words(roots, edges, max_depth, buckets, rounds)
    return found if words else per_root(found).select("namespace", "root", "uid", "depth", "parent", "via")


def per_root(found: DataFrame) -> DataFrame:
    """Rows of `reach_words`, and what was joined to them, with one row per root."""
    rest = [c for c in found.columns if c not in ("word", "bits", "by", "bucket")]
    parts = found.select(*rest, "word", F.explode("by").alias("_by"))
    return parts.select(*rest, "word", "_by.parent", "_by.via", places(F.col("_by.bits")).alias("_place")).select(
        *rest, "parent", "via", (F.shiftleft("word", 6) + F.col("_place")).alias("root"))


def reach_words(roots: DataFrame, edges: DataFrame, max_depth: int | None = None, buckets: int | None = None, rounds: Rounds | None = None) -> DataFrame:
    """What `reach` gives, as rows of REACHED: 64 roots a row."""
    spark, folder = roots.sparkSession, fresh_path(roots.sparkSession, "reach")
    via = F.col("predicate") if "predicate" in edges.columns else F.lit("")
    if buckets is None:
        buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, edges.count() // BUCKET_EDGES))
    linked = edges.select(namespace_of(edges).alias("namespace"), "src", "dst", via.alias("via"), bucket_of("src", buckets).alias("bucket"))
    linked = linked.where("src is not null and dst is not null")
    linked.hint("rebalance", "bucket").sortWithinPartitions("bucket", "src").write.partitionBy("bucket").parquet(f"{folder}/edges")
    stored = spark.read.schema("namespace long, src long, dst long, via string, bucket int").parquet(f"{folder}/edges")

    start = roots.where("uid is not null").select(namespace_of(roots).alias("namespace"), F.col("uid").cast("long").alias("uid")).distinct()
    own = one_bit(F.col("uid").bitwiseAND(F.lit(63).cast("long")))
    by = lambda parent, via: F.struct("bits", parent.alias("parent"), via.alias("via"))
    none = F.lit(None)
    new = start.withColumn("word", F.shiftright("uid", 6)).withColumn("bits", own).withColumn("bucket", bucket_of("uid", buckets)).withColumn(
        "by", F.array(by(none.cast("long"), none.cast("string")))).repartition("uid")
    depth, rounds = 0, rounds or Rounds()
    reached = spark.read.schema(REACHED)
    while True:
        path = f"{folder}/reached/depth={depth}"
        with joined_as_they_lie(spark):
            new.select("namespace", "word", "uid", "bits", "by", "bucket").write.partitionBy("bucket").parquet(path)
        frontier = reached.option("basePath", f"{folder}/reached").parquet(path)
        counts = frontier.groupBy("bucket").agg(  # one line per bucket
            F.sum(F.bit_count("bits")).alias("n"), F.min("uid").alias("least"), F.max("uid").alias("most")).collect()
        rounds.found.append(sum(r["n"] for r in counts))
        if not counts or depth == max_depth:
            break
        touched = [r["bucket"] for r in counts]
        rounds.read.append(len(touched))
        few = rounds.found[-1] < buckets
        followed = stored.where(F.col("bucket").isin(touched))
        if not few:  # a large frontier moves the edges: only those that can be its own
            followed = followed.where(within("src", frontier, min(r["least"] for r in counts), max(r["most"] for r in counts)))
        step = frontier.select("namespace", "word", "bits", F.col("uid").alias("src"), "bucket").join(followed, ["namespace", "bucket", "src"])
        best = step.groupBy("namespace", F.col("dst").alias("uid"), "word", "bits").agg(F.min(F.struct("src", "via")).alias("edge"))
        before = reached.parquet(f"{folder}/reached")
        if few:  # few nodes lead to few buckets: look only there
            ahead = step.select(bucket_of("dst", buckets).alias("b")).distinct()
            before = before.where(F.col("bucket").isin([r["b"] for r in ahead.collect()]))
        # Both sides lie by node from here on: one shuffle each, and the buckets are written as they lie.
        lie = ["uid"] if few else [buckets, "uid"]
        best = best.withColumn("bucket", bucket_of("uid", buckets)).repartition(*lie)
        seen = before.select(*KEY, "bits").repartition(*lie).groupBy(*KEY).agg(F.bit_or("bits").alias("seen"))
        fresh = best.join(seen, KEY, "left").withColumn("bits", F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("seen", F.lit(0).cast("long")))))
        least = fresh.where("bits <> 0").select(*KEY, "edge", places(F.col("bits")).alias("place")).groupBy(*KEY, "place").agg(F.min("edge").alias("edge"))
        parts = least.groupBy(*KEY, "edge.src", "edge.via").agg(F.bit_or(one_bit(F.col("place"))).alias("bits"))
        new = parts.groupBy(*KEY).agg(F.bit_or("bits").alias("all"), F.collect_list(by(F.col("src"), F.col("via"))).alias("by")).withColumnRenamed("all", "bits")
        depth += 1
    return reached.parquet(f"{folder}/reached")


def expand_to_any_depth(types: dict[str, TypeInfo], type_name: str, max_depth: int | None = None, key: str = "uid") -> DataFrame:
    """Every predicate of a type and of all types its edges lead to, until nothing new is reached:
    (root, uid, depth, parent, via, type, fields), one row per root and node. Each table of nodes
    and of edges is read once. Uids name a node whatever its type."""
    edges = reduce(DataFrame.unionByName, [e.select("src", "dst", "predicate") for e in typed_edges(types)])
    found = reach(types[type_name].nodes.select(F.col(key).alias("uid")), edges, max_depth, words=True)
    nodes = reduce(DataFrame.unionByName, [typed_nodes(types, name, key) for name in types])
    return per_root(found.drop("namespace").join(nodes, "uid")).select("root", "uid", "depth", "parent", "via", "type", "fields")
