"""Latest state of a stream, and its indexes, in buckets and levels: a batch costs what it brings.

Changes are filed by node into buckets. A batch writes one run (the fewest changes with the same
outcome) for each of its buckets, and a bucket that has been written `fan_out` times folds its young
runs into one of the next level, as a counter carries: a change is so rewritten once a level, and a
run of level n stands for `fan_out` ** n writes. Buckets carry at different batches, so no batch pays for
all of them. What is live is named by a manifest per batch; runs no manifest needs are emptied."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from quadloom.functions import text as tx
from quadloom.model import FACT_COLUMNS, LOG_SCHEMA
from quadloom.operators.mutate import NODE_KEY, resolve
from quadloom.plans.cut import written
from quadloom.plans.semi import having
from quadloom.streaming.feeds import compact


class Run(NamedTuple):
    """A live run: where it is (bucket, batch that wrote it), its level and rows, and how often
    its bucket has been written."""

    bucket: int
    batch: int
    level: int
    rows: int
    writes: int


MANIFEST = "bucket int, batch long, level int, rows long, writes long"


class Levels:
    """Rows of any kind kept in buckets and levels in `folder`.

    `schema` is that of the rows, `keys` are hashed to the bucket, and `fewest` folds rows of any
    runs to the fewest with the same outcome. A batch reads and writes its own buckets only: its rows
    and those of the young runs it carries go through one aggregation into one table, and nothing is
    held by executors between batches. Repeating the last batch gives the same runs and the same
    manifest, as runs named by the manifest before it are kept."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, keys: Sequence[Column | str], fewest: Callable[[DataFrame], DataFrame], buckets: int = 64, fan_out: int = 4):
        self.spark, self.folder, self.schema, self.keys, self.fewest = spark, folder.rstrip("/"), schema, list(keys), fewest
        self.buckets, self.fan_out = buckets, fan_out
        self.filed = StructType([*schema.fields, StructField("bucket", IntegerType())])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    # the manifest ---------------------------------------------------------------
    def manifest(self, batch_id: int) -> list[Run]:
        """The live runs after a batch: at most buckets x levels lines."""
        if batch_id < 0:
            return []
        lines = self.spark.read.schema(f"{MANIFEST}, after long").parquet(f"{self.folder}/manifest").where(F.col("after") == batch_id)
        return sorted(Run(*r) for r in lines.select("bucket", "batch", "level", "rows", "writes").collect())

    def _keep(self, batch_id: int, runs: list[Run]) -> None:
        lines = self.spark.createDataFrame([tuple(r) for r in runs], MANIFEST)
        lines.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifest/after={batch_id}")

    def carried(self, writes: int, bucket: int) -> int:
        """The level of the run written as the bucket's write number `writes`: as many levels are
        folded as the counter has trailing zeros. Each bucket's counter starts at its own number."""
        count, level = writes + bucket % self.fan_out**2, 0
        while count % self.fan_out == 0 and count:
            count, level = count // self.fan_out, level + 1
        return level

    # runs -----------------------------------------------------------------------
    def _read(self, runs: Iterable[Run]) -> DataFrame:
        base = f"{self.folder}/runs"
        paths = [f"{base}/batch={r.batch}/bucket={r.bucket}" for r in runs]
        if not paths:
            return self.spark.createDataFrame([], self.filed)
        return self.spark.read.schema(self.filed).option("basePath", base).parquet(*paths).select(*self.filed.fieldNames())

    def fold(self, batch: DataFrame, batch_id: int) -> None:
        """Add a batch of rows."""
        names = self.schema.fieldNames()
        batch = batch.select(*names).withColumn("bucket", self.bucket()).persist()
        before = self.manifest(batch_id - 1)
        touched = sorted(r[0] for r in batch.select("bucket").distinct().collect())  # `buckets` numbers at most
        writes = dict.fromkeys(touched, 1) | {r.bucket: r.writes + 1 for r in before if r.bucket in set(touched)}
        level = {b: self.carried(writes[b], b) for b in touched}
        young = [r for r in before if r.bucket in level and r.level < level[r.bucket]]
        rows = batch.unionByName(self._read(young)) if young else batch
        out = f"{self.folder}/runs/batch={batch_id}"
        fewest = self.fewest(rows.select(*names)).withColumn("bucket", self.bucket())
        fewest.hint("rebalance", "bucket").sortWithinPartitions("bucket", *self.keys).write.partitionBy("bucket").mode("overwrite").parquet(out)
        batch.unpersist()
        counts = dict(self.spark.read.schema(self.filed).parquet(out).groupBy("bucket").count().collect())
        gone = set(young)
        after = [r._replace(writes=writes.get(r.bucket, r.writes)) for r in before if r not in gone]
        after += [Run(b, batch_id, level[b], counts[b], writes[b]) for b in touched if b in counts]  # rows may cancel out
        self._keep(batch_id, sorted(after))
        self._empty(batch_id, before, after)

    def _empty(self, batch_id: int, before: list[Run], after: list[Run]) -> None:
        """Empty the runs of batches that neither this manifest nor the one before names, so that
        repeating this batch finds what it needs. Each is emptied once, when it drops out."""
        older = {r.batch for r in self.manifest(batch_id - 2)}
        for gone in sorted(older - {r.batch for r in before} - {r.batch for r in after}):
            empty = self.spark.createDataFrame([], self.filed)
            empty.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/runs/batch={gone}")

    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = False) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.fold).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    # reading --------------------------------------------------------------------
    def rows(self, batch_id: int, buckets: Iterable[int] | None = None) -> DataFrame:
        """The live rows after a batch (the last one or the one before it), of all buckets or some."""
        wanted = None if buckets is None else set(buckets)
        return self._read(r for r in self.manifest(batch_id) if wanted is None or r.bucket in wanted).drop("bucket")

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """The buckets that hold rows of these keys: `buckets` numbers at most."""
        return [r[0] for r in keys.select(self.bucket().alias("b")).distinct().collect()]


class LeveledState(Levels):
    """The state a change log leaves behind, kept after each batch. Late changes lose by their
    commit timestamp; deletes and ends of life are kept, so that they do."""

    def __init__(self, spark: SparkSession, folder: str, list_predicates: Iterable[str] = (), buckets: int = 64, fan_out: int = 4):
        self.lists = list(list_predicates)
        super().__init__(spark, folder, LOG_SCHEMA, NODE_KEY, lambda rows: compact(rows, self.lists), buckets, fan_out)

    def state(self, batch_id: int) -> DataFrame:
        """Facts after a batch."""
        return resolve(self.rows(batch_id), self.lists).select(*FACT_COLUMNS)

    def of_nodes(self, batch_id: int, nodes: DataFrame) -> DataFrame:
        """Facts of some nodes (namespace, subject): their buckets' runs alone are read."""
        own = having(self.rows(batch_id, self.buckets_of(nodes)), nodes, NODE_KEY)
        return resolve(own, self.lists).select(*FACT_COLUMNS)

    def node(self, batch_id: int, namespace: int, subject: int) -> DataFrame:
        """Facts of one node."""
        return self.of_nodes(batch_id, self.spark.createDataFrame([(namespace, subject)], "namespace long, subject long"))


# indexes -----------------------------------------------------------------------
INDEX = StructType([
    StructField(name, kind())
    for name, kind in (("kind", StringType), ("namespace", LongType), ("predicate", StringType), ("entry", StringType), ("uid", LongType), ("n", LongType))
])
#: Parts an entry is spread over, so that a very common one does not fill a bucket.
PARTS = 8


def exact_entries(facts: DataFrame) -> DataFrame:
    return facts.where("value is not null").select("namespace", "predicate", F.col("value").alias("entry"), F.col("subject").alias("uid"))


def term_entries(facts: DataFrame) -> DataFrame:
    return facts.where("value is not null").select("namespace", "predicate", F.explode(tx.terms(F.col("value"))).alias("entry"), F.col("subject").alias("uid"))


def trigram_entries(facts: DataFrame) -> DataFrame:
    return facts.where("value is not null").select("namespace", "predicate", F.explode(tx.trigrams(F.col("value"))).alias("entry"), F.col("subject").alias("uid"))


def reverse_entries(facts: DataFrame) -> DataFrame:
    return facts.where("object_uid is not null").select("namespace", "predicate", F.col("object_uid").cast("string").alias("entry"), F.col("subject").alias("uid"))


def count_entries(facts: DataFrame) -> DataFrame:
    counts = facts.groupBy("namespace", "predicate", F.col("subject").alias("uid")).agg(F.count(F.lit(1)).alias("c"))
    return counts.select("namespace", "predicate", F.col("c").cast("string").alias("entry"), "uid")


KINDS = {"exact": exact_entries, "term": term_entries, "trigram": trigram_entries, "reverse": reverse_entries, "count": count_entries}


class KeptIndexes:
    """Indexes of a changing state, kept up from the log without building them again.

    A batch's nodes are resolved before and after it; what their facts give an index before is taken
    back (n = -1), what they give after is put in (+1), and what stays cancels out. The signed rows
    are kept in levels as the state is; an entry holds where its sum is above 0. A batch reads
    the buckets of its nodes and writes rows for what it changes only."""

    def __init__(self, spark: SparkSession, folder: str, kinds: Sequence[str] = tuple(KINDS), list_predicates: Iterable[str] = (), buckets: int = 64, fan_out: int = 4):
        self.spark, self.kinds = spark, list(kinds)
        self.state = LeveledState(spark, f"{folder}/state", list_predicates, buckets, fan_out)
        part = F.pmod(F.xxhash64("uid"), F.lit(PARTS))
        self.index = Levels(spark, f"{folder}/index", INDEX, ["kind", "namespace", "predicate", "entry", part], summed, buckets, fan_out)

    def derived(self, facts: DataFrame, n: int) -> DataFrame:
        made = [KINDS[k](facts).select(F.lit(k).alias("kind"), "namespace", "predicate", "entry", "uid", F.lit(n).cast("long").alias("n")) for k in self.kinds]
        return reduce(DataFrame.unionByName, made)

    def fold(self, batch: DataFrame, batch_id: int) -> None:
        """Add a batch of changes to the state and to every index."""
        nodes = written(batch.select(*NODE_KEY).distinct(), "nodes")
        before = written(self.state.of_nodes(batch_id - 1, nodes), "before")
        self.state.fold(batch, batch_id)
        after = written(self.state.of_nodes(batch_id, nodes), "after")
        self.index.fold(summed(self.derived(before, -1).unionByName(self.derived(after, 1))), batch_id)

    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = False) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.fold).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def entries(self, batch_id: int) -> DataFrame:
        """(kind, namespace, predicate, entry, uid) of all indexes after a batch."""
        return summed(self.index.rows(batch_id)).where("n > 0").drop("n")

    def lookup(self, batch_id: int, kind: str, namespace: int, predicate: str, entry: str) -> DataFrame:
        """The nodes of one entry: the buckets of its parts alone are read."""
        some = _a_uid_of_each_part(self.spark).collect()  # PARTS lines
        key = "kind string, namespace long, predicate string, entry string, uid long"
        spread = self.index.buckets_of(self.spark.createDataFrame([(kind, namespace, predicate, entry, r["uid"]) for r in some], key))
        rows = self.index.rows(batch_id, spread)
        wanted = (F.col("kind") == kind) & (F.col("namespace") == namespace) & (F.col("predicate") == predicate) & (F.col("entry") == entry)
        return summed(rows.where(wanted)).where("n > 0").select("uid")


def _a_uid_of_each_part(spark: SparkSession) -> DataFrame:
    """For each part some uid that falls into it."""
    return spark.range(64 * PARTS).groupBy(F.pmod(F.xxhash64("id"), F.lit(PARTS)).alias("part")).agg(F.min("id").alias("uid")).drop("part")


def summed(rows: DataFrame) -> DataFrame:
    """Signed index rows, each once with its sum; rows taken back vanish."""
    return rows.groupBy("kind", "namespace", "predicate", "entry", "uid").agg(F.sum("n").alias("n")).where("n != 0")
