"""Change feeds as streams: subscription by predicate prefix and streaming apply."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from quadloom.model import FACT_COLUMNS, LOG_SCHEMA, OP_DEL, OP_OVR, STAR
from quadloom.operators.mutate import PREDICATE_KEY, change_order, resolve


def log_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A folder of change-log files read as a stream."""
    reader = spark.readStream.schema(LOG_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def matching(log: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Changes of predicates that start with one of the prefixes. Prefixes are parameters
    of the subscription, so this is a filter that also prunes a batch read."""
    wanted = F.lit(False)
    for p in prefixes:
        wanted = wanted | F.col("predicate").startswith(p)
    return log.where(wanted)


def subscribe(stream: DataFrame, prefixes: Sequence[str], path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Deliver matching changes to a folder, each exactly once (file sink with its log)."""
    writer = (
        matching(stream, prefixes)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


class StreamingState:
    """Latest state kept up to date by micro-batches, as a folder of compacted changes.

    Batch n writes only its own changes (`delta=n`); every `merge_every` batches the last
    base and the deltas since are folded into a new base. A batch so costs what it brings,
    and the whole state is rewritten once per `merge_every` batches. Repeating a batch after
    a failure rewrites the same folders with the same rows. Kept is the winning change of
    every key, deletes and ends of life included, so late changes with a lower commit
    timestamp still lose. No state lives in executors."""

    def __init__(self, spark: SparkSession, folder: str, list_predicates: Iterable[str] = (), merge_every: int = 16):
        self.spark, self.folder, self.lists = spark, folder.rstrip("/"), list(list_predicates)
        self.merge_every = merge_every

    def _path(self, kind: str, batch_id: int) -> str:
        return f"{self.folder}/{kind}={batch_id:012d}"

    def _exists(self, path: str) -> bool:
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(jvm_path)

    def _changes(self, last: int) -> DataFrame:
        """The newest base up to batch `last` and the deltas after it."""
        base = (last + 1) // self.merge_every * self.merge_every - 1
        paths = [self._path("base", base)] if base >= 0 else []
        paths += [p for p in (self._path("delta", i) for i in range(base + 1, last + 1)) if self._exists(p)]
        if not paths:
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(*paths).select(*LOG_SCHEMA.fieldNames())

    def fold(self, batch: DataFrame, batch_id: int) -> None:
        delta = self._path("delta", batch_id)
        compact(batch.select(*LOG_SCHEMA.fieldNames()), self.lists).write.mode("overwrite").parquet(delta)
        if (batch_id + 1) % self.merge_every == 0:
            own = self.spark.read.schema(LOG_SCHEMA).parquet(delta)
            merged = self._changes(batch_id - 1).unionByName(own.select(*LOG_SCHEMA.fieldNames()))
            compact(merged, self.lists).write.mode("overwrite").parquet(self._path("base", batch_id))

    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = False) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.fold).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def state(self, batch_id: int) -> DataFrame:
        """Facts after a batch."""
        return resolve(self._changes(batch_id), self.lists).select(*FACT_COLUMNS)


def compact(log: DataFrame, list_predicates: Iterable[str] = ()) -> DataFrame:
    """The fewest changes with the same outcome: the last change of every key plus the last
    star delete or overwrite of every predicate and node."""
    lists = list(list_predicates)
    is_list = F.col("predicate").isin(lists) if lists else F.lit(False)
    star = (F.col("op") == OP_DEL) & ((F.col("predicate") == STAR) | (F.coalesce("value", F.lit("")) == STAR))
    # A key is its element for lists; star deletes and overwrites keep one row of their own kind.
    kind = F.when(star, "star").when((F.col("op") == OP_OVR) & is_list, "over").otherwise("value")
    element = F.when(is_list & ~star, F.coalesce(F.col("object_uid").cast("string"), F.col("value")))
    names = LOG_SCHEMA.fieldNames()
    rest = [n for n in names if n not in PREDICATE_KEY and n != "lang"]
    kinds = F.when(kind == "over", F.array(F.lit("over"), F.lit("value"))).otherwise(F.array(kind))
    rows = log.select("*", element.alias("_element"), F.explode(kinds).alias("_kind"))
    rows = rows.withColumn("_element", F.when(F.col("_kind") == "value", F.col("_element")))
    best = rows.groupBy(*PREDICATE_KEY, "lang", "_element", "_kind").agg(
        F.max_by(F.struct(*rest), change_order()).alias("w")
    )
    return best.select(*PREDICATE_KEY, "lang", "w.*").select(*names)
