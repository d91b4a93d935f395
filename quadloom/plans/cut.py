"""Cutting lineage in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


@cache
def _private_folder() -> tempfile.TemporaryDirectory:
    """One folder per process, removed when the process ends."""
    return tempfile.TemporaryDirectory(prefix="quadloom-")


#: Files a task writes at once.
OPEN_FILES = 8

_paths: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the session names; a private one only for local runs
    that name none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = _private_folder().name
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/quadloom-{name}-{uuid.uuid4().hex}"
    _paths.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Empty every table this process has written so far, once no frame that reads one is
    needed any more; the number of tables. Paths that hold no table are left alone."""
    done = 0
    while _paths:
        path = _paths.pop()
        try:
            fields = spark.read.parquet(path).schema
        except AnalysisException:
            continue
        spark.createDataFrame([], fields).coalesce(1).write.mode("overwrite").parquet(path)
        done += 1
    return done


def write_folders(df: DataFrame, path: str, *columns: str) -> None:
    """Write `df` in folders by `columns`. A task keeps up to OPEN_FILES files open at once and so
    need not sort all its rows by folder first; only what goes beyond them is sorted."""
    conf, key = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key, None)
    conf.set(key, OPEN_FILES)
    try:
        df.write.partitionBy(*columns).parquet(path)
    finally:
        conf.set(key, before) if before is not None else conf.unset(key)


def written(df: DataFrame, name: str = "cut", partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` once and read it back: survives executor loss, keeps column pruning,
    and pins what depends on task placement (sampled ranges, partition ids)."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if partition_by:
        write_folders(df.hint("rebalance", *partition_by), path, *partition_by)  # gathered first: files follow the size
    else:
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    return back.select(*df.columns)
