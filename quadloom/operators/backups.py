"""Backup chains: slices of a change log with a manifest that says what they hold.

A slice is a folder of changes in a range of commit timestamps, laid out by predicate, and a manifest
line: range, predicates, rows and a digest that does not depend on their order, both taken from the
files written. The manifest tells whether slices reach a timestamp without a gap, which of them are
the fewest rows to read, and whether a slice still holds what was written."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quadloom.model import FACT_COLUMNS, LOG_SCHEMA, STAR
from quadloom.operators.history import as_of
from quadloom.operators.mutate import in_namespace


class Slice(NamedTuple):
    """A manifest line: changes with since < commit_ts <= read, of the predicates named (all if
    none are), how many there are and their digest."""

    name: str
    since: int
    read: int
    predicates: tuple[str, ...] | None
    rows: int
    digest: str


MANIFEST = "name string, since long, read long, predicates array<string>, rows long, digest string"


class BrokenChain(ValueError):
    """Slices are missing or damaged."""


def digest() -> Column:
    """The sum of the rows' hashes: the same in any order and layout, another for a lost, changed
    or doubled row."""
    columns = [F.array_sort(F.map_entries(f.name)) if f.name == "facets" else F.col(f.name) for f in LOG_SCHEMA.fields]
    return F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0)).cast("string")


class Backups:
    """Slices and their manifest in `folder`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def write(self, log: DataFrame, name: str, read: int, since: int = 0, predicates: Iterable[str] | None = None) -> Slice:
        """Write the committed changes with since < commit_ts <= read (since 0: a full backup) of
        all predicates or some. Deletes of whole nodes are part of every slice. The log is read
        once; rows and digest are those of the files written."""
        if not re.fullmatch(r"\w[\w.-]*", name):
            raise ValueError(f"not a name for a slice: {name}")
        chosen = None if predicates is None else tuple(sorted(predicates))
        rows = log.select(*LOG_SCHEMA.fieldNames()).where((F.col("commit_ts") > since) & (F.col("commit_ts") <= read))
        if chosen is not None:
            rows = rows.where(F.col("predicate").isin([*chosen, STAR]))
        # by predicate, so that a partial restore reads its folders only; `of` keeps the column itself
        path = f"{self.folder}/slices/slice={name}"
        rows.withColumn("of", F.col("predicate")).hint("rebalance", "of").write.partitionBy("of").mode("overwrite").parquet(path)
        held, sums = self.spark.read.schema(rows.schema).parquet(path).agg(F.count(F.lit(1)), digest()).first()
        line = Slice(name, since, read, chosen, held, sums)
        self.spark.createDataFrame([line], MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifest/slice={name}")
        return line

    def manifest(self) -> list[Slice]:
        """All slices by range: one line each."""
        try:
            lines = self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest").collect()
        except AnalysisException:
            return []
        found = [Slice(r.name, r.since, r.read, None if r.predicates is None else tuple(r.predicates), r.rows, r.digest) for r in lines]
        return sorted(found, key=lambda s: (s.since, s.read, s.name))

    def read(self, slices: Sequence[Slice], predicates: Iterable[str] | None = None) -> DataFrame:
        """The changes of some slices in one scan, of all predicates or some."""
        schema = self.spark.createDataFrame([], LOG_SCHEMA).withColumns({"slice": F.lit(""), "of": F.lit("")}).schema
        paths = [f"{self.folder}/slices/slice={s.name}/of=*" for s in slices if s.rows]  # without rows there are no folders
        if not paths:
            return self.spark.createDataFrame([], LOG_SCHEMA)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.folder}/slices").parquet(*paths)
        if predicates is not None:
            rows = rows.where(F.col("of").isin([*predicates, STAR]))
        return rows.select(*LOG_SCHEMA.fieldNames())

    # checks ---------------------------------------------------------------------
    def gaps(self) -> list[tuple[int, int]]:
        """Ranges of commit timestamps before the last one that no slice of all predicates holds."""
        out, at = [], 0
        for s in self.manifest():
            if s.predicates is None:
                if s.since > at:
                    out.append((at, s.since))
                at = max(at, s.read)
        return out

    def overlaps(self) -> list[tuple[str, str]]:
        """Pairs of neighbouring incremental slices of the same predicates that share a range."""
        out, last = [], {}
        for s in self.manifest():
            if s.since:
                before = last.get(s.predicates)
                if before and before.read > s.since:
                    out.append((before.name, s.name))
                if not before or s.read > before.read:
                    last[s.predicates] = s
        return out

    def damaged(self, slices: Sequence[Slice] | None = None) -> list[str]:
        """Names of slices that do not hold what their manifest line says: one scan of each."""
        out = []
        for s in self.manifest() if slices is None else slices:
            try:
                got = self.read([s]).agg(F.count(F.lit(1)), digest()).first()
                fine = tuple(got) == (s.rows, s.digest)
            except Exception as e:  # files that cannot be found or read, as far as Spark says so
                if "FAILED_READ_FILE" not in str(e) and "PATH_NOT_FOUND" not in str(e) and "CANNOT_READ" not in str(e):
                    raise
                fine = False
            if not fine:
                out.append(s.name)
        return out

    # restore --------------------------------------------------------------------
    def chain(self, restore_ts: int, predicates: Iterable[str] | None = None, allow_gaps: bool = False) -> list[Slice]:
        """The slices with the fewest rows that together hold every change up to `restore_ts`
        of the predicates wanted (default all). Overlaps do no harm: a change seen twice is the
        same change. Raises `BrokenChain` if they leave a gap, unless gaps are allowed; then as little
        as possible is missing."""
        wanted = None if predicates is None else set(predicates)
        usable = [s for s in self.manifest() if s.predicates is None or (wanted is not None and wanted <= set(s.predicates))]
        ends = {0, restore_ts} | {min(s.read, restore_ts) for s in usable}
        # states are timestamps reached; a slice leads on from any timestamp in its range
        heap: list[tuple[int, int, int, tuple[Slice, ...]]] = [(0, 0, 0, ())]
        done = set()
        while heap:
            missing, cost, at, chain = heapq.heappop(heap)
            if at >= restore_ts:
                return list(chain)
            if at in done:
                continue
            done.add(at)
            for s in usable:
                if s.since <= at < s.read:
                    heapq.heappush(heap, (missing, cost + s.rows, min(s.read, restore_ts), (*chain, s)))
            if allow_gaps:
                starts = [s.since for s in usable if s.since > at] + [restore_ts]
                ahead = min(min(starts), restore_ts)
                heapq.heappush(heap, (missing + ahead - at, cost, ahead, chain))
        reached = max(done & ends, default=0)
        raise BrokenChain(f"no slices lead from commit {reached} to {restore_ts}")

    def restore(
        self, restore_ts: int, predicates: Iterable[str] | None = None, list_predicates: Iterable[str] = (), allow_gaps: bool = False, verify: bool = False,
        from_namespace: int | None = None, to_namespace: int | None = None,
    ) -> DataFrame:
        """Facts at `restore_ts`, of all predicates or some, of all tenants or one (as another
        one if `to_namespace` is given). Every slice of the chain is scanned once. With `verify`
        each is first checked against its manifest line; a damaged one raises `BrokenChain`."""
        wanted = None if predicates is None else sorted(predicates)
        chain = self.chain(restore_ts, wanted, allow_gaps)
        if verify and (bad := self.damaged(chain)):
            raise BrokenChain(f"damaged slices: {', '.join(bad)}")
        rows = self.read(chain, wanted)  # changes that two slices share win or lose as one
        if from_namespace is not None:
            rows = in_namespace(rows, from_namespace)
            if to_namespace is not None:
                rows = rows.withColumn("namespace", F.lit(to_namespace).cast("long"))
        return as_of(rows, restore_ts, list_predicates).select(*FACT_COLUMNS)

