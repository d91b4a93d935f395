"""Versions: committed view, reads at a timestamp, feeds, conflicts, backup, export."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quadloom.functions import uid as uids
from quadloom.functions.values import typed_literal

from quadloom.model import TYPE_PREDICATE
from quadloom.operators.mutate import in_namespace, resolve
from quadloom.sources import nquads


def committed(log: DataFrame, status: DataFrame, until: int | Column | None = None) -> DataFrame:
    """Changes of committed transactions, with the commit timestamp of their status row.

    `until` keeps commits up to a timestamp. A transaction starts before it commits, so the
    bound holds for the start as well and both sides are cut before the join."""
    done = status.where(F.col("commit_ts").isNotNull()).select("start_ts", "commit_ts")
    rows = log.drop("commit_ts")
    if until is not None:
        done, rows = done.where(F.col("commit_ts") <= until), rows.where(F.col("start_ts") <= until)
    return rows.join(done, "start_ts").select(*log.columns)


def as_of(log: DataFrame, read_ts: int | Column, list_predicates: Iterable[str] = ()) -> DataFrame:
    """State at a read timestamp (inclusive); the filter reaches the log scan."""
    return resolve(log.where(F.col("commit_ts") <= read_ts), list_predicates)


def feed(log: DataFrame, sent_ts: int | Column) -> DataFrame:
    """Changes after the last timestamp already sent, in commit order."""
    return log.where(F.col("commit_ts") > sent_ts).orderBy("commit_ts", "seq")


def conflicts(
    log: DataFrame, key: list[str] | None = None, no_conflict: Iterable[str] = (), name: str = "predicate"
) -> DataFrame:
    """Pairs of transactions open at the same time that touch the same key, each once.

    An equi-join, not a comparison of all pairs of a key: every transaction is filed under
    the one or two time slots it covers at its own scale (power of two >= its length), and
    looked up by the start of the later one. A hot key is spread over its time slots."""
    key = key or ["namespace", "subject", "predicate"]
    skipped = list(no_conflict)
    rows = log.where(~F.col(name).isin(skipped)) if skipped else log
    rows = rows.select(*key, "start_ts", "commit_ts").distinct()
    length = F.col("commit_ts") - F.col("start_ts")
    scale = F.ceil(F.log2(length.cast("double"))).cast("int")
    # A transaction of no length is open at no time, but may start inside another one.
    filed = rows.where("commit_ts > start_ts").withColumn("_scale", scale)
    filed = filed.withColumn("_width", F.pow(F.lit(2.0), F.col("_scale")).cast("long"))
    scales = filed.agg(F.collect_set("_scale")).scalar()  # at most 63 of them
    slot = F.call_function("div", F.col("start_ts"), F.col("_width"))
    last = F.call_function("div", F.col("commit_ts") - 1, F.col("_width"))
    earlier = filed.select(
        *key, F.col("start_ts").alias("first_ts"), F.col("commit_ts").alias("_until"), "_scale",
        F.explode(F.sequence(slot, last)).alias("_slot"),
    )
    later = (
        rows.withColumn("_scale", F.explode(scales))
        .withColumn("_width", F.pow(F.lit(2.0), F.col("_scale")).cast("long"))
        .select(*key, F.col("start_ts").alias("second_ts"), "_scale", slot.alias("_slot"))
    )
    overlap = (F.col("first_ts") < F.col("second_ts")) & (F.col("second_ts") < F.col("_until"))
    return earlier.join(later, [*key, "_scale", "_slot"]).where(overlap).select(*key, "first_ts", "second_ts")


# backup and restore ----------------------------------------------------------
def backup(
    log: DataFrame, since_ts: int | Column, read_ts: int | Column, predicates: Iterable[str] | Column | None = None, force_full: bool = False
) -> DataFrame:
    """Changes with since_ts < commit_ts <= read_ts, or all up to read_ts when forced, of all
    predicates or those named (names, or an array column such as a scalar subquery)."""
    rows = log.where(F.col("commit_ts") <= read_ts)
    if not force_full:
        rows = rows.where(F.col("commit_ts") > since_ts)
    if predicates is not None:
        chosen = predicates if isinstance(predicates, Column) else F.array(*[F.lit(p) for p in predicates])
        rows = rows.where(F.array_contains(chosen, F.col("predicate")))
    return rows


def restore(
    slices: list[DataFrame], restore_ts: int | Column, incremental_from: int | Column | None = None, list_predicates: Iterable[str] = (),
    from_namespace: int | None = None, to_namespace: int | None = None,
) -> DataFrame:
    """State rebuilt from a full slice and its incrementals up to `restore_ts`. With
    `incremental_from` the first slice is a state already restored up to there, and only later
    changes of the others are put on top. `from_namespace` restores one tenant only, as tenant
    `to_namespace` if that is given."""
    rows = slices[0]
    for s in slices[1:]:
        if incremental_from is not None:
            s = s.where(F.col("commit_ts") > incremental_from)
        rows = rows.unionByName(s)
    if from_namespace is not None:
        rows = in_namespace(rows, from_namespace)
        if to_namespace is not None:
            rows = rows.withColumn("namespace", F.lit(to_namespace).cast("long"))
    return as_of(rows, restore_ts, list_predicates)


# export ----------------------------------------------------------------------
def export_rows(
    log: DataFrame, read_ts: int | Column, namespace: int | None = None, form: str = "rdf", list_predicates: Iterable[str] = ()
) -> DataFrame:
    """(predicate, line) of the state at `read_ts`, as N-Quad lines or JSON objects."""
    facts = as_of(log, read_ts, list_predicates)
    if namespace is not None:
        facts = in_namespace(facts, namespace)
    if form == "rdf":
        rows = nquads.from_facts(facts)
        text = F.concat(
            uids.in_nquad(F.col("subject")), F.lit(" <"), F.col("predicate"), F.lit("> "),
            F.coalesce(uids.in_nquad(F.col("object")), F.concat(
                typed_literal(F.col("value"), F.col("value_type")), F.coalesce(F.concat(F.lit("@"), F.col("lang")), F.lit("")))),
            nquads.facet_text(F.col("facets")), F.lit(" ."),
        )
        return rows.select("predicate", text.alias("line"))
    if form == "json":
        body = F.concat(
            F.lit('{"uid":"'), uids.to_text(F.col("subject")), F.lit('","'), F.col("predicate"),
            F.coalesce(F.concat(F.lit("@"), F.col("lang")), F.lit("")), F.lit('":'),
            F.coalesce(
                F.concat(F.lit('{"uid":"'), uids.to_text(F.col("object_uid")), F.lit('"}')),
                typed_literal(F.col("value"), F.col("value_type")),
            ),
            F.coalesce(
                F.concat_ws("", F.transform(
                    F.array_sort(F.map_entries("facets")),
                    lambda e: F.concat(F.lit(',"'), F.col("predicate"), F.lit("|"), e["key"], F.lit('":'), e["value"]),
                )),
                F.lit(""),
            ),
            F.lit("}"),
        )
        return facts.select("predicate", body.alias("line"))
    raise ValueError(f"unknown export form {form}")


def export(spark: SparkSession, log: DataFrame, path: str, read_ts: int | Column, namespace: int | None = None, form: str = "rdf", list_predicates: Iterable[str] = ()) -> None:
    """Write the export, one folder per predicate. Rows are gathered by predicate first, so the
    number of files follows the size, and Spark splits a hot predicate over several tasks."""
    rows = export_rows(log, read_ts, namespace, form, list_predicates)
    rows.hint("rebalance", "predicate").write.partitionBy("predicate").text(path)


def bulk_summary(facts: DataFrame, type_predicate: str = TYPE_PREDICATE) -> DataFrame:
    """What a load holds, one row per (namespace, kind, name): for `predicate` the rows, edges,
    observed type and hint, for `type` the nodes that carry the label."""
    from quadloom.operators.counting import observed_types

    predicates = observed_types(facts).withColumnRenamed("predicate", "name").withColumn("kind", F.lit("predicate"))
    labels = facts.where(F.col("predicate") == type_predicate)
    types = labels.groupBy("namespace", F.col("value").alias("name")).agg(F.count_distinct("subject").alias("rows"))
    types = types.select(
        "namespace", F.lit("type").alias("kind"), "name", "rows", F.lit(0).cast("long").alias("edges"),
        F.lit(None).cast("string").alias("observed"), F.lit(None).cast("string").alias("hint"),
    )
    return predicates.select(*types.columns).unionByName(types)
