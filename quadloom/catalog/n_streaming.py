"""Streaming subscription and streaming apply, run until the available files are used up."""

from __future__ import annotations

from quadloom.catalog.c_mutations import LISTS, log_with_stars, state_rows
from quadloom.catalog.common import LOG, query, state_sql
from quadloom.model import LOG_SCHEMA
from quadloom.plans.cut import fresh_path
from quadloom.sources.tables import Graph
from quadloom.streaming import feeds, levels

BATCHES = 3


def log_files(g: Graph, log, batches: int = BATCHES) -> str:
    """The change log as files in commit order, as a writer would have left them."""
    path = fresh_path(g.spark, "log")
    log.select(*LOG_SCHEMA.fieldNames()).repartitionByRange(batches, "commit_ts").write.parquet(path)
    return path


@query(
    "n05_subscribe",
    f"""WITH {LOG} SELECT commit_ts, namespace, subject, predicate, value, op FROM log WHERE predicate LIKE 'p%' OR predicate LIKE 'cl%'""",
)
def subscribe(g: Graph):
    source = log_files(g, g.log())
    sink, progress = fresh_path(g.spark, "sink"), fresh_path(g.spark, "progress")
    stream = feeds.log_stream(g.spark, source, files_per_batch=1)
    run = feeds.subscribe(stream, ["p", "cl"], sink, progress, available_now=True)
    run.awaitTermination()
    got = g.spark.read.schema(LOG_SCHEMA).parquet(sink)
    return got.select("commit_ts", "namespace", "subject", "predicate", "value", "op")


@query("n06_streaming_apply", f"WITH {LOG}, {state_sql('log')} SELECT namespace, subject, predicate, value, k FROM state")
def streaming_apply(g: Graph):
    source = log_files(g, log_with_stars(g))
    kept = feeds.StreamingState(g.spark, fresh_path(g.spark, "state"), LISTS, merge_every=2)
    stream = feeds.log_stream(g.spark, source, files_per_batch=1)
    run = kept.start(stream, fresh_path(g.spark, "progress"), available_now=True)
    run.awaitTermination()
    return state_rows(kept.state(run.lastProgress["batchId"]))


@query("n06_leveled_apply", f"WITH {LOG}, {state_sql('log')} SELECT namespace, subject, predicate, value, k FROM state")
def leveled_apply(g: Graph):
    """Six batches into buckets and levels; a bucket carries at every second write."""
    source = log_files(g, log_with_stars(g), 6)
    kept = levels.LeveledState(g.spark, fresh_path(g.spark, "levels"), LISTS, buckets=8, fan_out=2)
    run = kept.start(feeds.log_stream(g.spark, source, files_per_batch=1), fresh_path(g.spark, "progress"), available_now=True)
    run.awaitTermination()
    return state_rows(kept.state(run.lastProgress["batchId"]))


TERM_SPLIT = r"[^\p{L}\p{N}]+"


@query(
    "k10_kept_indexes",
    f"""WITH {LOG}, {state_sql('log')} SELECT 'exact' AS kind, namespace, predicate, value AS entry, subject AS uid FROM state GROUP BY ALL
    UNION ALL SELECT DISTINCT 'term', namespace, predicate, unnest(list_filter(regexp_split_to_array(value, '{TERM_SPLIT}'), lambda x: x <> '')), subject FROM state
    UNION ALL SELECT 'count', namespace, predicate, count(*)::VARCHAR, subject FROM state GROUP BY namespace, predicate, subject""",
)
def kept_indexes(g: Graph):
    """Exact, term and count index after three batches, kept up from what each batch changed."""
    source = log_files(g, log_with_stars(g))
    kept = levels.KeptIndexes(g.spark, fresh_path(g.spark, "kept"), ("exact", "term", "count"), LISTS, buckets=4, fan_out=2)
    run = kept.start(feeds.log_stream(g.spark, source, files_per_batch=1), fresh_path(g.spark, "progress"), available_now=True)
    run.awaitTermination()
    return kept.entries(run.lastProgress["batchId"])
