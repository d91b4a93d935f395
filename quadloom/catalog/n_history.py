"""Versions, feeds, conflicts, backup, restore and export over the change log."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom.catalog.c_mutations import LISTS, log_with_stars, state_rows
from quadloom.catalog.common import LOG, hexa, query, state_sql, u
from quadloom.catalog.f_counting import FACTS, TENANTS, facts, shared, tenant
from quadloom.model import TYPE_PREDICATE, edge_fact, value_fact
from quadloom.operators import backups, history, mutate
from quadloom.plans.cut import fresh_path, written
from quadloom.sources.tables import Graph



def at(g: Graph, tenths: int):
    """A timestamp that many tenths into the log."""
    last = F.max("event_id")
    return g.raw("events").agg(F.call_function("div", last * tenths, F.lit(10).cast("long"))).scalar()


def at_sql(tenths: int) -> str:
    return f"(SELECT max(event_id) * {tenths} // 10 FROM events)"


READ_SQL = at_sql(7)


@query(
    "n01_committed",
    f"""WITH {LOG} SELECT namespace, subject, predicate, value, op, start_ts, commit_ts FROM log WHERE NOT aborted""",
)
def committed(g: Graph):
    rows = history.committed(g.log(), g.txn_status())
    return rows.select("namespace", "subject", "predicate", "value", "op", "start_ts", "commit_ts")


@query(
    "n02_as_of",
    f"""WITH {LOG}, past AS (SELECT * FROM log WHERE NOT aborted AND commit_ts <= {READ_SQL}), {state_sql('past')}
    SELECT namespace, subject, predicate, value, k FROM state""",
)
def as_of(g: Graph):
    done = history.committed(log_with_stars(g), g.txn_status(), until=at(g, 7))
    return state_rows(history.as_of(done, at(g, 7), LISTS))


@query(
    "n03_feed",
    f"""WITH {LOG} SELECT commit_ts, namespace, subject, predicate, value, op FROM log WHERE commit_ts > {READ_SQL} AND NOT aborted""",
)
def feed(g: Graph):
    rows = history.feed(history.committed(g.log(), g.txn_status()), at(g, 7))
    return rows.select("commit_ts", "namespace", "subject", "predicate", "value", "op")


@query(
    "n04_conflicts",
    f"""WITH {LOG}, t AS (SELECT namespace, subject, predicate, start_ts, start_ts + k // 2 * 40 AS commit_ts FROM log WHERE predicate <> 'view')
    SELECT a.namespace, a.subject, a.predicate, a.start_ts AS first_ts, b.start_ts AS second_ts FROM t a JOIN t b
      ON a.namespace = b.namespace AND a.subject = b.subject AND a.predicate = b.predicate
      AND a.start_ts < b.start_ts AND b.start_ts < a.commit_ts AND a.start_ts < b.commit_ts""",
)
def conflicts(g: Graph):
    """Transactions of 0 to 1,960 ticks; those without length lie inside others."""
    k = F.try_element_at("facets", F.lit("k")).cast("long")
    rows = g.log().withColumn("commit_ts", F.col("start_ts") + F.call_function("div", k, F.lit(2).cast("long")) * 40)
    return history.conflicts(rows, no_conflict=["view"])


@query(
    "a06_export",
    f"""WITH {LOG}, past AS (SELECT * FROM log WHERE NOT aborted AND commit_ts <= {READ_SQL}), {state_sql('past')}
    SELECT 'rdf' AS form, predicate, '<0x' || lower(to_hex(subject)) || '> <' || predicate || '> ' || value || ' (k=' || k || ') .' AS line FROM state WHERE namespace = 3
    UNION ALL SELECT 'json', predicate, '{{"uid":"0x' || lower(to_hex(subject)) || '","' || predicate || '":' || value || ',"' || predicate || '|k":' || k || '}}' FROM state WHERE namespace = 3""",
)
def export(g: Graph):
    done = history.committed(log_with_stars(g), g.txn_status(), until=at(g, 7))
    out = None
    for form in ("rdf", "json"):
        rows = history.export_rows(done, at(g, 7), 3, form, LISTS).select(F.lit(form).alias("form"), "predicate", "line")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "a06_export_files",
    f"""WITH c AS (SELECT *, '<' || {hexa(u('Customer', 'c_custkey'))} || '>' AS s FROM customer)
    SELECT 'c_name' AS predicate, s || ' <c_name> "' || c_name || '" .' AS line FROM c
    UNION ALL SELECT 'c_acctbal', s || ' <c_acctbal> ' || c_acctbal || ' .' FROM c
    UNION ALL SELECT 'c_mktsegment', s || ' <c_mktsegment> "' || c_mktsegment || '" .' FROM c
    UNION ALL SELECT 'in_nation', s || ' <in_nation> <' || {hexa(u('Nation', 'c_nationkey'))} || '> .' FROM c
    UNION ALL SELECT DISTINCT 'contains', '<' || {hexa(u('Order', 'l_orderkey'))} || '> <contains> <' || {hexa(u('Part', 'l_partkey'))} || '> .' FROM lineitem
    UNION ALL SELECT 'source', '<' || {hexa(u('Document', 'doc_id'))} || '> <source> "' || source || '"@' || lang || ' .' FROM documents""",
)
def export_files(g: Graph):
    """Values, single edges, list edges and language values written as files and read back."""
    edges = g.contains_pairs()
    rows = g.customer_facts().unionByName(edge_fact(edges, F.col("src"), "contains", F.col("dst")))
    rows = rows.unionByName(value_fact(g.documents(), F.col("uid"), "source", F.col("source"), "string", lang=F.col("lang")))
    path = fresh_path(g.spark, "export")
    history.export(g.spark, mutate.as_log(rows, 1), path, 1, list_predicates=["contains"])
    return g.spark.read.text(path).select("predicate", F.col("value").alias("line"))


@query(
    "a07_bulk_summary",
    f"""WITH {FACTS}, labels AS (SELECT cast(o_orderkey % {TENANTS} AS BIGINT) AS namespace, 'node.type' AS predicate, o_orderkey // {TENANTS} AS subject,
      CASE WHEN o_orderstatus = 'F' THEN 'Finished' ELSE 'Order' END AS value FROM orders),
    every AS (SELECT namespace, predicate, subject, value, object_uid FROM facts UNION ALL SELECT namespace, predicate, subject, value, NULL FROM labels),
    per AS (SELECT namespace, predicate, count(*) AS n, count(object_uid) AS edges, bool_and(object_uid IS NOT NULL) AS is_uid,
      bool_and(try_cast(value AS DOUBLE) IS NOT NULL) AS is_float FROM every GROUP BY namespace, predicate, subject)
    SELECT namespace, 'predicate' AS kind, predicate AS name, cast(sum(n) AS BIGINT) AS rows, cast(sum(edges) AS BIGINT) AS edges, CASE WHEN bool_and(is_uid) THEN 'uid' WHEN bool_and(is_float) THEN 'float' ELSE 'string' END AS observed,
      CASE WHEN max(n) > 1 THEN 'LIST' ELSE 'SINGLE' END AS hint FROM per GROUP BY namespace, predicate
    UNION ALL SELECT namespace, 'type', value, count(DISTINCT subject), 0, NULL, NULL FROM labels GROUP BY namespace, value""",
)
def bulk_summary(g: Graph):
    label = F.when(F.col("o_orderstatus") == "F", "Finished").otherwise("Order")
    labels = value_fact(g.raw("orders"), shared("Order", "o_orderkey"), TYPE_PREDICATE, label, "string", namespace=tenant("o_orderkey"))
    return history.bulk_summary(facts(g).unionByName(labels))


@query(
    "a08_backup",
    f"""WITH {LOG}, p AS (SELECT predicate FROM log WHERE k = 99 GROUP BY 1)
    SELECT start_ts, commit_ts, predicate, value, op FROM log WHERE commit_ts > {at_sql(3)} AND commit_ts <= {READ_SQL} AND NOT aborted AND predicate IN (FROM p)
    UNION ALL SELECT start_ts, commit_ts, predicate, value, op FROM log WHERE commit_ts <= {at_sql(3)} AND NOT aborted""",
)
def backup(g: Graph):
    """An incremental slice of chosen predicates and a forced full one."""
    done = history.committed(g.log(), g.txn_status())
    chosen = g.events().where("k = 99").agg(F.collect_set("event_type")).scalar()  # event types are few
    slice_ = history.backup(done, at(g, 3), at(g, 7), chosen)
    full = history.backup(done, at(g, 3), at(g, 3), force_full=True)
    return slice_.unionByName(full).select("start_ts", "commit_ts", "predicate", "value", "op")


@query(
    "a09_restore",
    f"""WITH {LOG}, past AS (SELECT * FROM log WHERE NOT aborted AND commit_ts <= {READ_SQL}), {state_sql('past')}
    SELECT namespace, subject, predicate, value, k FROM state""",
)
def restore(g: Graph):
    done = history.committed(log_with_stars(g), g.txn_status())
    full = history.backup(done, 0, at(g, 3), force_full=True)
    slices = [full, history.backup(done, at(g, 3), at(g, 6)), history.backup(done, at(g, 6), at(g, 9))]
    slices = [written(part, "backup") for part in slices]
    return state_rows(history.restore(slices, at(g, 7), list_predicates=LISTS))


@query(
    "a09_restore_incremental",
    f"""WITH {LOG}, past AS (SELECT * FROM log WHERE NOT aborted AND commit_ts <= {READ_SQL}), {state_sql('past')}
    SELECT 3::BIGINT AS asked, namespace, subject, predicate, value, k FROM state
    UNION ALL SELECT 4, 7, subject, predicate, value, k FROM state WHERE namespace = 2""",
)
def restore_incremental(g: Graph):
    """Increments on top of a state restored before, and one tenant restored as another."""
    done = history.committed(log_with_stars(g), g.txn_status())
    full = history.backup(done, 0, at(g, 3), force_full=True)
    increments = [history.backup(done, at(g, 2), at(g, 6)), history.backup(done, at(g, 6), at(g, 9))]
    slices = [written(part, "backup") for part in (full, *increments)]
    before = written(mutate.as_log(history.restore(slices[:1], at(g, 3), list_predicates=LISTS), 1), "restored")
    on_top = history.restore([before, *slices[1:]], at(g, 7), at(g, 3), LISTS)
    moved = history.restore(slices, at(g, 7), list_predicates=LISTS, from_namespace=2, to_namespace=7)
    rows = [state_rows(s).select(F.lit(i).cast("long").alias("asked"), "*") for i, s in ((3, on_top), (4, moved))]
    return rows[0].unionByName(rows[1])


def stored_backups(g: Graph) -> tuple[backups.Backups, list[int]]:
    """A full backup, increments of which two overlap, and one of a single predicate."""
    tenths = [int(g.spark.range(1).select(at(g, i)).first()[0]) for i in (3, 5, 6, 7, 9)]
    done = written(history.committed(log_with_stars(g), g.txn_status()), "committed")
    kept = backups.Backups(g.spark, fresh_path(g.spark, "backups"))
    for name, since, read, predicates in (("full", 0, 0, None), ("a", 0, 1, None), ("b", 1, 2, None), ("c", 2, 4, None), ("wide", 0, 4, None), ("clicks", 0, 4, ["click"])):
        kept.write(done, name, tenths[read], 0 if name == "full" else tenths[since], predicates)
    return kept, tenths


@query(
    "a08_backup_chain",
    f"""WITH {LOG}, s(name, since, read, predicate) AS (VALUES ('full', 0, {at_sql(3)}, NULL), ('a', {at_sql(3)}, {at_sql(5)}, NULL), ('b', {at_sql(5)}, {at_sql(6)}, NULL),
      ('c', {at_sql(6)}, {at_sql(9)}, NULL), ('wide', {at_sql(3)}, {at_sql(9)}, NULL), ('clicks', {at_sql(3)}, {at_sql(9)}, 'click'))
    SELECT name, since::BIGINT AS since, read::BIGINT AS read, (SELECT count(*) FROM log WHERE NOT aborted AND commit_ts > since AND commit_ts <= read
      AND (s.predicate IS NULL OR log.predicate = s.predicate OR k = 50)) AS rows, name IN ('full', 'a', 'b', 'c') AS needed, false AS damaged FROM s""",
)
def backup_chain(g: Graph):
    """The manifest, which slices a restore needs, and whether any of them is damaged."""
    kept, tenths = stored_backups(g)
    needed, damaged = {s.name for s in kept.chain(tenths[2])} | {"c"}, set(kept.damaged())
    lines = [(s.name, s.since, s.read, s.rows, s.name in needed, s.name in damaged) for s in kept.manifest()]
    return g.spark.createDataFrame(lines, "name string, since long, read long, rows long, needed boolean, damaged boolean")


@query(
    "a09_restore_chain",
    f"""WITH {LOG}, past AS (SELECT * FROM log WHERE NOT aborted AND commit_ts <= {READ_SQL}), {state_sql('past')}
    SELECT 'all' AS part, namespace, subject, predicate, value, k FROM state
    UNION ALL SELECT 'clicks', namespace, subject, predicate, value, k FROM state WHERE predicate = 'click'""",
)
def restore_chain(g: Graph):
    """Everything, and one predicate alone, from the fewest rows of verified slices."""
    kept, tenths = stored_backups(g)
    whole = state_rows(kept.restore(tenths[3], list_predicates=LISTS, verify=True)).select(F.lit("all").alias("part"), "*")
    return whole.unionByName(state_rows(kept.restore(tenths[3], ["click"], LISTS)).select(F.lit("clicks").alias("part"), "*"))
