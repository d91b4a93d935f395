"""Applying set / overwrite / delete rows to facts, in batches of any size."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quadloom.functions import uid as uids
from quadloom.model import FACT_COLUMNS, OP_DEL, OP_OVR, OP_SET, STAR, namespace_of, tenant_key, with_tenant
from quadloom.plans.cut import written
from quadloom.plans.semi import lacking

NODE_KEY = ["namespace", "subject"]
PREDICATE_KEY = ["namespace", "subject", "predicate"]


def change_time() -> Column:
    return F.struct("commit_ts", "seq")


def change_order() -> Column:
    """Total order of changes: commit, position inside the transaction, then deletes
    before sets, then a digest of the value, so that ties fall the same way on every run."""
    return F.struct(
        "commit_ts", "seq", (F.col("op") != OP_DEL).alias("_set"), F.xxhash64("value", "object_uid").alias("_digest")
    )


def resolve(log: DataFrame, list_predicates: Iterable[str] = ()) -> DataFrame:
    """The state a committed log leaves behind, as facts.

    A scalar predicate keeps its last value per language; a list predicate keeps a set,
    one decision per element. Star deletes end every earlier value of a predicate or node,
    and an overwrite of a list does so before its own value. Facets come from the winner.

    Winners are one aggregation with map-side combine, so a hot node is folded before it
    is shuffled; the ends of life are a second, small aggregation joined back."""
    lists = list(list_predicates)
    is_list = F.col("predicate").isin(lists) if lists else F.lit(False)
    star = (F.col("op") == OP_DEL) & ((F.col("predicate") == STAR) | (F.coalesce("value", F.lit("")) == STAR))
    ends = star | ((F.col("op") == OP_OVR) & is_list)
    element = F.when(is_list, F.coalesce(F.col("object_uid").cast("string"), F.col("value")))

    payload = F.struct("object_uid", "value", "value_type", "facets", "op", change_time().alias("_at"))
    winners = (
        log.where(~star)
        .groupBy(*PREDICATE_KEY, "lang", element.alias("_element"))
        .agg(F.max_by(payload, change_order()).alias("w"))
        .select(*PREDICATE_KEY, "lang", "w.*")
    )
    ended = log.where(ends).groupBy(*PREDICATE_KEY).agg(F.max(change_time()).alias("_end"))
    ended_values = ended.where(F.col("predicate") != STAR)
    ended_nodes = ended.where(F.col("predicate") == STAR).select(*NODE_KEY, F.col("_end").alias("_node_end"))
    alive = (F.col("op") != OP_DEL) & (F.col("_end").isNull() | (F.col("_at") >= F.col("_end"))) & (
        F.col("_node_end").isNull() | (F.col("_at") >= F.col("_node_end"))
    )
    return (
        winners.join(ended_values, PREDICATE_KEY, "left")
        .join(ended_nodes, NODE_KEY, "left")
        .where(alive)
        .select(*FACT_COLUMNS)
    )


def as_log(facts: DataFrame, commit_ts: int, op: str = OP_SET, seq: int = 0) -> DataFrame:
    """Facts as changes of one transaction, e.g. a snapshot below a batch."""
    return facts.select(
        *FACT_COLUMNS,
        F.lit(op).alias("op"),
        F.lit(seq).cast("long").alias("seq"),
        F.lit(commit_ts).cast("long").alias("start_ts"),
        F.lit(commit_ts).cast("long").alias("commit_ts"),
    )


def apply(snapshot: DataFrame, changes: DataFrame, list_predicates: Iterable[str] = ()) -> DataFrame:
    """A snapshot with a batch of changes on top (changes commit after timestamp 0)."""
    return resolve(as_log(snapshot, 0).unionByName(changes.select(*as_log(snapshot, 0).columns)), list_predicates)


# deletes ---------------------------------------------------------------------
def delete_edges(edges: DataFrame, gone: DataFrame) -> DataFrame:
    """Remove single (src, dst) edges."""
    return lacking(edges, gone, ["src", "dst"])


def star_rows(nodes: DataFrame, predicates: Sequence[str], key: str = "uid") -> DataFrame:
    """`s <p> * .` for every node (of its tenant) and predicate."""
    names = F.explode(F.array(*[F.lit(p) for p in predicates]))
    return nodes.select(namespace_of(nodes).alias("namespace"), F.col(key).alias("subject"), names.alias("predicate"))


def delete_predicates(facts: DataFrame, stars: DataFrame) -> DataFrame:
    """Remove all values of (namespace, subject, predicate)."""
    return lacking(facts, stars, PREDICATE_KEY)


def delete_nodes(facts: DataFrame, nodes: DataFrame, key: str = "uid") -> DataFrame:
    """Remove every predicate of the given nodes of their tenants; edges pointing at them stay."""
    return lacking(facts, nodes.select(namespace_of(nodes).alias("namespace"), F.col(key).alias("subject")), NODE_KEY)


def drop_predicate(facts: DataFrame, predicate: str) -> DataFrame:
    """Remove a predicate everywhere: on disk this skips one partition directory."""
    return facts.where(F.col("predicate") != predicate)


DROP_ALL, DROP_DATA, DROP_ATTR, DROP_TYPE, DROP_NAMESPACE = "ALL", "DATA", "ATTR", "TYPE", "NAMESPACE"


def drop(
    facts: DataFrame, predicates: DataFrame, types: DataFrame, kind: str, value: str | int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(facts, predicates, types) after a drop. DATA keeps the schema, ATTR removes one
    predicate from data and schema, TYPE removes a type definition only."""
    none = F.lit(False)
    if kind == DROP_ALL:
        return facts.where(none), predicates.where(none), types.where(none)
    if kind == DROP_DATA:
        return facts.where(none), predicates, types
    if kind == DROP_ATTR:
        keep = F.col("predicate") != value
        return facts.where(keep), predicates.where(keep), types.where(keep)
    if kind == DROP_TYPE:
        return facts, predicates, types.where(F.col("type_name") != value)
    if kind == DROP_NAMESPACE:
        keep = F.col("namespace") != value
        return tuple(df.where(keep) if "namespace" in df.columns else df for df in (facts, predicates, types))
    raise ValueError(f"unknown drop {kind}")


def in_namespace(facts: DataFrame, namespace: int) -> DataFrame:
    return facts.where(F.col("namespace") == namespace)


def delete_namespace(facts: DataFrame, namespace: int) -> DataFrame:
    return facts.where(F.col("namespace") != namespace)


# set / delete pair -----------------------------------------------------------
def is_default(value: Column, value_type: str) -> Column:
    """Whether a value is its declared type's default, whatever column type holds it: any
    spelling of zero is the default of a number."""
    if value_type in ("int", "float"):
        return F.coalesce(value.try_cast("double") == 0, F.lit(False))
    if value_type == "bool":
        return F.coalesce(~value.try_cast("boolean"), F.lit(False))
    return value.cast("string").eqNullSafe(F.lit("")) if value_type == "string" else F.lit(False)


def set_and_delete(
    df: DataFrame,
    keys: Sequence[str],
    values: dict[str, tuple[str, str]],
    drop_defaults: bool = False,
) -> DataFrame:
    """Split wide rows into what to set and what to delete, in one pass.

    Non-null values are set. Null values are deleted, and so are values equal to their
    type's default when `drop_defaults` is on. Columns: keys, predicate, value, value_type,
    op (SET or DEL); a deleted row keeps no value."""
    cells = []
    for predicate, (column, value_type) in values.items():
        text = F.col(column).cast("string")
        gone = text.isNull()
        if drop_defaults:
            gone = gone | is_default(F.col(column), value_type)
        cells.append(
            F.struct(
                F.lit(predicate).alias("predicate"),
                F.when(~gone, text).alias("value"),
                F.lit(value_type).alias("value_type"),
                F.when(gone, OP_DEL).otherwise(OP_SET).alias("op"),
            )
        )
    return df.select(*keys, F.inline(F.array(*cells)))


def split_dropped(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Elements of a faceted list, one row each: those flagged `drop` are deleted, the
    others set."""
    element = F.col("e")
    return (
        df.select(*keys, F.explode(column).alias("e"))
        .where(element["value"].isNotNull())
        .select(*keys, element["value"].alias("value"), F.when(element["drop"], OP_DEL).otherwise(OP_SET).alias("op"))
    )


def complete_labels(labels: Column, type_name: str) -> Column:
    """The mapped type is always among the labels, each label once."""
    return F.array_distinct(F.array_union(F.coalesce(labels, F.array().cast("array<string>")), F.array(F.lit(type_name))))


# upserts and conditions ------------------------------------------------------
def upsert(batch: DataFrame, state: DataFrame, key: str, uid: str = "uid") -> DataFrame:
    """Give every batch key a uid text: that of the node holding the key in the same tenant, or a
    new blank label. `state` has (key, uid BIGINT), both may have namespace. Adds `uid` and `is_new`.
    Blank labels name a key, so batches of several tenants are assigned tenant by tenant."""
    tenant = tenant_key(batch, state)
    batch = with_tenant(batch, tenant)
    known = with_tenant(state, tenant).select(*[F.col(t).alias("_tenant") for t in tenant], F.col(key).alias("_key"), uids.to_text(F.col(uid)).alias("_uid"))
    same = batch[key] == F.col("_key")
    rows = batch.join(known, same & (batch["namespace"] == F.col("_tenant")) if tenant else same, "left").drop("_tenant")
    return rows.withColumn("is_new", F.col("_uid").isNull()).withColumn(
        "uid", F.coalesce("_uid", uids.blank_label(F.col(key)))
    ).drop("_key", "_uid")


_VARIABLE = r"^uid\((\w+)\)$"


def bind(triples: DataFrame, variables: dict[str, DataFrame], create: bool = False) -> DataFrame:
    """Replace `uid(v)` by every uid of variable v.

    Triples are written once, so that their parsing is planned and run once. Those that name a
    variable are joined with (variable, node) rows on the variable's name, once per position; Spark splits a variable with very many nodes. Triples without variables
    pass through. A statement over an empty or unknown variable falls away or, with `create`,
    names one new node per variable. A statement with variables in both positions means every
    pair of their nodes: its result has as many rows as the two sizes multiplied, so keep one of
    them small (bound it by a limit or a link condition)."""
    names = triples.columns
    nodes = None
    for name, known in variables.items():
        rows = known.select(F.lit(name).alias("_name"), uids.to_text(F.col("uid")).alias("_node"))
        if create:
            new = known.sparkSession.range(1).select(F.lit(name).alias("_name"), F.lit(f"_:{name.lower()}").alias("_node"))
            rows = rows.unionByName(new.where(known.agg(F.count("uid") == 0).scalar()))
        nodes = rows if nodes is None else nodes.unionByName(rows)
    out = written(triples, "statements")
    for position in ("subject", "object"):
        name = F.regexp_extract(position, _VARIABLE, 1)
        marked = out.withColumn("_name", F.when(F.col(position).rlike(_VARIABLE), name))
        plain = marked.where(F.col("_name").isNull())
        named = marked.where(F.col("_name").isNotNull())
        made = plain
        if nodes is not None:
            made = made.unionByName(named.join(nodes, "_name").withColumn(position, F.col("_node")).select(*marked.columns))
        if create:
            unknown = named.where(~F.col("_name").isin(list(variables)))
            made = made.unionByName(unknown.withColumn(position, F.concat(F.lit("_:"), F.lower("_name"))))
        out = made.select(*names)
    return out


def condition(tests: Sequence[tuple[DataFrame, str, int]], key: str = "uid") -> list[Column]:
    """`len(v) <op> n` for each variable, as scalar subqueries."""
    from quadloom.operators.roots import compare

    return [compare(v.agg(F.count_distinct(key)).scalar(), how, n) for v, how, n in tests]


def apply_if(changes: DataFrame, tests: Sequence[tuple[DataFrame, str, int]], key: str = "uid") -> DataFrame:
    """All change rows if every condition holds, else none; a false condition is no error."""
    return changes.where(reduce(lambda a, b: a & b, condition(tests, key)))


def batch(requests: Sequence[tuple[DataFrame, bool]]) -> DataFrame:
    """Requests of one transaction: rows tagged with their request, committed together if
    any request asks to commit now."""
    rows = [df.withColumn("req_id", F.lit(i)) for i, (df, _) in enumerate(requests)]
    commit = any(now for _, now in requests)
    return reduce(lambda a, b: a.unionByName(b), rows).withColumn("committed", F.lit(commit))


def commit_together(rows: DataFrame, txn: str = "txn", flag: str = "commit_now") -> DataFrame:
    """The same for many transactions held as data: a transaction commits all its rows if
    any of its requests carries the flag."""
    decided = rows.groupBy(txn).agg(F.bool_or(flag).alias("committed"))
    return rows.join(decided, txn)


# save ------------------------------------------------------------------------
def save(
    entities: DataFrame,
    key: str,
    values: dict[str, tuple[str, str]],
    type_name: str,
    type_predicate: str,
    uid: str = "uid",
    drop_nulls: bool = False,
) -> DataFrame:
    """Entities to the triples of one mutation, with `op`. Rows without a uid get a blank
    label from `key`; null values delete the predicate (star) when `drop_nulls` is on."""
    from quadloom.operators.identity import complete_blank

    rows = complete_blank(entities, key, uid)
    cells = set_and_delete(
        rows.select(F.col(uid).alias("subject"), *{c for c, _ in values.values()}), ["subject"], values
    )
    if not drop_nulls:
        cells = cells.where(F.col("op") == OP_SET)
    label = rows.select(
        F.col(uid).alias("subject"), F.lit(type_predicate).alias("predicate"), F.lit(type_name).alias("value"),
        F.lit("string").alias("value_type"), F.lit(OP_SET).alias("op"),
    )
    return cells.unionByName(label).select(
        "subject", "predicate", F.lit(None).cast("string").alias("object"),
        F.when(F.col("op") == OP_DEL, STAR).otherwise(F.col("value")).alias("value"), "value_type",
        F.lit(None).cast("string").alias("lang"), F.lit(None).cast("map<string,string>").alias("facets"),
        (F.col("op") == OP_DEL).alias("star"), "op",
    )


def changes_from(triples: DataFrame, commit_ts: int, namespace: int = 0) -> DataFrame:
    """Resolved triples (with `op`) to change-log rows of one transaction."""
    return triples.select(
        F.lit(namespace).cast("long").alias("namespace"),
        uids.to_long(F.col("subject")).alias("subject"),
        "predicate",
        uids.to_long(F.col("object")).alias("object_uid"),
        "value", "value_type", "lang", "facets", "op",
        F.lit(0).cast("long").alias("seq"),
        F.lit(commit_ts).cast("long").alias("start_ts"),
        F.lit(commit_ts).cast("long").alias("commit_ts"),
    )
