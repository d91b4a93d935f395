"""Schemas and migrations as data jobs.

A mapping row describes one predicate of one type:
(namespace, version, type_name, predicate, kind, list_type, token, fulltext, trigram,
indexed, upsert, lang, reverse, count, metric, reversed, target). Frames are keyed by
(namespace, version), so one job handles the schemas of all tenants and versions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Token strength orders and vector metrics.
STRING_TOKENS = ("none", "exact", "hash", "term")
TIME_TOKENS = ("none", "year", "month", "day", "hour")
METRICS = ("Cosine", "Dot", "Euclidean")

VERSION = ["namespace", "version"]


def _rank(token: Column, order: Sequence[str]) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[c for i, t in enumerate(order) for c in (F.lit(t), F.lit(i))]), token), F.lit(0))


def _token(rank: Column, order: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in order]), rank + 1)


# rendering -------------------------------------------------------------------
PLAIN_INDEX = ("bool", "float", "int", "geo")
UPSERTABLE = PLAIN_INDEX + ("dateTime", "float32vector", "string")
RENDERED = UPSERTABLE + ("uid", "list", "password")


def schema_line() -> Column:
    """Schema text of a predicate, one blank between parts; null for kinds that have none
    (the uid and type predicates themselves)."""
    c, kind = F.col, F.col("kind")
    flag = lambda cond, text: F.when(cond, F.lit(text))
    index_of = lambda text: F.concat(F.lit("@index("), text, F.lit(")"))
    has_token = F.coalesce(c("token"), F.lit("none")) != "none"
    reversed_list = (kind == "list") & c("reversed")

    tokens = F.concat_ws(
        ", ", flag(c("fulltext"), "fulltext"), flag(c("trigram"), "trigram"),
        F.when(has_token, c("token")).when(c("upsert") & ~c("fulltext") & ~c("trigram"), F.lit("exact")),
    )
    metric = F.concat(F.lit('hnsw(metric:"'), F.coalesce("metric", F.lit("Euclidean")), F.lit('")'))
    index = (
        F.when(kind.isin(*PLAIN_INDEX), F.when(c("indexed") | c("upsert"), index_of(kind)))
        .when(kind == "dateTime", F.when(has_token, index_of(c("token"))).when(c("upsert"), "@index(hour)"))
        .when(kind == "string", F.when(c("fulltext") | c("trigram") | has_token | c("upsert"), index_of(tokens)))
        .when(kind == "float32vector", index_of(metric))
    )
    name = F.when(reversed_list, "uid").when(kind == "list", F.concat(F.lit("["), c("list_type"), F.lit("]"))).otherwise(kind)
    return F.when(
        kind.isin(*RENDERED),
        F.concat_ws(
            " ", F.concat(c("predicate"), F.lit(":")), name, index,
            flag((kind == "string") & c("lang"), "@lang"),
            flag(kind.isin(*UPSERTABLE) & c("upsert"), "@upsert"),
            flag(reversed_list, "@reverse"),
            flag(kind.isin("uid", "list") & c("count"), "@count"),
            flag((kind == "uid") & c("reverse"), "@reverse"),
            F.lit("."),
        ),
    )


def schema_lines(mappings: DataFrame) -> DataFrame:
    rows = mappings.where(F.col("kind").isin(*RENDERED))
    return rows.select(*VERSION, "type_name", "predicate", schema_line().alias("line"))


def merge(mappings: DataFrame) -> DataFrame:
    """One row per predicate: flags OR, the strongest token, the kind given by the first
    type by name. Map-side combined; a predicate shared by very many types is no hot spot."""
    first = lambda name: F.min_by(name, F.struct("type_name", "kind")).alias(name)
    flags = ("fulltext", "trigram", "indexed", "upsert", "lang", "reverse", "count", "reversed")
    merged = mappings.groupBy(*VERSION, "predicate").agg(
        first("kind"), first("list_type"), first("metric"),
        F.max(_rank(F.col("token"), STRING_TOKENS)).alias("_s"), F.max(_rank(F.col("token"), TIME_TOKENS)).alias("_t"),
        *[F.bool_or(f).alias(f) for f in flags],
    )
    token = F.when(F.col("kind") == "dateTime", _token(F.col("_t"), TIME_TOKENS)).otherwise(_token(F.col("_s"), STRING_TOKENS))
    return merged.withColumn("token", token).drop("_s", "_t")


def type_lines(mappings: DataFrame) -> DataFrame:
    """Type definitions as ordered lines (open, members by name, close): rows, so a type
    with very many predicates is never put together in one place."""
    members = mappings.select(
        *VERSION, "type_name", F.lit(1).alias("part"), F.col("predicate").alias("member"),
        F.when(F.col("reversed"), F.concat(F.lit("  <~"), F.col("predicate"), F.lit(">"))).otherwise(
            F.concat(F.lit("  "), F.col("predicate"))
        ).alias("line"),
    ).distinct()
    types = mappings.select(*VERSION, "type_name").distinct()
    frame = types.select(
        *VERSION, "type_name",
        F.inline(F.array(
            F.struct(F.lit(0).alias("part"), F.lit("").alias("member"), F.concat(F.lit("type "), F.col("type_name"), F.lit(" {")).alias("line")),
            F.struct(F.lit(2).alias("part"), F.lit("").alias("member"), F.lit("}").alias("line")),
        )),
    )
    return members.unionByName(frame)


def script(mappings: DataFrame) -> DataFrame:
    """The whole schema text as rows in order: predicates by name, then types by name."""
    predicates = schema_lines(merge(mappings).withColumn("type_name", F.lit(""))).select(
        *VERSION, F.lit(0).alias("section"), F.lit("").alias("name"), F.lit(0).alias("part"), F.col("predicate").alias("member"), "line"
    )
    types = type_lines(mappings).select(*VERSION, F.lit(1).alias("section"), F.col("type_name").alias("name"), "part", "member", "line")
    return predicates.unionByName(types).orderBy(*VERSION, "section", "name", "part", "member", "line")


# types -----------------------------------------------------------------------
SPARK_KINDS = {
    "string": "string", "binary": "string",
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "interval": "int",
    "float": "float", "double": "float", "decimal": "float",
    "timestamp": "dateTime", "timestamp_ntz": "dateTime", "date": "dateTime",
    "boolean": "bool", "geo": "geo", "node": "uid",
}


def graph_type(spark_type: Column) -> Column:
    """Spark type name to graph type: lists as `[t]`, a struct with facets as its value's
    type, float arrays as vectors; null if there is none."""
    kinds = F.create_map(*[c for pair in SPARK_KINDS.items() for c in map(F.lit, pair)])
    name = F.lower(spark_type)
    is_list = name.startswith("array<")
    element = F.regexp_replace(name, r"^array<(.*)>$", "$1")
    element = F.regexp_replace(element, r"^struct<value:([^,<>]+),.*$", "$1")
    element = F.regexp_replace(element, r"^(decimal|interval)\b.*$", "$1")
    element = F.regexp_replace(element, r"^struct<type:string,coordinates:.*$", "geo")
    element = F.regexp_replace(element, r"^struct<uid:.*$", "node")
    kind = F.try_element_at(kinds, element)
    return (
        F.when(name == "array<float>", "float32vector")
        .when(is_list, F.concat(F.lit("["), kind, F.lit("]")))
        .otherwise(kind)
    )


def automatic_mapping(frames: dict[str, DataFrame], enums: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Mapping rows from the columns of each type's frame: numbers and geo indexed, times by
    hour, strings by term, declared enums (type to columns) exact, lists counted. Only
    metadata is read."""
    columns = []
    for type_name, df in frames.items():
        declared = set((enums or {}).get(type_name, ()))
        columns += [(type_name, f.name, f.dataType.simpleString(), f.name in declared) for f in df.schema]
    spark = next(iter(frames.values())).sparkSession
    described = spark.createDataFrame(columns, "type_name string, predicate string, spark_type string, is_enum boolean")
    rows = described.withColumn("g", graph_type(F.col("spark_type"))).where(F.col("g").isNotNull())
    is_list = F.col("g").startswith("[")
    no = F.lit(False)
    return rows.select(
        F.lit(0).cast("long").alias("namespace"), F.lit(0).cast("long").alias("version"), "type_name", "predicate",
        F.when(is_list, "list").otherwise(F.col("g")).alias("kind"),
        F.when(is_list, F.regexp_replace("g", r"[\[\]]", "")).alias("list_type"),
        F.when(F.col("g") == "string", F.when(F.col("is_enum"), "exact").otherwise("term"))
        .when(F.col("g") == "dateTime", "hour").otherwise("none").alias("token"),
        no.alias("fulltext"), no.alias("trigram"), F.col("g").isin("int", "float", "geo").alias("indexed"),
        no.alias("upsert"), no.alias("lang"), no.alias("reverse"), is_list.alias("count"),
        F.lit("Euclidean").alias("metric"), no.alias("reversed"), F.lit(None).cast("string").alias("target"),
    )


# validation and diff ---------------------------------------------------------
def reverse_errors(mappings: DataFrame) -> DataFrame:
    """Reverse mappings whose edge is not mapped on the target type, is no edge, or is not
    reversible; all of them, as rows. List edges count as edges."""
    wanted = mappings.where("reversed").select(*VERSION, "type_name", "predicate", "target")
    given = mappings.where("NOT reversed").select(
        *VERSION, F.col("type_name").alias("target"), "predicate",
        ((F.col("kind") == "uid") | ((F.col("kind") == "list") & (F.col("list_type") == "uid"))).alias("_edge"), "reverse",
    ).distinct()
    best = given.groupBy(*VERSION, "target", "predicate").agg(F.bool_or("_edge").alias("_edge"), F.bool_or("reverse").alias("_reversible"))
    joined = wanted.join(best, [*VERSION, "target", "predicate"], "left")
    error = F.when(F.col("_edge").isNull(), "not mapped").when(~F.col("_edge"), "not an edge").when(~F.col("_reversible"), "not reversible")
    return joined.select(*VERSION, "type_name", "predicate", "target", error.alias("error")).where(F.col("error").isNotNull())


def diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(namespace, item, name, change) between two versions of each tenant: predicates new,
    changed (their line differs) or removed, and types new or removed."""
    def lines(m: DataFrame, name: str) -> DataFrame:
        merged = merge(m).withColumn("type_name", F.lit(""))
        return schema_lines(merged).select("namespace", "predicate", F.col("line").alias(name))

    both = lines(old, "_old").join(lines(new, "_new"), ["namespace", "predicate"], "full_outer")
    change = (
        F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "removed").when(F.col("_old") != F.col("_new"), "changed")
    )
    predicates = both.select("namespace", F.lit("predicate").alias("item"), F.col("predicate").alias("name"), change.alias("change"))
    types = lambda m: m.select("namespace", F.col("type_name").alias("name")).distinct()
    gone = types(old).join(types(new), ["namespace", "name"], "left_anti").withColumn("change", F.lit("removed"))
    fresh = types(new).join(types(old), ["namespace", "name"], "left_anti").withColumn("change", F.lit("new"))
    kinds = gone.unionByName(fresh).select("namespace", F.lit("type").alias("item"), "name", "change")
    return predicates.where(F.col("change").isNotNull()).unionByName(kinds)


def _schema_fields() -> dict[str, Column]:
    kind, token = F.col("kind"), F.nullif("token", F.lit("none"))
    listed = kind == "list"
    return {
        "type": F.when(listed, F.concat(F.lit("["), F.col("list_type"), F.lit("]"))).otherwise(kind),
        "index": F.col("indexed") | F.col("fulltext") | F.col("trigram") | token.isNotNull() | F.col("upsert"),
        "tokenizer": F.array_join(F.array_compact(F.array(F.when(F.col("fulltext"), "fulltext"), F.when(F.col("trigram"), "trigram"), token)), ","),
        "reverse": F.col("reverse") | (listed & F.col("reversed")),
        "count": F.col("count"),
        "list": listed,
        "upsert": F.col("upsert"),
        "lang": F.col("lang"),
    }


def query_schema(merged: DataFrame, predicates: Sequence[str] | None = None, fields: Sequence[str] = ("type",)) -> DataFrame:
    """schema(pred: [..]) {fields} or schema{}: the chosen fields per predicate, sorted by it."""
    rows = merged if predicates is None else merged.where(F.col("predicate").isin(list(predicates)))
    known = _schema_fields()
    return rows.select(*VERSION, "predicate", *[known[f].alias(f) for f in fields]).orderBy(*VERSION, "predicate")


def query_types(mappings: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """schema(type: [..]): the predicates of each type, as rows sorted by both."""
    rows = mappings if types is None else mappings.where(F.col("type_name").isin(list(types)))
    return rows.select(*VERSION, "type_name", "predicate").distinct().orderBy(*VERSION, "type_name", "predicate")


# migrations ------------------------------------------------------------------
# The form of a migration's full name and of its time.
MIGRATION_NAME = r"^([A-Z][A-Za-z0-9]{2,})_(\d{14})$"
MIGRATION_TIME = "yyyyMMddHHmmss"


def parse_migration_name(text: Column) -> Column:
    """`Name_yyyyMMddHHmmss` to (name, generated_at); null if name or time is refused."""
    time = F.try_to_timestamp(F.nullif(F.regexp_extract(text, MIGRATION_NAME, 2), F.lit("")), F.lit(MIGRATION_TIME))
    return F.when(
        text.rlike(MIGRATION_NAME) & time.isNotNull(),
        F.struct(F.regexp_extract(text, MIGRATION_NAME, 1).alias("name"), time.cast("timestamp_ntz").alias("generated_at")),
    )


def pending(migrations: DataFrame, ledger: DataFrame, tenant: Sequence[str] = ("namespace",)) -> DataFrame:
    """Migrations newer than the last applied one of their tenant and not in its ledger,
    in time order."""
    keys = list(tenant)
    last = ledger.groupBy(*keys).agg(F.max("generated_at").alias("_last"))
    newer = migrations.join(last, keys, "left").where(F.col("_last").isNull() | (F.col("generated_at") > F.col("_last")))
    return newer.drop("_last").join(ledger.select(*keys, "name"), [*keys, "name"], "left_anti").orderBy(*keys, "generated_at", "name")


@dataclass
class Step:
    """What one direction of a migration does."""

    drop_types: Sequence[str] = ()
    drop_predicates: Sequence[str] = ()
    set_types: Sequence[tuple[str, str]] = ()  # (type, predicate)


@dataclass
class Migration:
    name: str
    generated_at: str
    up: Step
    down: Step


@dataclass
class Store:
    """Facts plus metadata of all tenants: `types` (namespace, type_name, predicate), `ledger`
    (namespace, name, generated_at, applied_at)."""

    facts: DataFrame
    types: DataFrame
    ledger: DataFrame


def migrate(store: Store, migration: Migration, applied_at: str, down: bool = False, tenants: Sequence[int] = (0,)) -> Store:
    """Apply a migration to the given tenants, or take it back. A tenant that knows it going up,
    or does not going down, is left as it is, as are all others. Which tenants know it is a
    scalar subquery over the ledger: nothing runs here."""
    tenants = list(tenants)
    known_by = store.ledger.where(F.col("name") == migration.name).agg(F.collect_set("namespace")).scalar()

    def acts(namespace: Column) -> Column:
        knows = F.array_contains(known_by, namespace)
        return namespace.isin(tenants) & (knows if down else ~knows)

    here = acts(F.col("namespace"))
    step = migration.down if down else migration.up
    gone = list(step.drop_predicates)
    keep = ~(here & F.col("predicate").isin(gone)) if gone else F.lit(True)
    types = store.types.where(keep)
    if step.drop_types:
        types = types.where(~(here & F.col("type_name").isin(list(step.drop_types))))
    spark = store.ledger.sparkSession
    if step.set_types:
        added = [(n, t, p) for n in tenants for t, p in step.set_types]
        added = spark.createDataFrame(added, "namespace long, type_name string, predicate string").where(here)
        types = types.unionByName(added).distinct()
    if down:
        ledger = store.ledger.where(~(here & (F.col("name") == migration.name)))
    else:
        rows = spark.createDataFrame([(n,) for n in tenants], "namespace long").where(here).select(
            "namespace", F.lit(migration.name).alias("name"), F.lit(migration.generated_at).cast("timestamp_ntz").alias("generated_at"),
            F.lit(applied_at).cast("timestamp_ntz").alias("applied_at"),
        )
        ledger = store.ledger.unionByName(rows)
    return replace(store, facts=store.facts.where(keep), types=types, ledger=ledger)


def remove_migration(store: Store, migrations: Sequence[Migration], name: str, tenants: Sequence[int] = (0,)) -> Store:
    """Take back a migration and every later one, newest first, in the given tenants."""
    since = next(m.generated_at for m in migrations if m.name == name)
    for m in sorted(migrations, key=lambda m: m.generated_at, reverse=True):
        if m.generated_at >= since:
            store = migrate(store, m, applied_at=m.generated_at, down=True, tenants=tenants)
    return store
