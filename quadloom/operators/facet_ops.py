"""Facets on values, edges and list elements; language values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quadloom.functions import facets as fx
from quadloom.functions.text import terms
from quadloom.functions.values import decode_literal, json_literal


def value_with_facets(facts: DataFrame, predicate: str, names: Sequence[str], tenant: bool = False) -> DataFrame:
    """`p @facets`: the value beside its `p|facet` columns; with `tenant` also the namespace, which
    facts of several tenants need to tell their nodes apart."""
    return facts.where(F.col("predicate") == predicate).select(
        *["namespace"] * tenant, F.col("subject").alias("uid"), F.col("value").alias(predicate), *fx.columns(F.col("facets"), predicate, names)
    )


def edge_facet_columns(edges: DataFrame, predicate: str, names: Sequence[str]) -> DataFrame:
    """Rename typed facet columns of an edge frame to `p|facet`, as they appear on the child."""
    return edges.select("src", "dst", *[F.col(n).alias(f"{predicate}|{n}") for n in names])


def facet_from_child(edges: DataFrame, children: DataFrame, column: str, facet: str, key: str = "uid") -> tuple[DataFrame, DataFrame]:
    """A child property declared as a facet: (edges carrying it, children without it)."""
    moved = edges.join(children.select(F.col(key).alias("dst"), F.col(column).alias(facet)), "dst", "left")
    return moved, children.drop(column)


def all_languages(facts: DataFrame, predicate: str) -> DataFrame:
    """Every language variant of a predicate as rows."""
    return facts.where((F.col("predicate") == predicate) & F.col("lang").isNotNull()).select(
        "namespace", F.col("subject").alias("uid"), "lang", "value"
    )


def in_language(facts: DataFrame, predicate: str, preference: Sequence[str]) -> DataFrame:
    """The value in the first language present (of several the largest); `.` takes any (the
    smallest tag, of several the smallest). One
    aggregation over the preferred languages; no list of variants is built."""
    rows = all_languages(facts, predicate)
    if "." not in preference:
        rows = rows.where(F.col("lang").isin(list(preference)))
    choices = [
        F.min_by("value", F.struct("lang", "value")) if lang == "." else F.max(F.when(F.col("lang") == lang, F.col("value")))
        for lang in preference
    ]
    key = ["namespace", "uid"]
    found = rows.groupBy(*key).agg(F.coalesce(*choices).alias(predicate))
    subjects = facts.where(F.col("predicate") == predicate).select("namespace", F.col("subject").alias("uid")).distinct()
    return subjects.join(found, key, "left")


def json_facets(documents: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Facet and language keys of JSON objects, one row each with its inferred type.
    Null removes the facet; arrays and objects are ignored."""
    rows = documents.sparkSession.sql(
        "SELECT d.*, v.key AS key, to_json(v.value) AS literal "
        f"FROM {{d}} AS d, LATERAL variant_explode(try_parse_json(d.{column})) AS v",
        d=documents.select(*keys, column),
    )
    parsed = rows.select(*keys, fx.parse_key(F.col("key")).alias("f"), "literal")
    typed = parsed.where(F.col("f").isNotNull()).select(
        *keys, F.col("f.predicate").alias("predicate"), F.col("f.facet").alias("facet"), F.col("f.is_lang").alias("is_lang"),
        fx.inferred_type(F.col("literal")).alias("facet_type"), decode_literal(F.col("literal")).alias("value"),
    )
    return typed.where(F.col("facet_type").isNotNull())


def read_faceted_list(
    documents: DataFrame, column: str, keys: Sequence[str], predicate: str, facets: dict[str, str], value_type: str = "string"
) -> DataFrame:
    """`p` array and `p|f` index maps of a JSON object: one row per element with its facets.
    Null elements are left out but keep their place in the numbering."""
    schema = T.StructType().add(predicate, T.ArrayType(T.DataType.fromDDL(value_type)))
    for name, t in facets.items():
        schema = schema.add(f"{predicate}|{name}", T.MapType(T.StringType(), T.DataType.fromDDL(t)))
    rows = documents.select(*keys, F.from_json(column, schema).alias("o"))
    o = F.col("o")
    elements = rows.select(
        *keys,
        F.posexplode(o.getField(predicate)).alias("pos", "value"),
        *[o.getField(f"{predicate}|{n}").alias(f"_{n}") for n in facets],
    )
    return elements.where(F.col("value").isNotNull()).select(
        *keys, "pos", "value", *[F.try_element_at(F.col(f"_{n}"), F.col("pos").cast("string")).alias(n) for n in facets]
    )


def faceted_list_json(elements: Column, predicate: str) -> Column:
    """ARRAY<STRUCT<value, facets MAP<STRING, literal>>> to `"p":[..],"p|f":{"i":..}` inside
    one JSON object; every element keeps all of its facets."""
    names = F.array_sort(F.array_distinct(F.flatten(F.transform(elements, lambda e: F.map_keys(F.coalesce(
        e["facets"], F.create_map().cast("map<string,string>")))))))

    def index_map(name: Column) -> Column:
        cells = F.transform(
            elements,
            lambda e, i: F.concat(F.lit('"'), i.cast("string"), F.lit('":'), F.try_element_at(e["facets"], name)),
        )
        return F.concat(F.lit(f',"{predicate}|'), name, F.lit('":{'), F.array_join(F.array_compact(cells), ","), F.lit("}"))

    values = F.array_join(F.transform(elements, lambda e: F.coalesce(json_literal(e["value"]), F.lit("null"))), ",")
    return F.concat(
        F.lit(f'{{"{predicate}":['), values, F.lit("]"), F.array_join(F.transform(names, index_map), ""), F.lit("}")
    )


def facet_tokens(facts: DataFrame) -> DataFrame:
    """Lookup terms of every text facet: (namespace, subject, predicate, facet, token)."""
    entries = facts.select("namespace", "subject", "predicate", F.explode("facets").alias("facet", "literal"))
    return entries.where(F.col("literal").startswith('"')).select(
        "namespace", "subject", "predicate", "facet", F.explode(terms(decode_literal(F.col("literal")))).alias("token")
    )
