"""JSON mutations in, entity trees out, responses unwrapped."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quadloom.functions import uid as uids
from quadloom.functions.values import json_literal, to_rfc3339
from quadloom.model import STAR, TYPE_PREDICATE
from quadloom.plans.pages import PAGE_SIZE, nest
from quadloom.sources.nquads import TRIPLE_COLUMNS

_TRIPLE = (
    "struct<subject:string,predicate:string,object:string,value:string,value_type:string,"
    "lang:string,facets:map<string,string>,star:boolean>"
)


def _kind(t: T.DataType) -> str:
    if isinstance(t, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return "int"
    if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "float"
    if isinstance(t, T.BooleanType):
        return "bool"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "dateTime"
    return "string"


def _text(value: Column, t: T.DataType) -> Column:
    return to_rfc3339(value) if _kind(t) == "dateTime" else value.cast("string")


def _is_geo(t: T.DataType) -> bool:
    return isinstance(t, T.StructType) and t.fieldNames() == ["type", "coordinates"]


def _triple(subject, predicate, obj=None, value=None, kind="uid", lang=None, facets=None) -> Column:
    null = F.lit(None)
    return F.struct(
        subject.alias("subject"),
        F.lit(predicate).alias("predicate"),
        (null if obj is None else obj).cast("string").alias("object"),
        (null if value is None else value).cast("string").alias("value"),
        F.lit(kind).alias("value_type"),
        (null if lang is None else F.lit(lang)).cast("string").alias("lang"),
        (null if facets is None else facets).cast("map<string,string>").alias("facets"),
        F.lit(False).alias("star"),
    )


def _facets(obj: Column, struct: T.StructType, predicate: str) -> Column | None:
    keys = [f.name for f in struct if f.name.startswith(predicate + "|")]
    if not keys:
        return None
    pairs = F.array(
        *[F.struct(F.lit(k.split("|", 1)[1]).alias("k"), json_literal(obj.getField(k)).alias("v")) for k in keys]
    )
    kept = F.filter(pairs, lambda p: p["v"].isNotNull())
    return F.when(F.size(kept) > 0, F.map_from_entries(kept))


def node_uid(obj: Column, struct: T.StructType) -> Column:
    """The uid text of a JSON object, or a label digested from its content."""
    label = uids.blank_label(F.to_json(obj))
    return F.coalesce(uids.normalise(obj.getField("uid")), label) if "uid" in struct.fieldNames() else label


def object_triples(obj: Column, struct: T.StructType, subject: Column, via: str | None = None) -> Column:
    """Array of triples of one JSON object and everything nested in it. The recursion is
    over the declared schema when the plan is built; rows are handled by expressions."""
    parts = []
    for f in struct:
        name, t = f.name, f.dataType
        if name == "uid" or "|" in name:
            continue
        value = obj.getField(name)
        if "@" in name:
            base, lang = name.split("@", 1)
            one = F.array(_triple(subject, base, value=value, kind="string", lang=lang))
        elif _is_geo(t):
            one = F.array(_triple(subject, name, value=F.to_json(value), kind="geo"))
        elif isinstance(t, T.StructType):
            one = _children(subject, name, F.array(value), t)
        elif isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType):
            one = _children(subject, name, value, t.elementType)
        elif isinstance(t, T.ArrayType):
            one = F.transform(value, _each_value(subject, name, t.elementType))
        else:
            facets = None if name == via else _facets(obj, struct, name)
            one = F.array(_triple(subject, name, value=_text(value, t), kind=_kind(t), facets=facets))
        parts.append(F.when(value.isNotNull(), one))
    nothing = F.array().cast(f"array<{_TRIPLE}>")
    return F.concat(*[F.coalesce(p, nothing) for p in parts]) if parts else nothing


def _each_value(subject: Column, predicate: str, t: T.DataType):
    return lambda item: _triple(subject, predicate, value=_text(item, t), kind=_kind(t))


def _children(subject: Column, predicate: str, objects: Column, struct: T.StructType) -> Column:
    """Links to nested objects and their own triples. Each child's uid is worked out once
    and bound with the child, as many triples repeat it."""
    bound = F.transform(objects, lambda c: F.struct(node_uid(c, struct).alias("uid"), c.alias("object")))

    def one(b: Column) -> Column:
        child, uid = b.getField("object"), b.getField("uid")
        link = _triple(subject, predicate, obj=uid, facets=_facets(child, struct, predicate))
        return F.concat(F.array(link), object_triples(child, struct, uid, via=predicate))

    return F.flatten(F.transform(bound, one))


def to_triples(documents: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """JSON text rows to triples: one row per leaf, list element and edge; nulls skipped."""
    parsed = documents.select(F.from_json(column, schema).alias("o"))
    parsed = parsed.select("o", node_uid(F.col("o"), schema).alias("_uid"))
    rows = parsed.select(F.inline(object_triples(F.col("o"), schema, F.col("_uid"))))
    return rows.where(F.col("value").isNotNull() | F.col("object").isNotNull()).select(*TRIPLE_COLUMNS)


def to_deletes(documents: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """A delete payload as triples: values and edges named in it, a star where a key is
    null, and a star over the whole node where there is nothing but the uid."""
    named = to_triples(documents, column, schema)
    keys = documents.select(
        node_uid(F.from_json(column, schema), schema).alias("subject"), F.col(column).alias("j"),
        F.json_object_keys(column).alias("keys"),
    )
    fields = F.filter("keys", lambda k: k != "uid")
    # A declared key that is present without a value was null in the text.
    present = F.from_json("j", "map<string,string>")
    nulls = F.filter(fields, lambda k: F.try_element_at(present, k).isNull())
    gone = F.when(F.size(fields) == 0, F.array(F.lit(STAR))).otherwise(nulls)
    stars = keys.select("subject", F.explode(gone).alias("predicate")).select(
        "subject", "predicate", F.lit(None).cast("string").alias("object"), F.lit(STAR).alias("value"),
        F.lit("default").alias("value_type"), F.lit(None).cast("string").alias("lang"),
        F.lit(None).cast("map<string,string>").alias("facets"), F.lit(True).alias("star"),
    )
    return named.unionByName(stars)


# sink ------------------------------------------------------------------------
@dataclass
class Block:
    """Children under one predicate: `rows` has `src` (parent uid), the `order` columns and
    what `item` needs; `item` builds the JSON object of one child (facets as `pred|facet`)."""

    rows: DataFrame
    order: Sequence[str]
    item: Column


def documents(
    nodes: DataFrame,
    values: Sequence[str],
    blocks: dict[str, Block] | None = None,
    labels: Sequence[str] = (),
    key: str = "uid",
    type_predicate: str = TYPE_PREDICATE,
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """One JSON object per node: uid first, type labels, non-null values, then child arrays.

    Children beyond `page_size` go to further objects that carry only the uid and the
    rest of the list; list edges are sets, so applying all of them is the same node."""
    head = [uids.to_text(F.col("_uid")).alias("uid")]
    if labels:
        head.append(F.array(*[F.lit(x) for x in labels]).alias(type_predicate))
    rows = nodes.select(F.col(key).alias("_uid"), *values)
    overflow = []
    for predicate, block in (blocks or {}).items():
        lists = nest(block.rows, ["src"], list(block.order), block.item, predicate, page_size, keep=True)
        first = lists.where("page = 0").select(F.col("src").alias("_src"), predicate)
        rows = rows.join(first, F.col("_uid") == F.col("_src"), "left").drop("_src")
        overflow.append(
            lists.where("page > 0").select(
                F.col("src").alias("uid"),
                "page",
                F.to_json(F.struct(uids.to_text(F.col("src")).alias("uid"), F.col(predicate))).alias("json"),
            )
        )
    out = rows.select(
        F.col("_uid").alias("uid"),
        F.lit(0).cast("long").alias("page"),
        F.to_json(F.struct(*head, *values, *(blocks or {}))).alias("json"),
    )
    for extra in overflow:
        out = out.unionByName(extra)
    return out


def flatten_reference(uid: Column, full: Sequence[Column]) -> Column:
    """A nested entity: only its uid when concrete (stops cycles), all fields otherwise."""
    only_uid = F.to_json(F.struct(uid.alias("uid")))
    return F.when(uids.is_concrete(uid), only_uid).otherwise(F.to_json(F.struct(uid.alias("uid"), *full)))


# responses -------------------------------------------------------------------
def unwrap(text: Column, block: str) -> Column:
    """The block of a response: inside `data`, at top level, or the document itself."""
    path = f"['{block}']"
    return F.coalesce(
        F.get_json_object(text, f"$.data{path}"),
        F.get_json_object(text, f"${path}"),
        F.get_json_object(text, "$.data"),
        text,
    )


def read_response(responses: DataFrame, column: str, block: str, schema: T.StructType | str) -> DataFrame:
    """Rows of one block of each response; a single object counts as a list of one."""
    element = schema.simpleString() if isinstance(schema, T.StructType) else f"struct<{schema}>"
    return responses.select(F.inline(F.from_json(unwrap(F.col(column), block), f"array<{element}>")))
