"""JSON of unknown shape to triples.

Texts are parsed to VARIANT values and opened by rounds: a round takes every value that is still
an object or an array, whatever its depth, and puts its fields or items in its place. So no
schema is declared and the number of rounds is the depth of the deepest text. Each round is
written once; only what is still closed goes into the next. The rows are those of
`json_io.to_triples` for texts that a declared schema fits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quadloom.functions import uid as uids
from quadloom.plans.cut import written
from quadloom.sources.nquads import TRIPLE_COLUMNS

_FACETS = "map<string,string>"


def _object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def _array(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _facets(fields: Column, predicate: Column) -> Column:
    """JSON literals of the fields `predicate|key`, by key; null if there is none."""
    start = F.concat(predicate, F.lit("|"))
    own = F.map_filter(fields, lambda k, v: k.startswith(start) & ~F.is_variant_null(v))
    named = F.transform_keys(own, lambda k, v: F.substr(k, F.length(start) + 1))
    return F.when(F.size(own) > 0, F.transform_values(named, lambda k, v: F.to_json(v)))


def _uid(value: Column, fields: Column) -> Column:
    """The uid text of an object, or a label digested from its content in key order."""
    given = F.try_variant_get(F.try_element_at(fields, F.lit("uid")), "$", "string")
    return F.coalesce(uids.normalise(given), uids.blank_label(F.to_json(value)))


def _is_geo(fields: Column) -> Column:
    return F.array_sort(F.map_keys(fields)) == F.array(F.lit("coordinates"), F.lit("type"))


def _fields(objects: DataFrame) -> DataFrame:
    """The fields of objects (uid, fields, via) as rows (subject, predicate, lang, facets, value).
    The facets of the edge an object was reached by are no facets of its own fields."""
    shown = F.map_filter("fields", lambda k, v: (k != "uid") & ~F.contains(k, F.lit("|")) & ~F.is_variant_null(v))
    rows = objects.select("uid", "via", F.map_filter("fields", lambda k, v: F.contains(k, F.lit("|"))).alias("facet_fields"), F.explode(shown).alias("name", "value"))
    at = F.instr("name", "@")
    tagged = at > 0
    predicate = F.when(tagged, F.substr("name", F.lit(1), at - 1)).otherwise(F.col("name"))
    own = F.when(~tagged & ~F.col("via").eqNullSafe(F.col("name")), _facets(F.col("facet_fields"), F.col("name")))
    return rows.select(
        F.col("uid").alias("subject"), predicate.alias("predicate"), F.when(tagged, F.substr("name", at + 1)).alias("lang"),
        own.cast(_FACETS).alias("facets"), "value",
    )


def _kind(value: Column) -> Column:
    shape = F.schema_of_variant(value)
    return (
        F.when(shape == "BOOLEAN", "bool")
        .when(shape == "BIGINT", "int")
        .when(shape.rlike("^(DOUBLE|FLOAT|DECIMAL)"), "float")
        .otherwise("string")
    )


def _opened(pending: DataFrame) -> DataFrame:
    """Rows (subject, predicate, lang, facets, value) with what each value is: `fields` of an
    object, `items` of an array, else a leaf with its value type and text."""
    shaped = pending.select("*", _object(F.col("value")).alias("fields"), _array(F.col("value")).alias("items"))
    leaf = F.col("fields").isNull() & F.col("items").isNull()
    kind = F.when(leaf, F.when(F.col("lang").isNotNull(), "string").otherwise(_kind(F.col("value"))))
    shaped = shaped.select("*", F.coalesce(_is_geo(F.col("fields")), F.lit(False)).alias("geo"), kind.alias("kind"))
    text = F.when(F.col("kind") == "float", _number(F.col("value"))).when(leaf, F.try_variant_get("value", "$", "string"))
    node = F.col("fields").isNotNull() & ~F.col("geo")
    return shaped.select(
        "subject", "predicate", "lang", "facets",
        F.when(F.col("geo"), F.lit("geo")).when(node, F.lit("uid")).otherwise(F.col("kind")).alias("value_type"),
        F.when(F.col("geo"), F.to_json("value")).otherwise(text).alias("text"),
        F.when(node, _uid(F.col("value"), F.col("fields"))).alias("object"),
        F.when(node, F.col("fields")).alias("fields"), "items",
    )


def _number(value: Column) -> Column:
    """Doubles as text; whole numbers beyond 64 bits keep their digits."""
    digits = F.try_variant_get(value, "$", "string")
    return F.when(digits.rlike("^-?[0-9]{19,}$"), digits).otherwise(F.try_variant_get(value, "$", "double").cast("string"))


def _triples(opened: DataFrame) -> DataFrame:
    rows = opened.where("text is not null or object is not null")
    edge = F.col("object").isNotNull()
    return rows.select(
        "subject", "predicate", "object", F.col("text").alias("value"), "value_type",
        F.when(~edge, F.col("lang")).alias("lang"),
        F.when(edge, _facets(F.col("fields"), F.col("predicate"))).otherwise(F.col("facets")).cast(_FACETS).alias("facets"),
        F.lit(False).alias("star"),
    ).select(*TRIPLE_COLUMNS)


def unreadable(documents: DataFrame, column: str) -> DataFrame:
    """Rows whose text is no JSON, or neither an object nor an array; null texts are none."""
    value = F.try_parse_json(column)
    fits = _object(value).isNotNull() | _array(value).isNotNull()
    return documents.where(F.col(column).isNotNull() & ~F.coalesce(fits, F.lit(False)))


def to_triples(documents: DataFrame, column: str) -> DataFrame:
    """Triples of JSON texts of any shape and depth: one row per leaf, list item and edge.

    A text is an object or an array of objects. Objects without a uid are blank nodes named by
    their content, equal ones are one node; `name@tag` is a text in a language; `name|key` is a
    facet of the value `name`, or of the edge `name` that leads to the object; an object of
    `type` and `coordinates` is a geometry; nulls say nothing; lists in lists count as one list.
    A list item that is no object has no facets. Numbers with a point or an exponent, and whole
    ones beyond 64 bits, are floats. Unreadable texts give no rows (`unreadable`)."""
    value = F.try_parse_json(column).alias("value")
    root = documents.select(value).where("value is not null")
    tops = root.select(F.explode(F.coalesce(_array(F.col("value")), F.array("value"))).alias("value"))
    tops = tops.select("value", _object(F.col("value")).alias("fields")).where("fields is not null")
    pending = _fields(tops.select(_uid(F.col("value"), F.col("fields")).alias("uid"), "fields", F.lit(None).cast("string").alias("via")))
    done = []
    while True:
        opened = written(_opened(pending), "json-round")
        done.append(_triples(opened))
        closed = opened.where("fields is not null or items is not null")
        if closed.isEmpty():
            return reduce(DataFrame.unionByName, done)
        inner = _fields(closed.where("fields is not null").select(F.col("object").alias("uid"), "fields", F.col("predicate").alias("via")))
        items = closed.where("items is not null").select(
            "subject", "predicate", "lang", F.lit(None).cast(_FACETS).alias("facets"), F.explode("items").alias("value"),
        )
        pending = inner.unionByName(items.where(~F.is_variant_null("value")))
