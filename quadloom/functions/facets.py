"""Facets and language values as column expressions.

A facet map is MAP<STRING, STRING> whose values are JSON literals, so `"13"` (text) and
`13` (number) stay apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from quadloom.functions.values import decode_literal, is_float, is_int, json_literal, to_bool

# The separators of a facet key and of a language key, and the types a
# facet keeps; any other type is kept as text.
FACET_SEPARATOR, LANGUAGE_SEPARATOR = "|", "@"
KEPT_TYPES = ("boolean", "timestamp", "timestamp_ntz", "date", "float", "double", "int", "smallint", "tinyint")


def parse_key(text: Column) -> Column:
    """`p|f`, else `p@lang`, to (predicate, facet, is_lang); null unless exactly two parts."""
    by_facet, by_lang = F.split(text, r"\|"), F.split(text, "@")

    def parts(cells: Column, is_lang: bool) -> Column:
        return F.struct(
            F.get(cells, F.lit(0)).alias("predicate"), F.get(cells, F.lit(1)).alias("facet"), F.lit(is_lang).alias("is_lang")
        )

    return F.when(F.size(by_facet) == 2, parts(by_facet, False)).when(F.size(by_lang) == 2, parts(by_lang, True))


def format_key(key: Column) -> Column:
    mark = F.when(key["is_lang"], LANGUAGE_SEPARATOR).otherwise(FACET_SEPARATOR)
    return F.concat(key["predicate"], mark, key["facet"])


def get(facets: Column, name: str, spark_type: str = "string", default=None) -> Column:
    """A facet as a type, or the default when it is missing or of another type."""
    literal = F.try_element_at(facets, F.lit(name))
    quoted = literal.startswith('"')
    if spark_type == "string":
        value = F.when(quoted, decode_literal(literal))
    elif spark_type in ("timestamp", "date"):
        value = F.when(quoted, decode_literal(literal).try_cast(spark_type))
    else:
        plain = to_bool(literal) if spark_type == "boolean" else F.when(is_float(literal), literal.try_cast(spark_type))
        value = F.when(~quoted, plain)
    return F.coalesce(value, F.lit(default).cast(spark_type))


def put(facets: Column, name: str, value: Column, spark_type: str) -> Column:
    """Set a facet; a null value removes it; unsupported types (64-bit integers too) become text."""
    stored = value if spark_type in KEPT_TYPES else value.cast("string")
    base = F.coalesce(facets, F.create_map().cast("map<string,string>"))
    without = F.map_filter(base, lambda k, _: k != name)
    with_it = F.map_concat(without, F.create_map(F.lit(name), json_literal(stored)))
    return F.when(value.isNull(), without).otherwise(with_it)


def remove(facets: Column, name: str) -> Column:
    return F.map_filter(facets, lambda k, _: k != name)


def columns(facets: Column, predicate: str, names: Sequence[str] | dict[str, str]) -> list[Column]:
    """Result columns `pred|facet` (or the given aliases) with the plain text of each facet."""
    alias = names if isinstance(names, dict) else {n: f"{predicate}|{n}" for n in names}
    return [decode_literal(F.try_element_at(facets, F.lit(n))).alias(a) for n, a in alias.items()]


def sorted_keys(facets: Column) -> Column:
    return F.array_sort(F.map_keys(facets))


# JSON facets -----------------------------------------------------------------
# A date-like start; without it texts such as a bare year would count as times.
_DATE_START = r"^\d{4}-\d{2}-\d{2}([T ]|$)"


def inferred_type(literal: Column) -> Column:
    """Type of a JSON literal read as a facet; null for null, arrays and objects."""
    text = decode_literal(literal)
    is_time = text.rlike(_DATE_START) & text.try_cast("timestamp").isNotNull()
    return (
        F.when(literal.startswith('"'), F.when(is_time, "dateTime").otherwise("string"))
        .when(literal.isin("true", "false"), "bool")
        .when(is_int(literal), "int")
        .when(is_float(literal), "float")
    )


def facet_entries(facets: Column) -> Column:
    return F.array_sort(F.map_entries(facets))
