"""N-Quad text: source and sink.

Triples in text form: (subject, predicate, object, value, value_type, lang, facets, star).
`subject` and `object` are uid texts (`0x..`, `_:label`) or variables (`uid(v)`). A star as
object deletes a predicate of a node, `s * * .` the whole node.
Parsing uses anchored prefixes and one masked scan for the closing quote, so the cost
is linear in the line and long literals cannot exhaust the regex engine's stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quadloom.functions import uid as uids
from quadloom.functions.values import decode_literal, typed_literal
from quadloom.model import STAR

# The pieces of the line grammar.
NODE = r"<0x[0-9a-fA-F]{1,16}>|_:[A-Za-z0-9_]{1,32}|uid\(\w+\)"
PREDICATE = r"^<[^<>\s\"]+>$"
BARE = rf"^({NODE}|\*|-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false)"
TAIL = r"(?s)^(?:@([A-Za-z][A-Za-z0-9-]*))?\s*(?:\((.*)\))?\s*\.\s*$"
FACET = r"([^\s=,()]+)\s*=\s*(\"(?:[^\"\\]|\\.)*\"|[^\s,\"]+)"
FACETS_TEXT = rf"(?s)^\s*{FACET}(?:\s*,\s*{FACET})*\s*$"

TRIPLE_COLUMNS = ["subject", "predicate", "object", "value", "value_type", "lang", "facets", "star"]


def _node(token: Column) -> Column:
    """Text of a token that already matched NODE: brackets off, lower case."""
    return (
        F.when(token.startswith("uid("), token)
        .when(token.startswith("<"), F.lower(F.substr(token, F.lit(2), F.length(token) - 2)))
        .otherwise(F.lower(token))
    )


def parse(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per non-blank line: triple columns, the line, and `error` (null if good).

    Each line is cut in three at blanks, then the object is cut off the rest; the shapes of
    the pieces are tested once each, and only lines that need it take the longer ways
    (escapes in a literal, anything but a dot at the end)."""
    blanks = F.lit(" \t\r")
    rows = lines.select(F.col(column).alias("line")).where(F.trim("line", blanks) != "")
    rows = rows.select("line", F.split(F.ltrim("line", blanks), r"\s+", 3).alias("_cut"))
    piece = lambda i: F.coalesce(F.get("_cut", F.lit(i)), F.lit(""))
    rows = rows.select("line", piece(0).alias("_s"), piece(1).alias("_p"), piece(2).alias("_rest"))
    rest = F.col("_rest")
    # An escape is two characters wide, and so is its mask: positions stay the same.
    masked = F.when(rest.contains("\\"), F.regexp_replace(rest, r"\\.", "__")).otherwise(rest)
    token = F.when(rest.startswith('"'), F.substr(rest, F.lit(1), F.locate('"', masked, 2))).otherwise(
        F.regexp_extract(rest, BARE, 1)
    )
    rows = rows.select("line", "_s", "_p", "_rest", token.alias("_object"))
    rows = rows.select("line", "_s", "_p", "_object", F.trim(F.substr(F.col("_rest"), F.length("_object") + 1), blanks).alias("_tail"))
    tail = F.col("_tail")
    rows = rows.select(
        "line", "_s", "_p", "_object", "_tail",
        F.when(tail == ".", "").otherwise(F.regexp_extract(tail, TAIL, 2)).alias("_facets"),
        F.when(tail != ".", F.nullif(F.regexp_extract(tail, TAIL, 1), F.lit(""))).alias("_lang"),
    )
    obj = F.col("_object")
    is_text = obj.startswith('"')
    is_node = obj.startswith("<") | obj.startswith("_:") | obj.startswith("uid(")
    text = F.when(is_text, decode_literal(obj))
    lang = F.col("_lang")
    zero = lambda node: F.translate(node, "0", "") == "<x>"  # noqa: E731  uid 0 names no node
    error = (
        F.when(~F.col("_s").rlike(rf"^(?:{NODE})$") | zero(F.col("_s")), "subject")
        .when(~(F.col("_p").rlike(PREDICATE) | ((F.col("_p") == "*") & (obj == "*"))), "predicate")
        .when((obj == "") | zero(obj), "object")
        .when(is_text & text.isNull(), "literal")
        .when((tail != ".") & ~tail.rlike(TAIL), "end of line")
        .when(~is_text & lang.isNotNull(), "language")
        .when((F.col("_facets") != "") & ~F.col("_facets").rlike(FACETS_TEXT), "facets")
    )
    facets = F.when(
        F.col("_facets") != "",
        F.map_from_arrays(
            F.regexp_extract_all("_facets", F.lit(FACET), F.lit(1)),
            F.regexp_extract_all("_facets", F.lit(FACET), F.lit(2)),
        ),
    )
    bare = F.when(~is_text & ~is_node & (obj != "*"), obj)
    kind = (
        F.when(is_text, "string")
        .when(is_node, "uid")
        .when(obj == "*", "default")
        .when(obj.isin("true", "false"), "bool")
        .when(obj.contains(".") | obj.contains("e") | obj.contains("E"), "float")
        .otherwise("int")
    )
    return rows.select(
        _node(F.col("_s")).alias("subject"),
        F.when(F.col("_p") == "*", STAR).otherwise(F.substr(F.col("_p"), F.lit(2), F.length("_p") - 2)).alias("predicate"),
        F.when(is_node, _node(obj)).alias("object"),
        F.when(obj == "*", F.lit(STAR)).otherwise(F.coalesce(text, bare)).alias("value"),
        kind.alias("value_type"),
        lang.alias("lang"),
        facets.alias("facets"),
        (obj == "*").alias("star"),
        "line",
        error.alias("error"),
    )


def triples(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNull()).select(*TRIPLE_COLUMNS)


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNotNull()).select("line", "error")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Parse N-Quad files; keep good rows with `triples`, bad ones with `rejects`."""
    return parse(spark.read.text(path))


def from_facts(facts: DataFrame) -> DataFrame:
    """Facts to triples in text form."""
    return facts.select(
        uids.to_text(F.col("subject")).alias("subject"),
        "predicate",
        uids.to_text(F.col("object_uid")).alias("object"),
        "value",
        "value_type",
        "lang",
        "facets",
        F.lit(False).alias("star"),
    )


def to_facts(rows: DataFrame, namespace: int = 0) -> DataFrame:
    """Triples whose uids are all concrete back to facts."""
    return rows.where(~F.col("star")).select(
        F.lit(namespace).cast("long").alias("namespace"),
        uids.to_long(F.col("subject")).alias("subject"),
        "predicate",
        uids.to_long(F.col("object")).alias("object_uid"),
        "value",
        "value_type",
        "lang",
        "facets",
    )


def facet_text(facets: Column) -> Column:
    """` (k=v, ...)` by key, or nothing; map values are already literals."""
    pairs = F.transform(
        F.array_sort(F.map_entries(facets)), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return F.when(
        facets.isNotNull() & (F.size(facets) > 0), F.concat(F.lit(" ("), F.array_join(pairs, ", "), F.lit(")"))
    ).otherwise("")


def lines(rows: DataFrame) -> DataFrame:
    """One line per triple: uid objects as nodes, stars as `*`, literals with language."""
    node = lambda c: F.when(c.startswith("uid("), c).otherwise(uids.in_nquad(c))
    literal = F.concat(
        typed_literal(F.col("value"), F.col("value_type")),
        F.coalesce(F.concat(F.lit("@"), F.col("lang")), F.lit("")),
    )
    obj = F.when(F.col("star"), "*").otherwise(F.coalesce(node(F.col("object")), literal))
    predicate = F.when(F.col("predicate") == STAR, "*").otherwise(F.concat(F.lit("<"), F.col("predicate"), F.lit(">")))
    line = F.concat(node(F.col("subject")), F.lit(" "), predicate, F.lit(" "), obj, facet_text(F.col("facets")), F.lit(" ."))
    return rows.select(line.alias("line")).where(F.col("line").isNotNull())


def write(rows: DataFrame, path: str) -> None:
    lines(rows).write.text(path)


def type_rows(nodes: DataFrame, labels: Column, type_predicate: str, key: str = "uid") -> DataFrame:
    """One triple per type label of a node."""
    return nodes.select(
        uids.to_text(F.col(key)).alias("subject"),
        F.lit(type_predicate).alias("predicate"),
        F.lit(None).cast("string").alias("object"),
        F.explode(labels).alias("value"),
        F.lit("string").alias("value_type"),
        F.lit(None).cast("string").alias("lang"),
        F.lit(None).cast("map<string,string>").alias("facets"),
        F.lit(False).alias("star"),
    )
