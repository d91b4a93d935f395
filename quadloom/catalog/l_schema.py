"""Schemas of many tenants and versions, derived from the part table, and migrations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom.catalog.common import LOG, query
from quadloom.catalog.f_counting import FACTS, facts
from quadloom.model import FACT_COLUMNS
from quadloom.operators import counting, schema
from quadloom.operators.schema import Migration, Step, Store
from quadloom.sources.tables import Graph

KINDS = ["bool", "dateTime", "uid", "float32vector", "float", "geo", "int", "list", "password", "string"]
STRING_TOKENS, TIME_TOKENS = ["none", "exact", "hash", "term"], ["none", "year", "month", "day", "hour"]

# One mapping per part: brand number picks predicate and kind, size the flags, type the
# type name, price the version.
MAPPINGS = f"""base AS (SELECT *, cast(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS b, cast(round(p_retailprice * 10) AS BIGINT) AS cents FROM part),
mappings AS (SELECT cast(p_partkey % 4 AS BIGINT) AS namespace, cast(p_size % 2 AS BIGINT) AS version, p_type AS type_name, 'pred_' || b AS predicate,
  [{', '.join(repr(k) for k in KINDS)}][(b % 10) + 1] AS kind, CASE WHEN b < 15 THEN 'uid' ELSE 'string' END AS list_type,
  CASE WHEN b % 10 = 1 THEN ['none', 'year', 'month', 'day', 'hour'][(p_size % 5) + 1] ELSE ['none', 'exact', 'hash', 'term'][(p_size % 4) + 1] END AS token,
  cents % 7 = 0 AS fulltext, cents % 5 = 0 AS trigram, p_size & 1 = 1 AS indexed, p_size & 2 = 2 AS upsert, p_size & 4 = 4 AS lang,
  p_size & 8 = 8 AS reverse, p_size & 16 = 16 AS "count", ['Cosine', 'Dot', 'Euclidean'][(b % 3) + 1] AS metric,
  b % 10 IN (2, 7) AND p_size > 40 AS reversed, p_type AS target FROM base)"""


def mappings(g: Graph):
    rows = g.raw("part").select(
        "*", F.regexp_extract("p_brand", "[0-9]+", 0).cast("int").alias("b"), F.round(F.col("p_retailprice") * 10).cast("long").alias("cents")
    )
    pick = lambda names, i: F.get(F.array(*[F.lit(n) for n in names]), i)
    b, size, cents = F.col("b"), F.col("p_size"), F.col("cents")
    bit = lambda n: size.bitwiseAND(F.lit(n)) == n
    return rows.select(
        (F.col("p_partkey") % 4).cast("long").alias("namespace"), (size % 2).cast("long").alias("version"), F.col("p_type").alias("type_name"),
        F.concat(F.lit("pred_"), b.cast("string")).alias("predicate"), pick(KINDS, b % 10).alias("kind"),
        F.when(b < 15, "uid").otherwise("string").alias("list_type"),
        F.when(b % 10 == 1, pick(TIME_TOKENS, size % 5)).otherwise(pick(STRING_TOKENS, size % 4)).alias("token"),
        (cents % 7 == 0).alias("fulltext"), (cents % 5 == 0).alias("trigram"), bit(1).alias("indexed"), bit(2).alias("upsert"), bit(4).alias("lang"),
        bit(8).alias("reverse"), bit(16).alias("count"), pick(["Cosine", "Dot", "Euclidean"], b % 3).alias("metric"),
        ((b % 10).isin(2, 7) & (size > 40)).alias("reversed"), F.col("p_type").alias("target"),
    )


LINE = """predicate || ': ' || CASE kind
  WHEN 'bool' THEN 'bool ' || CASE WHEN indexed OR upsert THEN '@index(bool) ' ELSE '' END || CASE WHEN upsert THEN '@upsert ' ELSE '' END
  WHEN 'int' THEN 'int ' || CASE WHEN indexed OR upsert THEN '@index(int) ' ELSE '' END || CASE WHEN upsert THEN '@upsert ' ELSE '' END
  WHEN 'float' THEN 'float ' || CASE WHEN indexed OR upsert THEN '@index(float) ' ELSE '' END || CASE WHEN upsert THEN '@upsert ' ELSE '' END
  WHEN 'geo' THEN 'geo ' || CASE WHEN indexed OR upsert THEN '@index(geo) ' ELSE '' END || CASE WHEN upsert THEN '@upsert ' ELSE '' END
  WHEN 'dateTime' THEN 'dateTime ' || CASE WHEN token <> 'none' THEN '@index(' || token || ') ' WHEN upsert THEN '@index(hour) ' ELSE '' END || CASE WHEN upsert THEN '@upsert ' ELSE '' END
  WHEN 'uid' THEN 'uid ' || CASE WHEN "count" THEN '@count ' ELSE '' END || CASE WHEN reverse THEN '@reverse ' ELSE '' END
  WHEN 'float32vector' THEN 'float32vector @index(hnsw(metric:"' || metric || '")) ' || CASE WHEN upsert THEN '@upsert ' ELSE '' END
  WHEN 'list' THEN CASE WHEN reversed THEN 'uid @reverse ' ELSE '[' || list_type || '] ' END || CASE WHEN "count" THEN '@count ' ELSE '' END
  WHEN 'password' THEN 'password '
  ELSE 'string ' || CASE WHEN fulltext OR trigram OR token <> 'none' OR upsert THEN '@index(' || array_to_string(list_filter([CASE WHEN fulltext THEN 'fulltext' END, CASE WHEN trigram THEN 'trigram' END,
      CASE WHEN token <> 'none' THEN token WHEN upsert AND NOT fulltext AND NOT trigram THEN 'exact' END], lambda x: x IS NOT NULL), ', ') || ') ' ELSE '' END
    || CASE WHEN lang THEN '@lang ' ELSE '' END || CASE WHEN upsert THEN '@upsert ' ELSE '' END END || '.'"""

MERGED = """merged AS (SELECT namespace, version, predicate, arg_min(kind, type_name) AS kind, arg_min(list_type, type_name) AS list_type, arg_min(metric, type_name) AS metric,
  CASE WHEN arg_min(kind, type_name) = 'dateTime' THEN ['none', 'year', 'month', 'day', 'hour'][max(list_position(['none', 'year', 'month', 'day', 'hour'], token))]
    ELSE ['none', 'exact', 'hash', 'term'][max(list_position(['none', 'exact', 'hash', 'term'], token))] END AS token,
  bool_or(fulltext) AS fulltext, bool_or(trigram) AS trigram, bool_or(indexed) AS indexed, bool_or(upsert) AS upsert, bool_or(lang) AS lang,
  bool_or(reverse) AS reverse, bool_or("count") AS "count", bool_or(reversed) AS reversed FROM mappings GROUP BY namespace, version, predicate)"""

TYPE_LINES = """typelines AS (SELECT DISTINCT namespace, version, type_name, 1 AS part, predicate AS member, CASE WHEN reversed THEN '  <~' || predicate || '>' ELSE '  ' || predicate END AS line FROM mappings
  UNION ALL SELECT DISTINCT namespace, version, type_name, 0, '', 'type ' || type_name || ' {' FROM mappings UNION ALL SELECT DISTINCT namespace, version, type_name, 2, '', '}' FROM mappings)"""


@query("l01_schema_lines", f"WITH {MAPPINGS} SELECT namespace, version, type_name, predicate, {LINE} AS line FROM mappings")
def schema_lines(g: Graph):
    return schema.schema_lines(mappings(g))


MERGED_COLUMNS = ["namespace", "version", "predicate", "kind", "token", "fulltext", "trigram", "indexed", "upsert", "lang", "reverse", "count", "reversed"]


@query(
    "l02_merge",
    f"""WITH {MAPPINGS}, {MERGED} SELECT namespace, version, predicate, kind, token, fulltext, trigram, indexed, upsert, lang, reverse, "count", reversed FROM merged""",
)
def merge(g: Graph):
    return schema.merge(mappings(g)).select(*MERGED_COLUMNS)


@query("l03_types", f"WITH {MAPPINGS}, {TYPE_LINES} SELECT * FROM typelines")
def types(g: Graph):
    return schema.type_lines(mappings(g))


@query(
    "l04_script",
    f"""WITH {MAPPINGS}, {MERGED}, {TYPE_LINES} SELECT namespace, version, 0 AS section, '' AS name, 0 AS part, predicate AS member, {LINE} AS line FROM merged
    UNION ALL SELECT namespace, version, 1, type_name, part, member, line FROM typelines""",
)
def script(g: Graph):
    return schema.script(mappings(g))


HOST = {
    "string": "string", "binary": "string", "int": "int", "bigint": "int", "interval day to second": "int", "double": "float", "decimal(10,2)": "float",
    "timestamp": "dateTime", "date": "dateTime", "boolean": "bool", "struct<type:string,coordinates:array<double>>": "geo", "struct<uid:string>": "uid",
    "array<float>": "float32vector", "array<string>": "[string]", "array<bigint>": "[int]", "array<struct<uid:string>>": "[uid]",
    "struct<value:string,facets:map<string,string>>": "string", "array<struct<value:int,facets:map<string,string>>>": "[int]", "map<string,string>": None,
}


@query(
    "l05_type_mapping",
    "WITH h AS (SELECT [" + ", ".join(repr(k) for k in HOST) + "] AS hosts, [" + ", ".join(repr(v) if v else "NULL" for v in HOST.values()) + f"""] AS kinds)
    SELECT p_partkey, hosts[(p_partkey % {len(HOST)}) + 1] AS host, kinds[(p_partkey % {len(HOST)}) + 1] AS kind FROM part, h""",
)
def type_mapping(g: Graph):
    host = F.get(F.array(*[F.lit(h) for h in HOST]), (F.col("p_partkey") % len(HOST)).cast("int"))
    return g.raw("part").select("p_partkey", host.alias("host")).withColumn("kind", schema.graph_type(F.col("host")))


AUTO = ["customer", "orders", "lineitem", "part", "events", "documents", "embeddings"]
ENUMS = {"customer": ["c_mktsegment"], "orders": ["o_orderstatus", "o_orderpriority"], "lineitem": ["l_returnflag", "l_linestatus"], "events": ["event_type"], "documents": ["lang"]}


def _auto_sql() -> str:
    import itertools

    columns = {
        "customer": "c_custkey:int c_name:string c_nationkey:int c_acctbal:float c_mktsegment:string",
        "orders": "o_orderkey:int o_custkey:int o_orderstatus:string o_totalprice:float o_orderdate:dateTime o_orderpriority:string",
        "lineitem": "l_orderkey:int l_partkey:int l_suppkey:int l_linenumber:int l_quantity:float l_extendedprice:float l_discount:float l_tax:float l_returnflag:string l_linestatus:string l_shipdate:dateTime",
        "part": "p_partkey:int p_name:string p_brand:string p_type:string p_size:int p_retailprice:float",
        "events": "event_id:int ts:dateTime user_id:int event_type:string value:float props:string",
        "documents": "doc_id:int text:string lang:string source:string n_chars:int",
        "embeddings": "vec_id:int embedding:float32vector label:int",
    }
    parts = []
    for table, column in itertools.chain.from_iterable([(t, c) for c in text.split()] for t, text in columns.items()):
        name, kind = column.split(":")
        line = {
            "int": f"'{name}: int @index(int) .'", "float": f"'{name}: float @index(float) .'", "dateTime": f"'{name}: dateTime @index(hour) .'",
            "float32vector": f"""'{name}: float32vector @index(hnsw(metric:"Euclidean")) .'""",
            "string": f"'{name}: string @index({'exact' if name in ENUMS.get(table, ()) else 'term'}) .'",
        }[kind]
        parts.append(f"SELECT '{table}' AS type_name, '{name}' AS predicate, {line} AS line")
    return " UNION ALL ".join(parts)


@query("l06_automatic_mapping", _auto_sql())
def automatic_mapping(g: Graph):
    rows = schema.automatic_mapping({t: g.raw(t) for t in AUTO}, ENUMS)
    return schema.schema_lines(rows).select("type_name", "predicate", "line")


@query(
    "l07_reverse_errors",
    f"""WITH {MAPPINGS}, e AS (SELECT namespace, version, type_name AS target, predicate, bool_or(kind = 'uid' OR kind = 'list' AND list_type = 'uid') AS edge, bool_or(reverse) AS rev
      FROM mappings WHERE NOT reversed GROUP BY ALL)
    SELECT namespace, version, type_name, m.predicate, m.target, CASE WHEN edge IS NULL THEN 'not mapped' WHEN NOT edge THEN 'not an edge' ELSE 'not reversible' END AS error
    FROM mappings m LEFT JOIN e USING (namespace, version, target, predicate) WHERE reversed AND NOT coalesce(edge AND rev, false)""",
)
def reverse_errors(g: Graph):
    return schema.reverse_errors(mappings(g))


@query(
    "l08_diff",
    f"""WITH {MAPPINGS}, {MERGED}, l AS (SELECT namespace, version, predicate, {LINE} AS line FROM merged),
    d AS (SELECT coalesce(o.namespace, n.namespace) AS namespace, 'predicate' AS item, coalesce(o.predicate, n.predicate) AS name,
        CASE WHEN o.line IS NULL THEN 'new' WHEN n.line IS NULL THEN 'removed' WHEN o.line <> n.line THEN 'changed' END AS change
      FROM (FROM l WHERE version = 0) o FULL JOIN (FROM l WHERE version = 1) n ON o.namespace = n.namespace AND o.predicate = n.predicate),
    t AS (SELECT DISTINCT namespace, version, type_name FROM mappings)
    SELECT * FROM d WHERE change IS NOT NULL
    UNION ALL SELECT namespace, 'type', type_name, CASE WHEN min(version) = 0 THEN 'removed' ELSE 'new' END FROM t GROUP BY namespace, type_name HAVING count(*) = 1""",
)
def diff(g: Graph):
    rows = mappings(g)
    return schema.diff(rows.where("version = 0"), rows.where("version = 1"))


@query(
    "l09_profile",
    f"""WITH {FACTS}, {LOG}, a AS (SELECT namespace, predicate, subject FROM facts UNION ALL SELECT namespace, predicate, subject FROM log),
    per AS (SELECT namespace, predicate, subject, count(*) AS n FROM a GROUP BY ALL) SELECT namespace, predicate, CASE WHEN max(n) > 1 THEN 'LIST' ELSE 'SINGLE' END AS hint FROM per GROUP BY ALL""",
)
def profile(g: Graph):
    return counting.observed_types(facts(g).unionByName(g.log().select(*FACT_COLUMNS))).select("namespace", "predicate", "hint")


@query(
    "l10_schema_query",
    f"""WITH {MAPPINGS}, {MERGED}, t AS (SELECT namespace, version, predicate, CASE WHEN kind = 'list' THEN '[' || list_type || ']' ELSE kind END AS type FROM merged)
    SELECT 'all' AS asked, * FROM t UNION ALL SELECT 'some', * FROM t WHERE predicate IN ('pred_3', 'pred_7', 'pred_none')""",
)
def schema_query(g: Graph):
    merged = schema.merge(mappings(g))
    some = schema.query_schema(merged, ["pred_3", "pred_7", "pred_none"]).select(F.lit("some").alias("asked"), "*")
    return schema.query_schema(merged).select(F.lit("all").alias("asked"), "*").unionByName(some)


@query(
    "l10_schema_fields",
    f"""WITH {MAPPINGS}, {MERGED} SELECT namespace, version, predicate, indexed OR fulltext OR trigram OR token <> 'none' OR upsert AS "index",
      array_to_string(list_filter([CASE WHEN fulltext THEN 'fulltext' END, CASE WHEN trigram THEN 'trigram' END, nullif(token, 'none')], lambda x: x IS NOT NULL), ',') AS tokenizer,
      reverse OR (kind = 'list' AND reversed) AS reverse, "count", kind = 'list' AS list, upsert, lang, NULL AS type_name FROM merged
    UNION ALL SELECT DISTINCT namespace, version, predicate, NULL, NULL, NULL, NULL, NULL, NULL, NULL, type_name FROM mappings WHERE type_name IN ('ECONOMY', 'PROMO')""",
)
def schema_fields(g: Graph):
    """Every field of every predicate, and the predicates of two types."""
    rows = mappings(g)
    fields = schema.query_schema(schema.merge(rows), fields=["index", "tokenizer", "reverse", "count", "list", "upsert", "lang"])
    types = schema.query_types(rows, ["ECONOMY", "PROMO"])
    return fields.unionByName(types, allowMissingColumns=True)


NAMES = """names AS (SELECT event_id, upper(left(event_type, 1)) || substr(event_type, 2) || event_id AS good, strftime(ts, '%Y%m%d%H%M%S') AS stamp,
  date_trunc('second', ts)::TIMESTAMP AS generated_at, cast(user_id % 5 AS BIGINT) AS namespace FROM events)"""


def migration_names(g: Graph):
    return g.raw("events").select(
        "event_id", F.concat(F.initcap("event_type"), F.col("event_id").cast("string")).alias("good"),
        F.date_format("ts", "yyyyMMddHHmmss").alias("stamp"), (F.col("user_id") % 5).cast("long").alias("namespace"),
    )


@query(
    "l11_migration_names",
    f"""WITH {NAMES} SELECT good || '_' || stamp AS text, good AS name, generated_at FROM names
    UNION ALL SELECT lower(good) || '_' || stamp, NULL, NULL FROM names UNION ALL SELECT good || '-x_' || stamp, NULL, NULL FROM names
    UNION ALL SELECT good || '_' || left(stamp, 4) || '13' || substr(stamp, 7), NULL, NULL FROM names""",
)
def names(g: Graph):
    good, stamp = F.col("good"), F.col("stamp")
    texts = migration_names(g).select(F.explode(F.array(
        F.concat_ws("_", good, stamp), F.concat_ws("_", F.lower(good), stamp), F.concat(good, F.lit("-x_"), stamp),
        F.concat(good, F.lit("_"), F.substring(stamp, 1, 4), F.lit("13"), F.substring(stamp, 7, 8)),
    )).alias("text"))
    parsed = texts.withColumn("m", schema.parse_migration_name(F.col("text")))
    return parsed.select("text", "m.name", "m.generated_at")


@query(
    "l12_pending",
    f"""WITH {NAMES}, ledger AS (SELECT * FROM names WHERE event_id < (SELECT max(event_id) FROM events) * (namespace + 3) / 10 AND namespace < 4),
    m AS (SELECT namespace, max(generated_at) AS last FROM ledger GROUP BY namespace)
    SELECT namespace, good AS name, generated_at FROM names LEFT JOIN m USING (namespace) WHERE (last IS NULL OR generated_at > last) AND (namespace, good) NOT IN (SELECT (namespace, good) FROM ledger)""",
)
def pending(g: Graph):
    """Tenants have applied different shares of the migrations, one of them none."""
    rows = migration_names(g)
    last = g.raw("events").agg(F.max("event_id")).scalar()
    parsed = rows.withColumn("m", schema.parse_migration_name(F.concat_ws("_", "good", "stamp"))).select("event_id", "namespace", "m.name", "m.generated_at")
    ledger = parsed.where((F.col("event_id") < last * (F.col("namespace") + 3) / 10) & (F.col("namespace") < 4))
    return schema.pending(parsed, ledger).select("namespace", "name", "generated_at")


@query(
    "l13_migrate",
    f"""WITH {FACTS}, kept AS (SELECT * FROM facts WHERE NOT (predicate = 'o_orderpriority' AND namespace IN (1, 2)) AND NOT (predicate = 'o_totalprice' AND namespace = 2))
    SELECT namespace, 'fact' AS part, predicate AS name, subject, coalesce(value, object_uid::VARCHAR) AS detail FROM kept
    UNION ALL SELECT n, 'type', t, 0, p FROM (VALUES ('Order', 'placed_by'), ('Order', 'o_orderstatus')) t(t, p), (VALUES (0::BIGINT), (1), (2)) n(n)
    UNION ALL SELECT * FROM (VALUES (0::BIGINT, 'type', 'Order', 0::BIGINT, 'o_orderpriority'), (0, 'type', 'Legacy', 0, 'placed_by'), (1, 'type', 'Order', 0, 'note'), (2, 'type', 'Order', 0, 'note')) t
    UNION ALL SELECT * FROM (VALUES (1::BIGINT, 'ledger', 'First', 0::BIGINT, '2024-03-11 09:45:00'), (2, 'ledger', 'First', 0, '2024-03-11 09:45:00'),
      (1, 'ledger', 'Second', 0, '2024-04-02 18:20:30'), (2, 'ledger', 'Second', 0, '2024-04-02 18:20:30'), (1, 'removed', 'First', 0, '2024-03-11 09:45:00'),
      (2, 'removed', 'First', 0, '2024-03-11 09:45:00'), (2, 'removed', 'Second', 0, '2024-04-02 18:20:30')) t""",
)
def migrate(g: Graph):
    """Two of three tenants migrate. Tenant 1 knows First already, tenant 2 does not; Second drops
    a predicate with its values and a type; a later removal in tenant 1 takes Second back out
    of its ledger, its dropped values stay gone."""
    rows = facts(g)
    spark = g.spark
    pairs = [("Order", "placed_by"), ("Order", "o_orderstatus"), ("Order", "o_orderpriority"), ("Legacy", "placed_by")]
    types_ = spark.createDataFrame([(n, *p) for n in range(3) for p in pairs], "namespace long, type_name string, predicate string")
    applied = F.lit("2024-03-11 09:45:00").cast("timestamp_ntz")
    ledger = spark.range(1, 2).select(F.col("id").alias("namespace"), F.lit("First").alias("name"), applied.alias("generated_at"), applied.alias("applied_at"))
    first = Migration("First", "2024-03-11 09:45:00", Step(drop_predicates=["o_totalprice"]), Step())
    second = Migration("Second", "2024-04-02 18:20:30", Step(drop_types=["Legacy"], drop_predicates=["o_orderpriority"], set_types=[("Order", "note")]), Step(drop_types=["Order"]))
    store = Store(rows, types_, ledger)
    for m in (first, second):
        store = schema.migrate(store, m, applied_at="2024-05-01 00:00:00", tenants=[1, 2])
    removed = schema.remove_migration(store, [first, second], "Second", tenants=[1])

    def part(name, df, *columns):
        return df.select("namespace", F.lit(name).alias("part"), *[c.alias(a) for c, a in zip(columns, ("name", "subject", "detail"))])

    zero = F.lit(0).cast("long")
    when = F.date_format("generated_at", "yyyy-MM-dd HH:mm:ss")
    out = part("fact", store.facts, F.col("predicate"), F.col("subject"), F.coalesce("value", F.col("object_uid").cast("string")))
    out = out.unionByName(part("type", store.types, F.col("type_name"), zero, F.col("predicate")))
    out = out.unionByName(part("ledger", store.ledger, F.col("name"), zero, when))
    return out.unionByName(part("removed", removed.ledger, F.col("name"), zero, when))
