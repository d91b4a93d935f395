"""Scalar conversions, each run over a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom.catalog.common import K, query, u
from quadloom.functions import values as v
from quadloom.plans.spread import spread_out
from quadloom.sources.tables import Graph

CUST = u("Customer", "c_custkey")
FLAGS = {"Nothing": 0, "Round": 1, "Red": 2, "Large": 4, "New": 8, "Rare": 16}
PRIORITIES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}
LON, LAT = "cast((c_custkey * 37) % 360 - 180 AS DOUBLE)", "cast((c_custkey * 17) % 180 - 90 AS DOUBLE)"


@query(
    "j01_parameter_text",
    """SELECT event_id, event_id::VARCHAR AS int_text, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0' AS ts_text, strftime(ts, '%Y-%m-%d') AS date_text,
      value::VARCHAR AS float_text, CASE WHEN value > 10 THEN 'true' ELSE 'false' END AS bool_text, replace(props, '"', '\\"') AS str_text,
      '[' || event_type || ',' || user_id || ']' AS list_text, '[[' || event_id || ',' || user_id || '],[7]]' AS nested_text FROM events""",
)
def parameter_text(g: Graph):
    rows = g.raw("events").select(
        "event_id", "ts", F.col("ts").cast("date").alias("day"), "value", (F.col("value") > 10).alias("flag"), "props",
        F.array("event_type", F.col("user_id").cast("string")).alias("items"),
        F.array(F.array("event_id", "user_id"), F.array(F.lit(7).cast("long"))).alias("nested"),
    )
    names = {"event_id": "int_text", "ts": "ts_text", "day": "date_text", "value": "float_text", "flag": "bool_text",
             "props": "str_text", "items": "list_text", "nested": "nested_text"}
    return rows.select("event_id", *[v.parameter_text(F.col(c), rows.schema[c].dataType).alias(a) for c, a in names.items()])


@query(
    "j02_rfc3339",
    """SELECT event_id, left(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), 23) || 'Z' AS utc, strftime(ts, '%Y-%m-%d') || 'T00:00:00.000Z' AS midnight,
      left(strftime(ts - INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S.%f'), 23) || 'Z' AS from_local FROM events""",
)
def rfc3339(g: Graph):
    ts = F.col("ts")
    return g.raw("events").select(
        "event_id", v.to_rfc3339(ts).alias("utc"), v.to_rfc3339(ts.cast("date")).alias("midnight"),
        v.zoned_to_rfc3339(ts.cast("timestamp"), "+05:30").alias("from_local"),
    )


@query(
    "j03_lenient_time",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') AS good, strftime(ts, '%Y-%m-%dT00:00:00.000Z') AS day, NULL::VARCHAR AS bad_text, NULL::VARCHAR AS bad_day FROM events""",
)
def lenient_time(g: Graph):
    text = {
        "good": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "day": F.date_format("ts", "yyyy-MM-dd"),
        "bad_text": F.col("event_type"), "bad_day": F.concat(F.date_format("ts", "yyyy"), F.lit("-13-45")),
    }
    return g.raw("events").select("event_id", *[v.to_rfc3339(v.parse_timestamp(t)).alias(n) for n, t in text.items()])


@query(
    "j04_date_bucket",
    """SELECT date_trunc('year', ts)::TIMESTAMP AS y, date_trunc('month', ts)::TIMESTAMP AS m, date_trunc('day', ts)::TIMESTAMP AS d, date_trunc('hour', ts)::TIMESTAMP AS h,
      date_trunc('day', ts)::TIMESTAMP AS capped, count(*) AS n FROM events GROUP BY ALL""",
)
def date_bucket(g: Graph):
    from pyspark.sql import types as T

    ts, day = F.col("ts"), F.col("ts").cast("date")
    rows = g.raw("events").select(
        *[v.date_bucket(ts, unit).cast("timestamp_ntz").alias(unit[0]) for unit in ("year", "month", "day", "hour")],
        v.date_bucket(day, "hour", T.DateType()).cast("timestamp_ntz").alias("capped"),
    )
    return rows.groupBy("y", "m", "d", "h", "capped").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j05_ticks",
    """SELECT event_id, (event_id * 123456789) // 10 AS micros, ((event_id * 123456789) // 10) * 10 AS ticks, strftime(make_timestamp((event_id * 123456789) // 10), '%H:%M:%S.%f') AS clock FROM events""",
)
def ticks(g: Graph):
    t = F.col("event_id") * 123456789
    return g.raw("events").select(
        "event_id", v.ticks_to_micros(t).alias("micros"), v.micros_to_ticks(v.ticks_to_micros(t)).alias("ticks"), v.ticks_to_time_text(t).alias("clock")
    )


@query("j06_base64", "SELECT doc_id, base64(encode(text)) AS coded, text AS back FROM documents")
def base64(g: Graph):
    coded = v.bytes_to_text(F.col("text").cast("binary"))
    return g.raw("documents").select("doc_id", coded.alias("coded"), v.text_to_bytes(coded).cast("string").alias("back"))


@query(
    "j07_vector_text",
    f"""SELECT event_id AS id, round(({K})::FLOAT::DOUBLE, 4) AS a, round(value::FLOAT::DOUBLE, 4) AS b, 0.5::DOUBLE AS c, true AS same, true AS bad_is_null FROM events
    UNION ALL SELECT vec_id, round(embedding[1]::DOUBLE, 4), round(embedding[2]::DOUBLE, 4), round(embedding[3]::DOUBLE, 4), true, true FROM embeddings""",
)
def vector_text(g: Graph):
    events = g.events().select(
        F.col("event_id").alias("id"), F.concat_ws(" ", F.lit("[") , "k", "value", F.lit("0.5]")).alias("text"),
        F.array(F.col("k").cast("float"), F.col("value").cast("float"), F.lit(0.5).cast("float")).alias("vec"),
    )
    stored = g.raw("embeddings").select(F.col("vec_id").alias("id"), v.format_vector(F.col("embedding")).alias("text"), F.col("embedding").alias("vec"))
    parsed = v.parse_vector(F.col("text"))
    item = lambda i: F.round(F.get(parsed, F.lit(i)).cast("double"), 4)
    return events.unionByName(stored).select(
        "id", item(0).alias("a"), item(1).alias("b"), item(2).alias("c"), (parsed == F.col("vec")).alias("same"),
        v.parse_vector(F.concat(F.lit("[x "), F.col("id").cast("string"), F.lit("]"))).isNull().alias("bad_is_null"),
    )


@query(
    "j08_flags",
    """SELECT p_partkey, 'Nothing' || CASE WHEN p_size & 1 = 1 THEN ',Round' ELSE '' END || CASE WHEN p_size & 2 = 2 THEN ',Red' ELSE '' END || CASE WHEN p_size & 4 = 4 THEN ',Large' ELSE '' END
      || CASE WHEN p_size & 8 = 8 THEN ',New' ELSE '' END || CASE WHEN p_size & 16 = 16 THEN ',Rare' ELSE '' END AS names, (p_size & 31)::INTEGER AS number FROM part""",
)
def flags(g: Graph):
    names = v.flag_members(F.col("p_size").bitwiseAND(F.lit(31)), FLAGS)
    return g.raw("part").select("p_partkey", F.array_join(names, ",").alias("names"), v.flags_value(names, FLAGS).alias("number"))


@query(
    "j09_enum",
    """SELECT o_orderkey, cast(left(o_orderpriority, 1) AS INTEGER) AS number, o_orderpriority AS name, NULL::INTEGER AS unknown FROM orders""",
)
def enum(g: Graph):
    number = v.enum_number(F.lower("o_orderpriority"), PRIORITIES)
    return g.raw("orders").select(
        "o_orderkey", number.alias("number"), v.enum_name(number, PRIORITIES).alias("name"), v.enum_number(F.col("o_orderstatus"), PRIORITIES).alias("unknown")
    )


@query(
    "j10_literals",
    """SELECT event_id, CASE WHEN value > 10 THEN 'true' ELSE 'false' END AS flag, '"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '"' AS at, value::VARCHAR AS number,
      '"' || user_id || '"' AS big, '"' || replace(props, '"', '\\"') || '"' AS props, 'null' AS nothing FROM events""",
)
def literals(g: Graph):
    rows = g.raw("events").select(
        "event_id", (F.col("value") > 10).alias("flag"), F.col("ts").alias("at"), F.col("value").alias("number"),
        F.col("user_id").alias("big"), "props", F.lit(None).cast("string").alias("nothing"),
    )
    return rows.select("event_id", *[v.literal_of(F.col(f.name), f.dataType).alias(f.name) for f in rows.schema if f.name != "event_id"])


@query(
    "j11_coercion",
    f"""WITH t AS (SELECT event_id, unnest([json_extract_string(props, '$.k'), value::VARCHAR, 'True', event_type, '', '1.5f', ' 7 ']) AS text FROM events)
    SELECT event_id, text, CASE WHEN regexp_full_match(trim(text), '[0-9]+') THEN trim(text)::BIGINT END AS as_int,
      CASE WHEN regexp_full_match(trim(text), '[0-9]+([.][0-9]+)?') THEN trim(text)::DOUBLE END AS as_float, CASE WHEN text = 'True' THEN true END AS as_bool FROM t""",
)
def coercion(g: Graph):
    rows = spread_out(g.raw("events"), "event_id").select("event_id", F.explode(F.array(
        F.get_json_object("props", "$.k"), F.col("value").cast("string"), F.lit("True"), F.col("event_type"), F.lit(""), F.lit("1.5f"), F.lit(" 7 "),
    )).alias("text"))
    text = F.col("text")
    return rows.select("event_id", "text", v.coerce(text, "int").alias("as_int"), v.coerce(text, "float").alias("as_float"), v.coerce(text, "bool").alias("as_bool"))


@query(
    "j12_geojson",
    f"""SELECT c_custkey, '{{"type":"Point","coordinates":[' || {LON} || ',' || {LAT} || ']}}' AS point,
      '{{"type":"MultiPoint","coordinates":[[' || {LON} || ',' || {LAT} || '],[1.1,2.0]]}}' AS many, 1::INTEGER AS n_one, 2::INTEGER AS n_many, {LON} AS lon, {LAT} AS lat FROM customer""",
)
def geojson(g: Graph):
    lon, lat = F.expr(LON), F.expr(LAT)
    point = v.point_to_geojson(lon, lat)
    many = v.multipoint_to_geojson(F.array(F.array(lon, lat), F.array(F.lit(1.1), F.lit(2.0))))
    back = v.geojson_points(point)
    return g.raw("customer").select(
        "c_custkey", point.alias("point"), many.alias("many"), F.size(back).alias("n_one"), F.size(v.geojson_points(many)).alias("n_many"),
        back[0][0].alias("lon"), back[0][1].alias("lat"),
    )


@query(
    "j13_password",
    f"""WITH s AS (SELECT {CUST} AS uid, c_name, sha256('pepper' || {CUST}) AS salt FROM customer)
    SELECT uid, c_name, '2$' || salt || '$' || sha256(salt || sha256(salt || c_name)) AS secret, 'uid c_name' AS readable, true AS matches, false AS wrong FROM s""",
)
def password(g: Graph):
    """Stored as a salted, repeated digest, and left out of what a read returns."""
    salt = F.sha2(F.concat(F.lit("pepper"), F.col("uid").cast("string")), 256)
    stored = g.customer().select("uid", "c_name", v.store_password(F.col("c_name"), salt, rounds=2).alias("secret"))
    return stored.select(
        "*", F.lit(" ".join(v.readable(stored.columns, {"secret": "password"}))).alias("readable"),
        v.password_matches(F.col("secret"), F.col("c_name")).alias("matches"), v.password_matches(F.col("secret"), F.lit("guess")).alias("wrong"),
    )


@query(
    "j14_json_values",
    """SELECT o_orderkey, '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS list, '{"status":"' || o_orderstatus || '","total":' || o_totalprice || '}' AS nested FROM orders""",
)
def json_values(g: Graph):
    return g.raw("orders").select(
        "o_orderkey", F.to_json(F.array("o_orderstatus", "o_orderpriority")).alias("list"),
        F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"), F.lit(None).cast("string").alias("none"))).alias("nested"),
    )
