"""Value conversions as column expressions: JSON literals, timestamps, vectors, flags,
enums, geo. All run inside generated code or built-in expressions; no Python per row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# RFC 3339 with milliseconds and Z, the round-trip parameter form (seven
# fraction digits), the date form, and 100 ns ticks.
RFC3339 = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ROUND_TRIP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0'"
DAY = "yyyy-MM-dd"
TICKS_PER_MICROSECOND = 10


# JSON literals ---------------------------------------------------------------
def json_literal(value: Column) -> Column:
    """JSON text of one value of any type; null stays null."""
    body = F.to_json(F.struct(value.alias("v")))
    return F.when(value.isNotNull(), F.substr(body, F.lit(6), F.length(body) - 6))


def text_literal(text: Column) -> Column:
    """A string as a JSON literal; only texts that need an escape go through the JSON writer."""
    plain = F.concat(F.lit('"'), text, F.lit('"'))
    return F.when(text.rlike(r'["\\\x00-\x1f]'), json_literal(text)).otherwise(plain)


def decode_literal(literal: Column) -> Column:
    """The plain text of a JSON literal: quotes and escapes undone, the rest as written.
    Only literals with a backslash go through the JSON parser."""
    escaped = F.from_json(F.concat(F.lit("["), literal, F.lit("]")), "array<string>")
    return (
        F.when(~literal.startswith('"'), literal)
        .when(literal.contains("\\"), F.try_element_at(escaped, F.lit(1)))
        .otherwise(F.substr(literal, F.lit(2), F.length(literal) - 2))
    )


def typed_literal(text: Column, value_type: Column) -> Column:
    """A stored value as a literal: numbers and booleans bare, everything else quoted."""
    return F.when(value_type.isin("int", "float", "bool"), text).otherwise(text_literal(text))


# parameters ------------------------------------------------------------------
def parameter_text(value: Column, data_type: T.DataType) -> Column:
    """Text form of a query parameter, by the Spark type of the column."""
    if isinstance(data_type, T.ArrayType):
        inner = data_type.elementType
        if isinstance(inner, T.FloatType):
            return format_vector(value)
        return F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: parameter_text(x, inner)), ","), F.lit("]"))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, ROUND_TRIP)
    if isinstance(data_type, T.DateType):
        return F.date_format(value, DAY)
    if isinstance(data_type, T.StringType):
        return F.replace(value, F.lit('"'), F.lit('\\"'))
    return value.cast("string")


# timestamps ------------------------------------------------------------------
def to_rfc3339(ts: Column) -> Column:
    """A time without zone counts as UTC, a date as its midnight."""
    return F.date_format(ts.cast("timestamp"), RFC3339)


def zoned_to_rfc3339(wall_clock: Column, zone: Column | str) -> Column:
    """A wall-clock time in `zone`, moved to UTC."""
    return F.date_format(F.to_utc_timestamp(wall_clock, zone), RFC3339)


def parse_timestamp(text: Column) -> Column:
    """Lenient: text that does not parse gives null, never an error."""
    return text.try_cast("timestamp")


def date_bucket(ts: Column, unit: str, data_type: T.DataType | None = None) -> Column:
    """Start of the year / month / day / hour; a date is never cut finer than its day."""
    if isinstance(data_type, T.DateType) and unit == "hour":
        unit = "day"
    return F.date_trunc(unit, ts)


def ticks_to_micros(ticks: Column) -> Column:
    return F.call_function("div", ticks, F.lit(TICKS_PER_MICROSECOND).cast("long"))


def micros_to_ticks(micros: Column) -> Column:
    return micros * F.lit(TICKS_PER_MICROSECOND)


def ticks_to_time_text(ticks: Column) -> Column:
    """Time of day of a tick count as HH:mm:ss.ffffff."""
    return F.date_format(F.timestamp_micros(ticks_to_micros(ticks)), "HH:mm:ss.SSSSSS")


# bytes and vectors -----------------------------------------------------------
def bytes_to_text(data: Column) -> Column:
    """Base64 in one line; some Spark settings break it every 76 characters."""
    return F.replace(F.base64(data), F.lit("\r\n"), F.lit(""))


def text_to_bytes(text: Column) -> Column:
    return F.try_to_binary(text, F.lit("base64"))


def format_vector(vector: Column) -> Column:
    """`[a b c]`, blank separated."""
    return F.concat(F.lit("["), F.array_join(vector.cast("array<string>"), " "), F.lit("]"))


def parse_vector(text: Column) -> Column:
    """`[a b c]` to ARRAY<FLOAT>; text that is no vector gives null."""
    inner = F.trim(F.regexp_extract(text, r"^\s*\[([^\[\]]*)\]\s*$", 1))
    parts = F.filter(F.split(inner, r"\s+"), lambda x: x != "")
    numbers = F.transform(parts, lambda x: x.try_cast("float"))
    return F.when((F.size(parts) > 0) & ~F.exists(numbers, lambda x: x.isNull()), numbers)


# flags and enums -------------------------------------------------------------
def flag_members(value: Column, members: dict[str, int]) -> Column:
    """Names of the members whose bits are all set; a zero member is always one."""
    return F.array_compact(
        F.array(*[F.when(value.bitwiseAND(F.lit(bit)) == bit, F.lit(name)) for name, bit in members.items()])
    )


def flags_value(names: Column, members: dict[str, int]) -> Column:
    """Member names back to the number: the bits of the distinct members together."""
    bits = enum_map({name: bit for name, bit in members.items()})
    return F.aggregate(
        names, F.lit(0), lambda acc, n: acc.bitwiseOR(F.coalesce(F.try_element_at(bits, F.lower(n)), F.lit(0)))
    )


def enum_map(members: dict[str, int]) -> Column:
    cells = [c for name, number in members.items() for c in (F.lit(name.lower()), F.lit(number))]
    return F.create_map(*cells)


def enum_number(name: Column, members: dict[str, int]) -> Column:
    """Number of a member name in any case; null for an unknown name."""
    return F.try_element_at(enum_map(members), F.lower(name))


def enum_name(number: Column, members: dict[str, int]) -> Column:
    names = F.create_map(*[c for name, n in members.items() for c in (F.lit(n), F.lit(name))])
    return F.try_element_at(names, number)


# coercion --------------------------------------------------------------------
# Shape tests before the casts: a failing cast raises and catches an error per row.
_INT = r"^\s*[+-]?\d{1,19}\s*$"
_FLOAT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_int(text: Column) -> Column:
    return F.when(text.rlike(_INT), text.try_cast("bigint"))


def to_float(text: Column) -> Column:
    return F.when(text.rlike(_FLOAT), text.try_cast("double"))


def to_bool(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def is_int(text: Column) -> Column:
    return F.coalesce(text.rlike(_INT), F.lit(False)) & to_int(text).isNotNull()


def is_float(text: Column) -> Column:
    return F.coalesce(text.rlike(_FLOAT), F.lit(False))


def is_bool(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)).isin("true", "false"), F.lit(False))


def is_time(text: Column) -> Column:
    return text.try_cast("timestamp").isNotNull()


def coerce(text: Column, value_type: str) -> Column:
    """Text to the Spark type of a schema type; unparsable text leaves the value unset."""
    casts = {"int": to_int, "float": to_float, "bool": to_bool, "dateTime": parse_timestamp, "float32vector": parse_vector}
    return casts.get(value_type, lambda t: t)(text)


def conforms(text: Column, value_type: Column) -> Column:
    """Does the text parse as the type named in another column?"""
    return (
        F.when(value_type == "int", is_int(text))
        .when(value_type == "float", is_float(text))
        .when(value_type == "bool", is_bool(text))
        .when(value_type == "dateTime", is_time(text))
        .when(value_type == "float32vector", parse_vector(text).isNotNull())
        .when(value_type == "geo", F.get_json_object(text, "$.type").isNotNull())
        .otherwise(text.isNotNull())
    )


def literal_of(value: Column, data_type: T.DataType) -> Column:
    """Literal per type: booleans in lower case, times to the second with Z, numbers bare,
    everything else quoted; null as `null`."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        text = json_literal(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    elif isinstance(data_type, (T.BooleanType, T.FloatType, T.DoubleType, T.IntegerType)):
        text = value.cast("string")
    else:
        text = json_literal(value.cast("string"))
    return F.coalesce(text, F.lit("null"))


# geo -------------------------------------------------------------------------
POINT = "type string, coordinates array<double>"
MULTIPOINT = "type string, coordinates array<array<double>>"


def point_to_geojson(lon: Column, lat: Column) -> Column:
    return F.to_json(F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")))


def multipoint_to_geojson(points: Column) -> Column:
    """`points` is an array of [lon, lat] arrays."""
    return F.to_json(F.struct(F.lit("MultiPoint").alias("type"), points.alias("coordinates")))


def geojson_points(text: Column) -> Column:
    """Coordinates of a Point or MultiPoint as an array of [lon, lat] arrays, else null."""
    kind = F.get_json_object(text, "$.type")
    one = F.from_json(text, POINT)["coordinates"]
    many = F.from_json(text, MULTIPOINT)["coordinates"]
    return F.when(kind == "Point", F.array(one)).when(kind == "MultiPoint", many)


# passwords -------------------------------------------------------------------
def store_password(text: Column, salt: Column, rounds: int = 64) -> Column:
    """`rounds$salt$digest`: a salted digest, applied over and over so that guessing is dear.
    The salt should differ per row, such as a digest of the node's uid and a secret."""
    body = F.sha2(F.concat(salt, text), 256)
    steps = F.sequence(F.lit(2), F.lit(rounds))
    digest = F.aggregate(steps, body, lambda d, _: F.sha2(F.concat(salt, d), 256))
    return F.when(text.isNotNull(), F.concat_ws("$", F.lit(str(rounds)), salt, digest))


def password_matches(stored: Column, text: Column) -> Column:
    """Whether `text` is the password behind a stored digest."""
    rounds = F.split_part(stored, F.lit("$"), F.lit(1)).cast("int")
    salt = F.split_part(stored, F.lit("$"), F.lit(2))
    start = F.sha2(F.concat(salt, text), 256)
    digest = F.aggregate(F.sequence(F.lit(2), rounds), start, lambda d, _: F.sha2(F.concat(salt, d), 256))
    return digest == F.split_part(stored, F.lit("$"), F.lit(3))


def readable(columns: list[str], value_types: dict[str, str]) -> list[str]:
    """Columns a read may return: password columns never are."""
    return [c for c in columns if value_types.get(c) != "password"]
