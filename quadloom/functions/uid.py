"""Node identifiers as column expressions.

Text form: `0x` + 1-16 hex digits (concrete) or `_:` + 1-32 word characters (blank),
each bracket optional and independent. Inside the engine a uid is a BIGINT that holds all 64
bits (uids above 2^63-1 are negative there); only 0 is refused. Order unsigned where numeric
order is asked: `unsigned_order`.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the grammar of a uid text.
UID_PATTERN = r"^(<)?(0x[a-fA-F0-9]{1,16}|_:[a-zA-Z0-9_]{1,32})(>)?$"


def is_valid(text: Column) -> Column:
    return F.coalesce(text.rlike(UID_PATTERN), F.lit(False))


def normalise(text: Column) -> Column:
    """Brackets off, lower case (blank labels too, so `_:A` and `_:a` are one); null if invalid."""
    return F.when(text.rlike(UID_PATTERN), F.lower(F.translate(text, "<>", "")))


def classify(text: Column) -> Column:
    body = normalise(text)
    return (
        F.when(text.isNull() | (text == ""), F.lit("empty"))
        .when(body.isNull(), F.lit("invalid"))
        .when(body.startswith("0x"), F.lit("concrete"))
        .otherwise(F.lit("blank"))
    )


def is_concrete(text: Column) -> Column:
    return classify(text) == "concrete"


def to_unsigned(text: Column) -> Column:
    """Concrete text to DECIMAL(20,0), the full unsigned 64-bit range; zero and
    non-concrete text give null."""
    body = normalise(text)
    number = F.conv(F.substring(body, 3, 16), 16, 10).cast("decimal(20,0)")
    return F.when(body.startswith("0x") & (number > 0), number)


def to_long(text: Column) -> Column:
    """Concrete text to the 64 bits of a BIGINT; zero and non-concrete text give null."""
    body = normalise(text)
    number = F.conv(F.substring(body, 3, 16), 16, -10).try_cast("bigint")
    return F.when(body.startswith("0x") & (number != 0), number)


def to_text(number: Column) -> Column:
    """The 64 bits of a BIGINT as lower-case hex text; zero is refused as null."""
    return F.when(number != 0, F.concat(F.lit("0x"), F.lower(F.hex(number.cast("long")))))


def unsigned_order(number: Column) -> Column:
    """A BIGINT that sorts and compares as the unsigned reading of `number` does."""
    return number.cast("long").bitwiseXOR(F.lit(-(2**63)))


def in_nquad(text: Column) -> Column:
    """Concrete uids in angle brackets, blank ones bare."""
    return F.when(text.startswith("0x"), F.concat(F.lit("<"), text, F.lit(">"))).otherwise(text)


def blank_label(key: Column) -> Column:
    """A blank label that is the same on every attempt: 32 hex digits of a digest of the key."""
    return F.concat(F.lit("_:"), F.substring(F.sha2(key.cast("string"), 256), 1, 32))
