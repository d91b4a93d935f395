"""Tokens of texts. Whole texts, split by built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: what separates terms.
SEPARATOR = r"[^\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    """Distinct lower-case terms."""
    return F.array_distinct(F.filter(F.split(F.lower(text), SEPARATOR), lambda t: t != ""))


def trigrams(text: Column) -> Column:
    """Distinct three-character pieces of the raw text; none below three characters."""
    pieces = F.transform(  # the letters are bound once, so the work is linear in the text
        F.array(F.split(text, "")),
        lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - 3), lambda i: F.concat(F.get(c, i), F.get(c, i + 1), F.get(c, i + 2))),
    )
    return F.when(F.length(text) > 2, F.array_distinct(F.get(pieces, F.lit(0)))).otherwise(F.array().cast("array<string>"))
