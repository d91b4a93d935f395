"""Index plans for regular expressions: what a pattern requires, as a formula of trigrams.

A pattern is read once and turned into AND and OR of three-character pieces that every match must
contain, whatever its alternatives, groups, classes and repetitions are. The formula of many patterns
is evaluated in one pass over the stored index: an index row sets a bit, rows are folded per node by
`bit_or`, and the formula is a test of bits. What holds is rechecked with the pattern itself.

Index and formulas hold ASCII letters in small form, so one index serves exact patterns and those that
ignore case. Where nothing is certain the formula is ALL, and every row is rechecked.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from quadloom.functions import text as tx
from quadloom.operators.roots import to_java_pattern

#: A formula is a trigram, or ("and" | "or", set of formulas). No requirement is an empty AND.
Formula = str | tuple
ALL: Formula = ("and", frozenset())
#: Strings a set may list, trigrams of one AND and parts of one OR; beyond them less is required.
STRINGS, PARTS = 16, 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)


def all_of(*parts: Formula) -> Formula:
    flat = frozenset(itertools.chain.from_iterable(p[1] if isinstance(p, tuple) and p[0] == "and" else [p] for p in parts))
    if len(flat) == 1:
        return next(iter(flat))
    return ("and", frozenset(sorted(flat, key=str)[:PARTS]))


def any_of(*parts: Formula) -> Formula:
    flat = frozenset(itertools.chain.from_iterable(p[1] if isinstance(p, tuple) and p[0] == "or" else [p] for p in parts))
    if ALL in flat or not flat or len(flat) > PARTS:
        return ALL
    return next(iter(flat)) if len(flat) == 1 else ("or", flat)


def of_strings(strings: Iterable[str]) -> Formula:
    """One of the strings occurs."""
    return any_of(*[all_of(*[s[i : i + 3] for i in range(len(s) - 2)]) for s in strings])


class Found(NamedTuple):
    """What is known of the text a part of a pattern matches: the strings it may be (None if
    they are too many), strings one of which it starts and ends with, and what it contains."""

    exact: frozenset | None
    starts: frozenset
    ends: frozenset
    needs: Formula


EMPTY = Found(frozenset([""]), frozenset([""]), frozenset([""]), ALL)
ANYTHING = Found(None, frozenset([""]), frozenset([""]), ALL)


def one_of(strings: Iterable[str]) -> Found:
    strings = frozenset(strings)
    return Found(strings, strings, strings, ALL)


def _edges(strings: frozenset, end: bool) -> frozenset:
    """Two characters of each string are enough for the trigrams across a joint; fewer where
    they would be too many."""
    for n in (2, 1, 0):
        cut = frozenset((s[-n:] if end else s[:n]) if n else "" for s in strings)
        if len(cut) <= STRINGS:
            return cut
    return frozenset([""])


def loosened(x: Found) -> Found:
    """Without the list of strings: what they have in common becomes a requirement."""
    if x.exact is None:
        needs = all_of(x.needs, of_strings(x.starts), of_strings(x.ends))
        return Found(None, _edges(x.starts, False), _edges(x.ends, True), needs)
    return Found(None, _edges(x.exact, False), _edges(x.exact, True), all_of(x.needs, of_strings(x.exact)))


def joined(x: Found, y: Found) -> Found:
    if x.exact is not None and y.exact is not None and len(x.exact) * len(y.exact) <= STRINGS:
        return one_of(a + b for a in x.exact for b in y.exact)
    cross = lambda left, right: frozenset(a + b for a in left for b in right)
    starts = cross(x.exact, y.starts) if x.exact is not None and len(x.exact) * len(y.starts) <= STRINGS else x.starts
    ends = cross(x.ends, y.exact) if y.exact is not None and len(y.exact) * len(x.ends) <= STRINGS else y.ends
    a, b = loosened(x), loosened(y)
    middle = of_strings(cross(a.ends, b.starts)) if len(a.ends) * len(b.starts) <= PARTS else ALL
    return loosened(Found(None, starts, ends, all_of(a.needs, b.needs, middle)))


def either(x: Found, y: Found) -> Found:
    if x.exact is not None and y.exact is not None and len(x.exact | y.exact) <= STRINGS:
        return one_of(x.exact | y.exact)
    a, b = loosened(x), loosened(y)
    return Found(None, a.starts | b.starts, a.ends | b.ends, any_of(a.needs, b.needs))


def repeated(x: Found, least: int, most: int | None) -> Found:
    if most == 0:
        return EMPTY
    if least == 0:
        return either(x, EMPTY) if most == 1 else ANYTHING
    times = min(least, 8)
    whole = reduce(joined, [x] * times)
    if most == least == times:
        return whole
    # more of the same may follow: what it starts with and needs stays, its end is that of one turn
    a, last = loosened(whole), loosened(x)
    return Found(None, a.starts, last.ends, a.needs)


class Unclear(Exception):
    """A construct that may change the meaning of what follows."""


class Reader:
    """Reads a pattern as `rlike` does, so far as needed to know what it must contain."""

    ZERO_WIDTH = "bBAzZG"
    CLASSES = "DwWsShHvVRX"
    CONTROL = {"t": "\t", "n": "\n", "r": "\r", "f": "\f", "a": "\a", "e": "\x1b"}

    def __init__(self, pattern: str):
        self.text, self.at = pattern, 0

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self, n: int = 1) -> str:
        out = self.text[self.at : self.at + n]
        if len(out) < n:
            raise Unclear
        self.at += n
        return out

    def whole(self) -> Found:
        out = self.choice()
        if self.at < len(self.text):
            raise Unclear
        return out

    def choice(self) -> Found:
        out = self.sequence()
        while self.peek() == "|":
            self.take()
            out = either(out, self.sequence())
        return out

    def sequence(self) -> Found:
        out = EMPTY
        while self.peek() and self.peek() not in "|)":
            out = joined(out, self.counted(self.atom()))
        return out

    def counted(self, x: Found) -> Found:
        while self.peek() and self.peek() in "*+?{":
            kind = self.take()
            least, most = {"*": (0, None), "+": (1, None), "?": (0, 1)}.get(kind, (None, None))
            if kind == "{":
                body = self.take(self.text.index("}", self.at) - self.at) if "}" in self.text[self.at :] else ""
                low, comma, high = body.partition(",")
                if not low.isdigit() or (high and not high.isdigit()):
                    raise Unclear
                self.take()
                least, most = int(low), int(high) if high else (None if comma else int(low))
            if self.peek() and self.peek() in "?+":  # lazy or possessive: the same texts, or fewer
                self.take()
            x = repeated(x, least, most)
        return x

    def atom(self) -> Found:
        c = self.take()
        if c == "(":
            return self.group()
        if c == "[":
            return self.listed()
        if c == "\\":
            found = self.escape()
            return found if found.exact is None else one_of(x.translate(FOLD) for x in found.exact)
        if c == ".":
            return ANYTHING
        if c in "^$":
            return EMPTY
        if c in "*+?{":
            raise Unclear
        return one_of([c.translate(FOLD)])

    def group(self) -> Found:
        nothing = False
        if self.peek() == "?":
            self.take()
            kind = self.take()
            if kind in "=!":
                nothing = True
            elif kind == "<" and self.peek() and self.peek() in "=!":
                self.take()
                nothing = True
            elif kind == "<":
                while self.take() != ">":
                    pass
            elif kind not in ":>":
                flags = kind
                while self.peek() not in (":", ")"):
                    flags += self.take()
                if set(flags) - set("ims-d"):  # comments in patterns, other letters' cases
                    raise Unclear
                if self.take() == ")":
                    return EMPTY
        inside = self.choice()
        if self.take() != ")":
            raise Unclear
        return EMPTY if nothing else inside

    def listed(self) -> Found:
        negated = self.peek() == "^"
        if negated:
            self.take()
        if self.peek() == "]":
            raise Unclear
        chars, known = set(), not negated
        while (c := self.take()) != "]":
            if c == "[" or (c == "&" and self.peek() == "&"):
                raise Unclear
            first = self.escape() if c == "\\" else one_of([c])
            if first == EMPTY:
                raise Unclear
            if first.exact is None or len(first.exact) != 1:
                known = known and first.exact is not None
                chars |= first.exact or set()
                continue
            (low,) = first.exact
            if self.peek() == "-" and self.text[self.at + 1 : self.at + 2] not in ("]", "["):
                self.take()
                c = self.take()
                last = self.escape() if c == "\\" else one_of([c])
                if last.exact is None or len(last.exact) != 1 or last == EMPTY:
                    raise Unclear
                (high,) = last.exact
                if ord(high) - ord(low) > 4 * STRINGS:
                    known = False
                else:
                    chars |= {chr(x) for x in range(ord(low), ord(high) + 1)}
            else:
                chars.add(low)
        chars = {c.translate(FOLD) for c in chars}
        return one_of(chars) if known and 0 < len(chars) <= STRINGS else ANYTHING

    def escape(self) -> Found:
        c = self.take()
        if c in self.ZERO_WIDTH:
            return EMPTY
        if c == "d":
            return one_of("0123456789")
        if c in self.CLASSES or c.isdigit():  # a class, or what a group matched
            if c == "0":
                raise Unclear
            return ANYTHING
        if c in "pP":
            if self.take() == "{":
                while self.take() != "}":
                    pass
            return ANYTHING
        if c == "k":
            while self.take() != ">":
                pass
            return ANYTHING
        if c in "xu":
            digits = self.take(2 if c == "x" else 4) if self.peek() != "{" else self.braced()
            return one_of([chr(int(digits, 16))])
        if c == "Q":
            end = self.text.find("\\E", self.at)
            body = self.take((len(self.text) if end < 0 else end) - self.at)
            self.at += 2 * (end >= 0)
            if not body or self.peek() in ("*", "+", "?", "{"):  # what follows is about its last character only
                raise Unclear
            return one_of([body])
        if c in self.CONTROL:
            return one_of([self.CONTROL[c]])
        if c.isalnum():
            raise Unclear
        return one_of([c])

    def braced(self) -> str:
        self.take()
        out = ""
        while (c := self.take()) != "}":
            out += c
        return out


def formula(pattern: str) -> Formula:
    """What every match of a pattern (`/body/flags` or a plain one) contains, in small letters."""
    try:
        return loosened(Reader(to_java_pattern(pattern)).whole()).needs
    except (Unclear, ValueError, OverflowError, RecursionError):
        return ALL


def trigrams_of(f: Formula) -> set[str]:
    return {f} if isinstance(f, str) else set().union(*[trigrams_of(p) for p in f[1]])


def holds(f: Formula, trigrams: set[str]) -> bool:
    """The formula on the trigrams of one text."""
    if isinstance(f, str):
        return f in trigrams
    return (all if f[0] == "and" else any)(holds(p, trigrams) for p in f[1])


# on the index ------------------------------------------------------------------
def folded(column: str | Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def pattern_index(df: DataFrame, column: str, keys: Sequence[str] = ("uid",)) -> DataFrame:
    """(trigram, keys) rows of the texts in small ASCII letters. Store it with `search.stored`."""
    return df.select(F.explode(tx.trigrams(folded(column))).alias("trigram"), *keys)


WORD = 62


def _test(f: Formula, place: dict[str, int]) -> Column:
    if isinstance(f, str):
        word, bit = divmod(place[f], WORD)
        return F.col(f"_b{word}").bitwiseAND(F.lit(1 << bit).cast("long")) != 0
    parts = [_test(p, place) for p in sorted(f[1], key=str)]
    return reduce((lambda a, b: a & b) if f[0] == "and" else (lambda a, b: a | b), parts)


def candidates(index: DataFrame, patterns: Sequence[str], keys: Sequence[str] = ("uid",)) -> DataFrame:
    """(keys, patterns): per node the numbers of the patterns whose formulas hold, for patterns
    that require something. One read of the wanted index rows, one aggregation on numbers."""
    formulas = {i: f for i, f in enumerate(map(formula, patterns)) if f != ALL}
    wanted = sorted(set().union(*[trigrams_of(f) for f in formulas.values()])) if formulas else []
    place = {t: i for i, t in enumerate(wanted)}
    bits = []
    for at in range(0, len(wanted), WORD):  # one number holds the bits of WORD trigrams
        entries = F.create_map(*[F.lit(x).cast(t) for t_ in wanted[at : at + WORD] for x, t in ((t_, "string"), (1 << place[t_] - at, "long"))])
        bits.append(F.bit_or(F.coalesce(F.try_element_at(entries, F.col("trigram")), F.lit(0).cast("long"))).alias(f"_b{at // WORD}"))
    held = index.where(F.col("trigram").isin(wanted)).groupBy(*keys).agg(*bits or [F.count(F.lit(1)).alias("_b0")])
    which = F.array_compact(F.array(*[F.when(_test(f, place), F.lit(i)) for i, f in formulas.items()])) if formulas else F.array().cast("array<int>")
    return held.select(*keys, which.alias("patterns")).where(F.size("patterns") > 0)


def search_patterns(df: DataFrame, index: DataFrame, column: str, patterns: Sequence[str], keys: Sequence[str] = ("uid",)) -> DataFrame:
    """(pattern, columns of `df`) for every row and pattern that matches it. `index` is a stored
    `pattern_index` of the same rows, `keys` name a row. Candidates of all patterns come from one
    read of the index and are tested behind one join; a pattern that requires nothing is tested on
    every row. Null texts match nothing; a pattern listed twice counts once."""
    patterns = list(dict.fromkeys(patterns))
    always = [i for i, p in enumerate(patterns) if formula(p) == ALL]
    found = candidates(index, patterns, keys).withColumnRenamed("patterns", "_found")
    rows = df.join(found, list(keys), "left" if always else "inner")
    listed = F.concat(F.coalesce("_found", F.array().cast("array<int>")), F.array(*[F.lit(i) for i in always]).cast("array<int>"))
    tested = rows.select(*[df[c] for c in df.columns], F.explode(listed).alias("_pattern"))
    test = reduce(lambda other, i: F.when(F.col("_pattern") == i, F.col(column).rlike(to_java_pattern(patterns[i]))).otherwise(other), range(len(patterns)), F.lit(False))
    named = F.element_at(F.array(*[F.lit(p) for p in patterns]), F.col("_pattern") + 1)
    return tested.where(test).select(named.alias("pattern"), *df.columns)
