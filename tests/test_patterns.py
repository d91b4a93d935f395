"""Formulas of patterns: they never lose a match, and the index leaves only candidates."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quadloom.operators import patterns, search
from quadloom.operators.patterns import ALL, FOLD, formula, holds, trigrams_of


def pieces(text: str) -> set[str]:
    text = text.translate(FOLD)
    return {text[i : i + 3] for i in range(len(text) - 2)}


def random_pattern(rnd: random.Random, depth: int = 3) -> str:
    part = lambda: random_pattern(rnd, depth - 1)
    kind = rnd.random() if depth else 0.0
    if kind < 0.35:
        return "".join(rnd.choice("abcAB") if rnd.random() < 0.9 else r"\." for _ in range(rnd.randint(1, 4)))
    if kind < 0.5:
        return f"({rnd.choice(['', '?:'])}{part()}|{part()})"
    if kind < 0.65:
        return f"(?:{part()})" + rnd.choice(["*", "+", "?", "{2}", "{1,3}", "{0,2}", "{2,}", "{9}", "+?", "*?"])
    if kind < 0.72:
        return rnd.choice(["[ab]", "[a-c]", "[^a]", ".", r"\w", "[A-C]", r"[\.b]"]) + part()
    return rnd.choice(["^" + part(), part() + "$", part() + part(), f"(?={part()})" + part(), part() + r"\b" + part()])


def test_no_match_is_lost():
    rnd, matches, informed = random.Random(11), 0, 0
    for _ in range(1500):
        pattern = rnd.choice(["", "(?i)"]) + random_pattern(rnd)
        f, compiled = formula(pattern), re.compile(pattern)
        informed += f != ALL
        for _ in range(20):
            text = "".join(rnd.choice("abcAB.") for _ in range(rnd.randint(0, 14)))
            if compiled.search(text):
                matches += 1
                assert holds(f, pieces(text)), (pattern, text, f)
    assert matches > 5000 and informed > 500


@pytest.mark.parametrize("pattern, inside, outside", [
    ("(foo|bar)baz", ["foobaz", "xbarbaz"], ["foo baz", "bar", "barba"]), ("[a-c]xyz widget", ["axyz widget"], ["dxyz widget"]),
    ("/RING$/i", ["spring", "RING"], ["rin"]), (r"abc\.def", ["abc.def"], ["abcxdef"]), (r"\Qa+b+\Ec", ["a+b+c"], ["aabbc"]),
    (r"\x41bc", ["Abc"], ["bc"]), ("(?<name>abcd|abce)f", ["abcef"], ["abc"]), ("(ab){2,4}", ["abab"], ["ab"]),
])
def test_formulas_tell_texts_apart(pattern, inside, outside):
    assert all(holds(formula(pattern), pieces(t)) for t in inside) and not any(holds(formula(pattern), pieces(t)) for t in outside)


@pytest.mark.parametrize("pattern", ["a.*b", ".", "", "ab", "(abc)?", "abc|.", "abc|d", "(?x)a b c d", "(?iu)kilo", "[a-z&&[^b]]cde|[", "\\", "(abc", "abc{", "[]abc]", r"\Qab\E+abc", "x" * 0 + "(abc|)*"])
def test_where_nothing_is_certain_all_rows_are_tested(pattern):
    assert formula(pattern) == ALL


def test_formulas_stay_small():
    long = "|".join("word%03d" % i for i in range(500))
    for pattern in (long, f"({long})x({long})", "[a-p][a-p][a-p][a-p]", "a" * 5000, "(" * 200 + "abc" + ")" * 200, "(a|b)" * 30 + "cde"):
        assert len(trigrams_of(formula(pattern))) <= patterns.PARTS**2


def test_search_equals_a_scan(spark, graph, tmp_path):
    """60 random patterns in one search, nulls and short texts included, over (tenant, uid) keys."""
    rnd = random.Random(12)
    texts = [None, "", "ab"] + ["".join(rnd.choice("abcAB.") for _ in range(rnd.randint(0, 25))) for _ in range(300)]
    rows = spark.createDataFrame([(i % 3, i // 3, t) for i, t in enumerate(texts)], "namespace long, uid long, t string")
    asked = sorted({random_pattern(rnd) for _ in range(60)}) + ["/ABC+/i", "/ABC+/i"]
    keys = ["namespace", "uid"]
    index = search.stored(patterns.pattern_index(rows, "t", keys), str(tmp_path / "index"), "trigram")
    got = {(r.pattern, r.namespace, r.uid) for r in patterns.search_patterns(rows, index, "t", asked, keys).collect()}
    tests = F.array_compact(F.array(*[F.when(F.col("t").rlike(search.to_java_pattern(p)), F.lit(p)) for p in asked]))
    want = {(p, r.namespace, r.uid) for r in rows.select("*", tests.alias("p")).collect() for p in r.p or []}
    assert got == want and len(got) > 1000


def test_only_candidates_are_tested(spark, graph, tmp_path):
    parts = graph.part().select("uid", "p_name")
    index = search.stored(patterns.pattern_index(parts, "p_name"), str(tmp_path / "index"), "trigram")
    asked = ["(ring|bolt)$", "/SMALL (ring|gear)/i"]
    found = patterns.candidates(index, asked)
    tested = sum(len(r.patterns) for r in found.collect())
    names = [r.p_name for r in parts.collect()]
    assert tested == sum(holds(formula(p), pieces(n)) for p in asked for n in names) < len(names)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "PushedFilters: [In(trigram" in plan and plan.count("FileScan") == 1
    assert patterns.search_patterns(parts, index, "p_name", ["no such name at all"]).collect() == []


def test_trigrams_of_long_texts(spark):
    """Linear in the text: a text of 200,000 letters takes no longer than its letters."""
    rnd = random.Random(13)
    texts = [None, "", "ab", "abc", "日本語é😀x", "".join(rnd.choice("abcdé日😀") for _ in range(200_000))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "uid long, t string")
    got = {}
    for r in patterns.pattern_index(df, "t").collect():
        got.setdefault(r.uid, []).append(r.trigram)
    assert {k: sorted(v) for k, v in got.items()} == {i: sorted(pieces(t)) for i, t in enumerate(texts) if t and len(t) > 2}
