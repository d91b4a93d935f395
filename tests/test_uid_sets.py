"""Compressed uid sets against Python sets."""

import random

import pytest

from quadloom.operators import uid_sets

LEAST, MOST = -(1 << 63), (1 << 63) - 1


def frame(spark, pairs):
    return spark.createDataFrame(sorted(pairs), "namespace long, uid long").repartition(3)


def listed(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def three(spark):
    rnd = random.Random(4)
    edge = [LEAST, LEAST + 63, -65, -64, -1, 0, 1, 63, 64, MOST - 63, MOST]
    out = {}
    for name in "abc":
        pairs = {(n, u) for n in (0, 7) for u in edge if rnd.random() < 0.6}
        pairs |= {(n, rnd.randrange(-300, 300)) for n in (0, 7) for _ in range(150)}
        out[name] = pairs | {(3, rnd.randrange(1 << 62)) for _ in range(20)}
    return out, {n: uid_sets.compress(frame(spark, p)) for n, p in out.items()}


def plain(tree, sets, all_of):
    if isinstance(tree, str):
        return sets[tree]
    kind, body = tree
    if kind == "not":
        return all_of - plain(body, sets, all_of)
    parts = [plain(t, sets, all_of) for t in body]
    return set.intersection(*parts) if kind == "and" else set.union(*parts)


def test_back_and_forth(spark, three):
    for name, pairs in three[0].items():
        assert listed(uid_sets.members(three[1][name])) == pairs
    odd = spark.createDataFrame([(5,), (5,), (None,), (-9,)], "uid long")
    assert listed(uid_sets.members(uid_sets.compress(odd))) == {(0, 5), (0, -9)}
    assert listed(uid_sets.members(uid_sets.compress(odd.where("1 = 0")))) == set()
    untold = spark.createDataFrame([(None, 5), (0, 5)], "namespace long, uid long")
    assert listed(uid_sets.members(uid_sets.compress(untold))) == {(0, 5)}


def trees(rnd, depth):
    if not depth or rnd.random() < 0.2:
        return rnd.choice("abc")
    kind = rnd.choice(["and", "or", "not"])
    return (kind, trees(rnd, depth - 1)) if kind == "not" else (kind, [trees(rnd, depth - 1) for _ in range(rnd.randint(1, 3))])


def test_trees(three):
    pairs, stored = three
    rnd, judged, refused = random.Random(9), 0, 0
    universe = set().union(*pairs.values()) | {(99, 1)}  # one uid that no set holds
    while judged < 12 or refused < 5:
        tree = trees(rnd, 4)
        want = plain(tree, pairs, universe)
        if (99, 1) in want:
            refused += 1
            with pytest.raises(ValueError):
                uid_sets.evaluate(stored, tree)
        elif judged < 12:
            judged += 1
            assert listed(uid_sets.members(uid_sets.evaluate(stored, tree))) == want
    with pytest.raises(KeyError):
        uid_sets.evaluate(stored, ("and", ["a", "z"]))


def test_counts(three):
    for name, pairs in three[0].items():
        got = {r.namespace: (r.uids, r.words) for r in uid_sets.counts(three[1][name]).collect()}
        assert got == {n: (sum(m == n for m, _ in pairs), len({u >> 6 for m, u in pairs if m == n})) for n in {m for m, _ in pairs}}


def test_membership(spark, three):
    pairs, stored = three
    rows = frame(spark, pairs["a"] | pairs["b"]).union(spark.createDataFrame([(0, None)], "namespace long, uid long"))
    assert listed(uid_sets.having(rows, stored["a"])) == pairs["a"]
    assert listed(uid_sets.having(rows, stored["a"], negate=True)) == (pairs["b"] - pairs["a"]) | {(0, None)}


def test_changes(spark, three):
    pairs, stored = three
    rnd = random.Random(2)
    rows = [(n, u, k, rnd.random() < 0.5) for k, (n, u) in enumerate(rnd.choices(sorted(pairs["a"] | pairs["b"]), k=400))]
    want = set(pairs["a"])
    for n, u, _, added in rows:
        want.add((n, u)) if added else want.discard((n, u))
    rnd.shuffle(rows)
    changes = spark.createDataFrame(rows, "namespace long, uid long, seq long, added boolean")
    assert listed(uid_sets.members(uid_sets.changed(stored["a"], changes))) == want


def test_dense_sets_shrink(spark):
    """Row counts say what is shuffled: 64 uids a row where uids are given out in a row."""
    dense = uid_sets.compress(spark.range(64_000).withColumnRenamed("id", "uid"))
    assert dense.count() == 1000 and uid_sets.counts(dense).first().density == 1.0
    plan = uid_sets.evaluate({"a": dense, "b": dense}, ("and", ["a", "b"]))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
