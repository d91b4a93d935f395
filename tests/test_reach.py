"""Expansion to any depth against a plain breadth-first search."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from quadloom.operators import reach
from quadloom.operators.traverse import TypeInfo, expand_all


def plain(roots, edges, limit=None):
    out = {}
    for ns, root in set(roots):
        if root is None:
            continue
        depth, queue = {root: 0}, deque([root])
        own = [(s, d, p) for n, s, d, p in edges if n == ns and s is not None and d is not None]
        while queue:
            at = queue.popleft()
            for s, d, _ in own:
                if s == at and d not in depth and (limit is None or depth[at] < limit):
                    depth[d] = depth[at] + 1
                    queue.append(d)
        for node, n in depth.items():
            by = min(((s, p) for s, d, p in own if d == node and depth.get(s, -9) == n - 1), default=(None, None))
            out[ns, root, node] = (n, *by)
    return out


def rows(df):
    return {(r.namespace, r.root, r.uid): (r.depth, r.parent, r.via) for r in df.collect()}


@pytest.mark.parametrize("limit", [None, 0, 2])
def test_cycles_tenants_and_hubs(spark, limit):
    """Random cyclic edges of two tenants, a hub with a third of them, loops, repeats and nulls."""
    rnd = random.Random(8)
    edges = [(n, rnd.randrange(60), rnd.randrange(60), rnd.choice("pq")) for n in (0, 1) for _ in range(100)]
    edges += [(0, 7, x, "hub") for x in range(60, 160)] + [(0, 5, 5, "p"), edges[0], edges[0], (0, None, 3, "p"), (0, 3, None, "p")]
    roots = [(0, 1), (1, 1), (0, 7), (0, 7), (1, 999), (0, None)]
    found = reach.reach(spark.createDataFrame(roots, "namespace long, uid long"), spark.createDataFrame(edges, "namespace long, src long, dst long, predicate string"), limit, buckets=8)
    assert rows(found) == plain(roots, edges, limit)
    assert found.count() == len(plain(roots, edges, limit))


def test_roots_of_many_words(spark):
    """Roots below zero, in one word and far apart, that reach the same nodes at different depths and by different edges."""
    rnd = random.Random(3)
    nodes = [*range(-70, 70), *(10**12 * i for i in range(1, 20)), -(2**63), 2**63 - 1]
    edges = [(0, rnd.choice(nodes), rnd.choice(nodes), rnd.choice("pq")) for _ in range(200)]
    roots = [(0, n) for n in nodes[::3]] + [(0, -(2**63)), (0, 2**63 - 1)]
    found = reach.reach(spark.createDataFrame(roots, "namespace long, uid long"), spark.createDataFrame(edges, "namespace long, src long, dst long, predicate string"), buckets=8)
    assert rows(found) == plain(roots, edges)
    assert found.count() == len(plain(roots, edges))


def test_roots_of_a_word_share_the_rows_of_a_node(spark):
    """64 roots over a common chain: each of its nodes has one row, not one per root."""
    edges = [(r, 100) for r in range(64)] + [(n, n + 1) for n in range(100, 106)]
    packed = reach.reach_words(spark.range(64).withColumnRenamed("id", "uid"), spark.createDataFrame(edges, "src long, dst long"), buckets=4)
    assert packed.count() == 64 + 7
    assert reach.per_root(packed).count() == 64 + 64 * 7


def test_without_tenant_and_predicate(spark):
    found = reach.reach(spark.createDataFrame([(1,)], "uid long"), spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src long, dst long"))
    assert rows(found) == {(0, 1, 1): (0, None, None), (0, 1, 2): (1, 1, ""), (0, 1, 3): (2, 2, "")}
    none = reach.reach(spark.createDataFrame([], "uid long"), spark.createDataFrame([], "src long, dst long"))
    assert none.collect() == []


def test_a_round_reads_the_buckets_of_its_frontier(spark):
    """Along a chain every round finds one node and reads one bucket of the edges."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(12)] + [(i, i) for i in range(100, 400)], "src long, dst long")
    rounds = reach.Rounds()
    found = reach.reach(spark.createDataFrame([(0,)], "uid long"), edges, buckets=64, rounds=rounds)
    assert {r.uid: r.depth for r in found.collect()} == {i: i for i in range(13)}
    assert rounds.found == [1] * 13 + [0] and rounds.read == [1] * 13


def test_levels_are_read_once(spark, graph):
    """Each table of nodes or edges is scanned once, whatever the number of paths."""
    from quadloom.catalog.e_traversal import two_hops

    plan = expand_all(two_hops(graph), "Customer", 2)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") <= 7 + 1 + 2  # seven types, the roots, two levels


def test_paths_of_a_type_that_leads_to_itself(spark):
    people = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "uid long, name string")
    knows = spark.createDataFrame([(1, 2), (2, 1), (2, 3)], "src long, dst long")
    types = {"Person": TypeInfo(people, ["name"], {"knows": (knows, "Person")})}
    got = sorted((r.root, r.path, r.uid) for r in expand_all(types, "Person", 2).where(F.col("root") == 1).collect())
    assert got == [(1, "", 1), (1, "knows", 2), (1, "knows.knows", 1), (1, "knows.knows", 3)]
    deep = {(r.uid, r.depth, r.fields) for r in reach.expand_to_any_depth(types, "Person").where(F.col("root") == 1).collect()}
    assert deep == {(1, 0, '{"name":"a"}'), (2, 1, '{"name":"b"}'), (3, 2, '{"name":"c"}')}
