"""Edges, keys and upserts of several tenants that use the same uids and keys."""

from quadloom.operators import checks, counting, mutate, roots


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_edges_belong_to_their_tenant(spark):
    nodes = spark.createDataFrame([(0, 1), (0, 2), (1, 1), (1, 2)], "namespace long, uid long")
    edges = spark.createDataFrame([(0, 1, 2), (0, 1, 2), (1, 2, 2)], "namespace long, src long, dst long")
    assert rows(roots.has_edge(nodes, edges)) == [(0, 1), (1, 2)] and rows(roots.lacks_edge(nodes, edges)) == [(0, 2), (1, 1)]
    assert rows(counting.out_counts(nodes, edges)) == [(0, 1, 1), (0, 2, 0), (1, 1, 0), (1, 2, 1)]
    assert rows(counting.in_counts(nodes, edges)) == [(0, 1, 0), (0, 2, 1), (1, 1, 0), (1, 2, 1)]
    assert rows(counting.count_index(edges)) == [(0, 1, 1), (1, 2, 1)]
    assert rows(checks.dangling(edges.distinct(), nodes.where("namespace = 0"))) == [(1, 2, 2)]


def test_frames_without_a_tenant_belong_to_tenant_0(spark):
    plain = spark.createDataFrame([(1,), (2,)], "uid long")
    edges = spark.createDataFrame([(1, 1, 2), (0, 2, 1)], "namespace long, src long, dst long")
    assert rows(roots.has_edge(plain, edges)) == [(2,)] and roots.has_edge(plain, edges).columns == ["uid"]
    assert rows(roots.lacks_edge(plain, edges.drop("namespace"))) == []


def test_keys_belong_to_their_tenant(spark):
    batch = spark.createDataFrame([(0, "a"), (0, "a"), (1, "a"), (1, "b"), (1, "b")], "namespace long, k string")
    state = spark.createDataFrame([(1, "a", 7), (1, "b", 8)], "namespace long, k string, uid long")
    assert rows(checks.repeated_keys(batch, "k", state)) == [(0, "a", 2, False), (1, "b", 2, True)]
    found = mutate.upsert(batch.distinct(), state, "k")
    assert sorted((r.namespace, r.k, r.is_new) for r in found.collect()) == [(0, "a", True), (1, "a", False), (1, "b", False)]
    assert {r.uid for r in found.collect() if not r.is_new} == {"0x7", "0x8"}
