"""`traverse.expand_all` against plain Python, and what it stores on the way."""

from collections import Counter
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from quadloom.operators import traverse
from quadloom.operators.traverse import TypeInfo, expand_all

PEOPLE = [(1, "a"), (2, "b"), (2, "b"), (3, None), (4, "d"), (None, "nobody")]
TOWNS = [(11, "x"), (12, "y"), (12, "y2")]
KNOWS = [(1, 2), (1, 2), (2, 3), (3, 1), (4, 4), (4, 9), (None, 1), (1, None)]
LIVES = [(1, 11), (2, 11), (3, 11), (4, 12), (4, 11), (3, None)]


def frames(spark):
    people, towns = spark.createDataFrame(PEOPLE, "uid long, name string"), spark.createDataFrame(TOWNS, "uid long, name string")
    knows, lives = spark.createDataFrame(KNOWS, "src long, dst long"), spark.createDataFrame(LIVES, "src long, dst long")
    return {
        "Person": TypeInfo(people, ["name"], {"knows": (knows, "Person"), "lives": (lives, "Town")}),
        "Town": TypeInfo(towns, ["name"], {"~lives": (traverse.reverse(lives), "Person")}),
    }


def plain(depth):
    nodes = {"Person": PEOPLE, "Town": TOWNS}
    edges = {"Person": [("knows", "Person", KNOWS), ("lives", "Town", LIVES)], "Town": [("~lives", "Person", [(b, a) for a, b in LIVES])]}
    level, out = [(u, "", None, u, "Person") for u, _ in PEOPLE], Counter()
    for i in range(depth + 1):
        for root, path, parent, uid, kind in level:
            for u, name in nodes[kind]:
                if uid is not None and u == uid:
                    out[root, path, parent, uid, kind, "{}" if name is None else f'{{"name":"{name}"}}'] += 1
        level = [(root, f"{path}.{p}" if path else p, uid, b, target) for root, path, _, uid, kind in level if uid is not None
                 for p, target, pairs in edges[kind] for a, b in pairs if a == uid]
    return out


@pytest.mark.parametrize("depth", [0, 1, 2, 3])
def test_every_path_is_followed(spark, depth):
    """Repeated and null uids, edges without an end, types met at several depths, hubs in parts or not."""
    for rows in (1, 2, 1000):
        got = expand_all(frames(spark), "Person", depth, hub_rows=rows)
        assert got.columns == ["root", "path", "parent", "uid", "type", "fields"]
        assert Counter(map(tuple, got.collect())) == plain(depth), rows


def test_depth_beyond_the_last_edge(spark):
    types = {"Person": frames(spark)["Person"], "Town": TypeInfo(frames(spark)["Town"].nodes, ["name"])}
    types["Person"].edges.pop("knows")
    assert Counter(map(tuple, expand_all(types, "Person", 4).collect())) == Counter(map(tuple, expand_all(types, "Person", 1).collect()))


def test_edges_of_the_last_hop_are_not_stored(spark, monkeypatch):
    """Only edges that lead to a stored level are."""
    stored, keep = {}, traverse.written
    monkeypatch.setattr(traverse, "written", lambda df, name="cut", **more: stored.setdefault(name, keep(df, name, **more)))
    types = frames(spark)
    types["Person"].edges.pop("knows")
    expand_all(types, "Person", 2)
    assert stored["edges"].count() == len(LIVES)


def test_a_hub_is_followed_by_many_tasks_and_its_rows_lie_together(spark, monkeypatch):
    n = 300
    people = spark.range(n).select(F.col("id").alias("uid"), F.col("id").cast("string").alias("name"))
    lives = people.select(F.col("uid").alias("src"), F.lit(1000).cast("long").alias("dst"))
    town = spark.createDataFrame([(1000, "x")], "uid long, name string")
    types = {"Person": TypeInfo(people, ["name"], {"lives": (lives, "Town")}), "Town": TypeInfo(town, ["name"], {"~lives": (traverse.reverse(lives), "Person")})}
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    monkeypatch.setattr(traverse, "HUB_ROWS", 50)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = expand_all(types, "Person", 2).where("path = 'lives.~lives'").select("root", "uid", F.spark_partition_id().alias("task"))
        rows = found.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert Counter((r.root, r.uid) for r in rows) == Counter((a, b) for a in range(n) for b in range(n))
    assert len({r.task for r in rows}) > 1
    assert sum(1 for _ in groupby(rows, lambda r: (r.task, r.uid))) <= n * 2 * (n // 50)
