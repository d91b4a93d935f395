"""The state in buckets and levels: right after every batch, and a batch costs what it brings."""

import random

import pytest

from quadloom.model import LOG_SCHEMA, OP_DEL, OP_OVR, OP_SET, STAR
from quadloom.operators.mutate import resolve
from quadloom.streaming import feeds
from quadloom.streaming.levels import KeptIndexes, LeveledState, summed

LISTS = ["tag"]


def changes(rnd, n, first, nodes=40):
    """Sets, overwrites, deletes, star deletes, deletes of nodes, of two tenants; some come late;
    node 0 has a third of them."""
    out = []
    for i in range(n):
        node = 0 if rnd.random() < 0.33 else rnd.randrange(1, nodes)
        op, predicate, value = rnd.choices([OP_SET, OP_OVR, OP_DEL], [8, 2, 2])[0], rnd.choice(["name", "tag", "age"]), f"v{rnd.randrange(6)}"
        if op == OP_DEL and rnd.random() < 0.5:
            predicate, value = (STAR, STAR) if rnd.random() < 0.2 else (predicate, STAR)
        commit = first + i if rnd.random() < 0.9 else max(1, first + i - rnd.randrange(200))
        out.append((rnd.randrange(2), node, predicate, None, value, "string", None, None, op, i, commit, commit))
    return out


def facts(df):
    return sorted((r.namespace, r.subject, r.predicate, r.value) for r in df.collect())


def test_state_after_every_batch(spark, tmp_path):
    rnd, kept, seen = random.Random(9), LeveledState(spark, str(tmp_path / "state"), LISTS, buckets=4, fan_out=2), []
    for n in range(7):
        rows = changes(rnd, 60, 1 + 60 * n)
        seen += rows
        batch = spark.createDataFrame(rows, LOG_SCHEMA)
        kept.fold(batch, n)
        runs = kept.manifest(n)
        if n in (2, 5):  # a batch that is repeated, as after a failure, changes nothing
            kept.fold(batch, n)
            assert kept.manifest(n) == runs
        want = facts(resolve(spark.createDataFrame(seen, LOG_SCHEMA), LISTS))
        assert facts(kept.state(n)) == want
        for b in range(4):  # levels fall from old to young, none twice
            own = [r.level for r in sorted(runs, key=lambda r: r.batch) if r.bucket == b]
            assert own == sorted(set(own), reverse=True)
    assert facts(kept.node(6, 0, 0)) == [f for f in want if f[:2] == (0, 0)]
    live = {r.batch for r in kept.manifest(6)} | {r.batch for r in kept.manifest(5)}
    for n in range(5):
        left = spark.read.schema(LOG_SCHEMA).parquet(str(tmp_path / f"state/runs/batch={n}")).count()
        assert (left > 0) == (n in live)


def test_a_batch_costs_what_it_brings(spark, tmp_path):
    """Batches of new nodes: the state grows, what a batch writes does not grow with it."""
    kept, size = LeveledState(spark, str(tmp_path / "state"), buckets=4, fan_out=2), 64
    wrote = []
    for n in range(16):
        rows = [(0, n * size + i, "name", None, f"v{i}", "string", None, None, OP_SET, i, n + 1, n + 1) for i in range(size)]
        kept.fold(spark.createDataFrame(rows, LOG_SCHEMA), n)
        wrote.append(sum(r.rows for r in kept.manifest(n) if r.batch == n))
    assert kept.state(15).count() == 16 * size
    levels = 5  # of 16 writes
    assert sum(wrote) <= levels * 16 * size  # a row is written once a level
    assert max(wrote) < 16 * size  # no batch rewrites the whole state


def test_a_batch_touches_its_own_buckets(spark, tmp_path):
    kept = LeveledState(spark, str(tmp_path / "state"), buckets=16, fan_out=2)
    row = lambda node, ts: (0, node, "name", None, f"v{ts}", "string", None, None, OP_SET, 0, ts, ts)
    kept.fold(spark.createDataFrame([row(i, 1) for i in range(200)], LOG_SCHEMA), 0)
    kept.fold(spark.createDataFrame([row(7, 2)], LOG_SCHEMA), 1)
    before, after = kept.manifest(0), kept.manifest(1)
    assert sum(r.batch == 1 for r in after) == 1 and len({r.bucket for r in before}) == 16
    (bucket,) = {r.bucket for r in after if r.batch == 1}
    assert [r for r in before if r.bucket != bucket] == [r for r in after if r.bucket != bucket]
    assert [r.value for r in kept.node(1, 0, 7).collect()] == ["v2"]
    kept.fold(spark.createDataFrame([], LOG_SCHEMA), 2)
    assert kept.manifest(2) == after and kept.state(2).count() == 200


def test_stream_survives_a_restart(spark, tmp_path):
    rnd, rows = random.Random(10), []
    for n in range(4):
        part = changes(rnd, 30, 1 + 30 * n)
        rows += part
        spark.createDataFrame(part, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        if n in (1, 3):  # two starts, two files each
            kept = LeveledState(spark, str(tmp_path / "state"), LISTS, buckets=4, fan_out=2)
            run = kept.start(feeds.log_stream(spark, str(tmp_path / "log"), 1), str(tmp_path / "progress"), available_now=True)
            run.awaitTermination()
            last = run.lastProgress["batchId"]
    assert facts(kept.state(last)) == facts(resolve(spark.createDataFrame(rows, LOG_SCHEMA), LISTS))


@pytest.mark.parametrize("fan_out", [2, 4])
def test_buckets_carry_at_different_batches(fan_out):
    kept = LeveledState.__new__(LeveledState)
    kept.buckets, kept.fan_out = fan_out**2, fan_out
    for writes in range(1, 70):
        highest = [kept.carried(writes, b) for b in range(kept.buckets)]
        assert sum(x > 0 for x in highest) <= len(highest) // fan_out


def test_kept_indexes_equal_a_rebuild_after_every_batch(spark, tmp_path):
    """Ten batches with overwrites, star deletes, deletes of nodes, edges, late and repeated rows."""
    rnd, seen = random.Random(14), []
    kept = KeptIndexes(spark, str(tmp_path / "kept"), list_predicates=LISTS, buckets=4, fan_out=2)
    for n in range(10):
        rows = changes(rnd, 25, 1 + 25 * n, nodes=12)
        rows = [(*r[:3], rnd.randrange(5), None, "uid", *r[6:]) if r[2] == "tag" and r[4] != STAR and rnd.random() < 0.4 else r for r in rows]
        seen += rows
        batch = spark.createDataFrame(rows, LOG_SCHEMA)
        kept.fold(batch, n)
        if n == 6:
            kept.fold(batch, n)
        facts_now = resolve(spark.createDataFrame(seen, LOG_SCHEMA), LISTS)
        want = sorted(map(tuple, kept.derived(facts_now, 1).drop("n").distinct().collect()))
        assert sorted(map(tuple, kept.entries(n).collect())) == want, n
    kind, namespace, predicate, entry, _ = next(w for w in want if w[0] == "exact")
    got = sorted(r.uid for r in kept.lookup(9, kind, namespace, predicate, entry).collect())
    assert got == sorted(w[4] for w in want if w[:4] == (kind, namespace, predicate, entry))


def test_rows_of_an_index_follow_the_change(spark, tmp_path):
    kept = KeptIndexes(spark, str(tmp_path / "kept"), ["term", "reverse"], buckets=2)
    row = lambda node, text, ts: (0, node, "name", None, text, "string", None, None, OP_SET, 0, ts, ts)
    kept.fold(spark.createDataFrame([row(i, "red ball", 1) for i in range(50)], LOG_SCHEMA), 0)
    kept.fold(spark.createDataFrame([row(7, "blue ball", 2), (0, 7, "knows", 9, None, "uid", None, None, OP_SET, 1, 2, 2)], LOG_SCHEMA), 1)
    signed = summed(kept.derived(kept.state.state(1), 1).unionByName(kept.derived(kept.state.state(0), -1)))
    assert sorted((r.kind, r.entry, r.uid, r.n) for r in signed.collect()) == [("reverse", "9", 7, 1), ("term", "blue", 7, 1), ("term", "red", 7, -1)]
    assert [r.uid for r in kept.lookup(1, "term", 0, "name", "blue").collect()] == [7] == [r.uid for r in kept.lookup(1, "reverse", 0, "knows", "9").collect()]
    assert kept.lookup(1, "term", 0, "name", "red").count() == 49 and kept.lookup(1, "term", 0, "name", "ball").count() == 50
