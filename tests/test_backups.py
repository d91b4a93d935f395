"""Backup chains: what they hold, what they lack, and restores from them."""

import random

import pytest

from quadloom.model import FACT_COLUMNS, LOG_SCHEMA, OP_DEL, OP_OVR, OP_SET, STAR
from quadloom.operators.backups import Backups, BrokenChain
from quadloom.operators.history import as_of

LISTS = ["tag"]


def log_rows(n=300):
    rnd, out = random.Random(15), []
    for ts in range(1, n + 1):
        op, predicate, value = rnd.choice([OP_SET, OP_SET, OP_OVR, OP_DEL]), rnd.choice(["name", "tag", "age"]), f"v{rnd.randrange(5)}"
        if op == OP_DEL and rnd.random() < 0.3:
            predicate, value = (STAR, STAR) if rnd.random() < 0.3 else (predicate, STAR)
        out.append((rnd.randrange(2), rnd.randrange(12), predicate, None, value, "string", None, {"f": str(ts)} if ts % 3 else None, op, 0, ts, ts))
    return out


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(log_rows(), LOG_SCHEMA).repartition(3)


@pytest.fixture
def kept(spark, log, tmp_path):
    backups = Backups(spark, str(tmp_path / "backups"))
    for name, since, read in (("full", 0, 100), ("one", 100, 150), ("two", 150, 200), ("wide", 90, 200), ("three", 200, 280)):
        backups.write(log, name, read, since)
    return backups


def rows(df):
    return sorted(map(str, df.select(*FACT_COLUMNS).collect()))


def test_manifest(kept):
    assert [(s.name, s.since, s.read, s.rows) for s in kept.manifest()] == [("full", 0, 100, 100), ("wide", 90, 200, 110), ("one", 100, 150, 50), ("two", 150, 200, 50), ("three", 200, 280, 80)]
    assert kept.gaps() == [] and kept.damaged() == [] and ("wide", "one") in kept.overlaps()


@pytest.mark.parametrize("ts", [0, 1, 99, 150, 199, 280])
def test_restore_at_any_timestamp(kept, log, ts):
    assert rows(kept.restore(ts, list_predicates=LISTS)) == rows(as_of(log, ts, LISTS))


def test_the_smallest_chain_is_read_once(kept):
    assert [s.name for s in kept.chain(150)] == ["full", "one"] and [s.name for s in kept.chain(200)] == ["full", "one", "two"]
    plan = kept.read(kept.chain(280))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1


def test_a_gap_is_refused_or_allowed(spark, log, tmp_path):
    kept = Backups(spark, str(tmp_path / "backups"))
    with pytest.raises(BrokenChain):
        kept.chain(10)
    for name, since, read in (("full", 0, 100), ("late", 150, 200)):
        kept.write(log, name, read, since)
    assert kept.gaps() == [(100, 150)]
    with pytest.raises(BrokenChain, match="commit 100 to 200"):
        kept.restore(200)
    known = log.where("commit_ts <= 100 or commit_ts > 150")
    assert rows(kept.restore(200, list_predicates=LISTS, allow_gaps=True)) == rows(as_of(known, 200, LISTS))
    with pytest.raises(BrokenChain):
        kept.chain(201)
    assert [s.name for s in kept.chain(300, allow_gaps=True)] == ["full", "late"]


def test_damage_is_found(spark, log, kept, tmp_path):
    part = next((tmp_path / "backups/slices/slice=two").rglob("*.parquet"))
    part.write_bytes(part.read_bytes()[:-40])
    log.where("commit_ts > 100 and commit_ts < 150").withColumn("of", log.predicate).write.mode("overwrite").partitionBy("of").parquet(str(tmp_path / "backups/slices/slice=one"))
    assert kept.damaged() == ["one", "two"]
    with pytest.raises(BrokenChain, match="damaged slices: one"):
        kept.restore(150, verify=True)


def test_parts_of_a_store(spark, log, kept):
    """Some predicates alone: only their folders are read, deletes of nodes still count. Slices of
    some predicates serve restores of those."""
    want = [r for r in rows(as_of(log, 280, LISTS)) if "predicate='age'" in r]
    assert rows(kept.restore(280, ["age"], LISTS)) == want
    kept.write(log, "ages", 280, 100, ["age"])
    assert [s.name for s in kept.chain(280, ["age"])] == ["full", "ages"] and "ages" not in [s.name for s in kept.chain(280)]
    assert rows(kept.restore(280, ["age"], LISTS)) == want
    plan = kept.read(kept.chain(280, ["age"]), ["age"])._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [of" in plan
    moved = kept.restore(280, list_predicates=LISTS, from_namespace=1, to_namespace=9)
    assert moved.count() == as_of(log, 280, LISTS).where("namespace = 1").count() == moved.where("namespace = 9").count()


def test_names_and_empty_slices(spark, log, kept):
    assert kept.write(log, "none", 900, 800).rows == 0 and kept.damaged() == []
    with pytest.raises(ValueError):
        kept.write(log, "a/b", 10)
