"""The stored vector index against full scans."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadloom.operators import search, vector_index

SIZE = 16


@pytest.fixture(scope="module")
def vectors(spark):
    """Vectors in groups, a third of all copies of one, and some no metric can compare."""
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(30, SIZE)) * 10
    rows = [(centres[i % 30] + rnd.normal(size=SIZE)).astype(np.float32).tolist() for i in range(900)]
    rows += [rows[7]] * 300 + [[0.0] * SIZE] * 2
    odd = [None, [], [1.0] * 3, [float("nan")] * SIZE, [None] * SIZE, [float("inf")] + [1.0] * (SIZE - 1)]
    return spark.createDataFrame(list(enumerate(rows + odd)), "uid long, embedding array<float>").repartition(5)


@pytest.fixture(scope="module", params=vector_index.METRICS)
def index(request, vectors, tmp_path_factory):
    return vector_index.build(vectors, str(tmp_path_factory.mktemp("index") / request.param), request.param)


def asked(vectors, every=40):
    return vectors.where(F.col("uid") % every == 0).select(F.col("uid").alias("query"), "embedding")


def usable(vectors, index):
    return vector_index.comparable(vectors, SIZE, index.metric)


def test_exact_search_equals_a_scan(vectors, index):
    queries = vector_index.comparable(asked(vectors), SIZE, index.metric)
    want = search.top_k(usable(vectors, index), queries, 7, index.metric)
    assert sorted(map(tuple, index.search(asked(vectors), 7, exact=True).collect())) == sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, index.search(asked(vectors), 7, probes=1, exact=True).collect())) == sorted(map(tuple, want.collect()))


def test_recall_and_share(vectors, index):
    queries = vector_index.comparable(asked(vectors), SIZE, index.metric)
    rows = vector_index.recall_of(index.search(queries, 10), usable(vectors, index), queries, 10, index.metric).collect()
    assert sum(r.hits for r in rows) >= 0.9 * sum(r.true for r in rows) and len(rows) == queries.count()
    assert index.share_read(queries) < 0.7  # one cell holds a third of all rows


def test_every_row_is_indexed(vectors, index):
    codes = index.codes()
    assert codes.count() == usable(vectors, index).count() == index.rows.sum()
    assert codes.where("error < 0 or away < 0").count() == 0
    plan = codes.where("cell = 3")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan  # other cells' folders are not read


def test_codes_bound_distances(vectors, index):
    queries = vector_index.comparable(asked(vectors, 200), SIZE, index.metric)
    pairs = index._bounded(index._probed(queries, 3), 10**6).join(index._scored(index._bounded(index._probed(queries, 3), 10**6), queries), ["query", "uid"])
    assert pairs.where("away < lower - 1e-9 or away > upper + 1e-9").count() == 0 < pairs.count()


def test_opened_again(spark, vectors, index):
    other = vector_index.open_index(spark, index.folder)
    assert (other.metric, other.size, other.probes) == (index.metric, index.size, index.probes) and np.allclose(other.centres, index.centres)
    assert sorted(map(tuple, other.search(asked(vectors), 3).collect())) == sorted(map(tuple, index.search(asked(vectors), 3).collect()))


def test_few_and_no_vectors(spark, vectors, tmp_path):
    one = vector_index.build(vectors.where("uid = 3"), str(tmp_path / "one"))
    assert [tuple(r) for r in one.search(asked(vectors, 900), 5, exact=True).select("uid", "rank").distinct().collect()] == [(3, 1)]
    none = vector_index.build(vectors.where("uid < 0"), str(tmp_path / "none"), "dot")
    assert none.search(asked(vectors), 5, exact=True).collect() == []
    with pytest.raises(ValueError):
        vector_index.build(vectors, str(tmp_path / "x"), "manhattan")


def test_many_queries_stream_past_the_vectors(spark, vectors, index, monkeypatch):
    """More queries than one scan takes: the same best rows as scan by scan, for repeated queries and
    vectors too; the index hands on a few pairs a query and makes no row per pair of query and code."""
    from quadloom.plans import blocks

    rows = usable(vectors, index)
    queries = vector_index.comparable(asked(vectors, 3), SIZE, index.metric)
    want = sorted(map(tuple, search.top_k(rows, queries.where("query < 700"), 7, index.metric).collect()))
    monkeypatch.setattr(search, "MAX_QUERIES", 50)
    monkeypatch.setattr(search, "QUERY_BLOCK", 64)
    assert sorted(map(tuple, search.top_k(rows, queries.where("query < 700"), 7, index.metric).collect())) == want
    twice = sorted(map(tuple, search.top_k(rows.union(rows), queries.where("query < 700"), 14, index.metric).select("query", "uid", "score").collect()))
    assert twice[::2] == twice[1::2]
    plan = index._bounded(index._probed(queries, 3), 5)._jdf.queryExecution().executedPlan().toString()
    assert "residual" not in plan and "MapInArrow" in plan and "scale#" in plan and blocks.PARTS > 1
    near = index._bounded(index._probed(queries.where("query < 700 and query % 30 <> 7"), len(index.centres)), 5)
    assert near.count() <= 20 * blocks.PARTS * queries.count()
