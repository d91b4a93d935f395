"""The ways taken only for large or skewed data, forced on small data and compared with
plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadloom.functions import geo
from quadloom.model import FACT_SCHEMA, LOG_SCHEMA, OP_DEL, OP_OVR, OP_SET, STAR
from quadloom.operators import history, identity, mutate, order, search, traverse
from quadloom.plans.cut import shared_folder, written
from quadloom.plans.pages import nest
from quadloom.plans.rank import positions
from quadloom.plans.spread import spread_key
from quadloom.streaming import feeds


def hot_rows(n=3000, parents=40, seed=1):
    """(parent, child): parent 0 owns a third of all rows."""
    rng = random.Random(seed)
    rows = {(0 if i % 3 == 0 else rng.randrange(1, parents), rng.randrange(10**9)) for i in range(n)}
    return sorted(rows)


# positions and pages ----------------------------------------------------------
def test_positions_overall_and_per_group(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "p long, c long").repartition(7)
    got = {r.c: r.position for r in positions(df, [F.col("c").desc(), F.col("p").asc()], partitions=9).collect()}
    assert [c for c, _ in sorted(got.items(), key=lambda x: x[1])] == sorted((c for _, c in rows), reverse=True)
    assert sorted(got.values()) == list(range(1, len(rows) + 1))
    per = positions(df, [F.col("c").asc()], group=["p"], partitions=9).collect()
    for parent in {p for p, _ in rows}:
        mine = sorted((r.position, r.c) for r in per if r.p == parent)
        assert mine == list(enumerate(sorted(c for p, c in rows if p == parent), 1))


def test_positions_with_null_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "p string, c long")
    got = {(r.p, r.c): r.position for r in positions(df, [F.col("c").asc()], group=["p"]).collect()}
    assert got == {(None, 1): 1, (None, 2): 2, ("a", 3): 1}


@pytest.mark.parametrize("keep", [False, True])
def test_pages_hold_the_whole_list_in_order(spark, keep):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "p long, c long")
    pages = nest(df, ["p"], ["c"], F.struct("c"), "items", page_size=100, keep=keep).collect()
    for parent in {p for p, _ in rows}:
        mine = sorted((r.page, [i.c for i in r["items"]]) for r in pages if r.p == parent)
        want = sorted(c for p, c in rows if p == parent)
        assert [p for p, _ in mine] == list(range(math.ceil(len(want) / 100)))
        assert all(len(items) <= 100 for _, items in mine)
        assert [c for _, items in mine for c in items] == want


def test_uid_matrix_pages(spark):
    rows = hot_rows()
    edges = spark.createDataFrame(rows + rows[:50], "src long, dst long")
    pages = traverse.uid_matrix(edges, page_size=64).collect()
    hot = [u for r in sorted((r for r in pages if r.src == 0), key=lambda r: r.page) for u in r.uids]
    assert hot == sorted(c for p, c in rows if p == 0)


def test_deep_offset_equals_shallow(spark, monkeypatch):
    df = spark.createDataFrame(hot_rows(), "p long, c long")
    keys = [F.col("c").asc(), F.col("p").asc()]
    shallow = sorted(r.c for r in order.page(df, keys, 20, 500).collect())
    monkeypatch.setattr(order, "DEEP_OFFSET", 10)
    assert sorted(r.c for r in order.page(df, keys, 20, 500).collect()) == shallow


def test_top_per_parent_limits_before_the_shuffle(spark, capsys):
    df = spark.createDataFrame(hot_rows(), "p long, c long")
    top = order.top_per_parent(df, "p", [F.col("c").desc()], 2)
    top.explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Partial") > plan.index("Final")
    rows = hot_rows()
    assert sorted(r.c for r in top.where("p = 0").collect()) == sorted(sorted(c for p, c in rows if p == 0)[-2:])


def test_spread_keys_are_many_and_never_match(spark):
    df = spark.range(10000).select(spread_key(F.lit("_:x"), F.col("id") < 0, F.col("id")).alias("k"))
    assert df.distinct().count() > 1000 and df.where(F.col("k").startswith("_:")).count() == 0


def test_assign_is_dense_and_ordered(spark):
    labels = spark.createDataFrame([(f"_:{i:05d}",) for i in range(2000)], "label string").repartition(11)
    got = sorted(map(tuple, identity.assign(labels, 100).collect()))
    assert got == [(f"_:{i:05d}", 100 + i) for i in range(2000)]


def test_written_frames_are_released(spark):
    from quadloom.plans import cut

    before, cut._paths[:] = list(cut._paths), []
    kept = cut.written(spark.range(100).toDF("x"), "released")
    assert kept.count() == 100
    path = cut._paths[0]
    assert cut.release(spark) == 1 and spark.read.parquet(path).count() == 0 and cut._paths == []
    cut._paths[:] = before


def test_written_frames_use_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert spark.conf.get("spark.checkpoint.dir", folder) == folder
    assert written(spark.range(5), "t").inputFiles()[0].replace("file://", "").startswith(folder.replace("file:", ""))


# change log -------------------------------------------------------------------
def fold(rows, lists):
    """One change after the other."""
    state = {}
    for r in sorted(rows, key=lambda r: (r["commit_ts"], r["seq"])):
        s, p, op, value = r["subject"], r["predicate"], r["op"], r["value"]
        if op == OP_DEL and p == STAR:
            state = {k: x for k, x in state.items() if k[0] != s}
        elif op == OP_DEL and value == STAR:
            state = {k: x for k, x in state.items() if k[:2] != (s, p)}
        elif p in lists:
            if op == OP_OVR:
                state = {k: x for k, x in state.items() if k[:2] != (s, p)}
            if op == OP_DEL:
                state.pop((s, p, value), None)
            else:
                state[(s, p, value)] = (value, r["facets"])
        elif op == OP_DEL:
            state.pop((s, p, r["lang"]), None)
        else:
            state[(s, p, r["lang"])] = (value, r["facets"])
    return sorted((k[0], k[1], x[0], str(x[1])) for k, x in state.items())


def random_log(n=1500, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        p = rng.choice(["name", "tags", "age", "ways"])
        op = rng.choices([OP_SET, OP_DEL, OP_OVR], [6, 2, 1])[0]
        value = str(rng.randrange(6))
        kill = rng.random()
        if kill < 0.02:
            op, p, value = OP_DEL, STAR, STAR
        elif kill < 0.06:
            op, value = OP_DEL, STAR
        lang = rng.choice([None, "en", "de"]) if p == "name" and value != STAR else None
        subject = 1 if rng.random() < 0.34 else rng.randrange(2, 12)
        rows.append(
            dict(namespace=0, subject=subject, predicate=p, object_uid=None, value=value, value_type="string", lang=lang,
                 facets={"i": str(i)}, op=op, seq=i, start_ts=i, commit_ts=i // 3)
        )
    return rows


LISTS = ["tags", "ways"]


def log_frame(spark, rows):
    return spark.createDataFrame([tuple(r[f] for f in LOG_SCHEMA.fieldNames()) for r in rows], LOG_SCHEMA).repartition(5)


def as_rows(facts):
    return sorted((r.subject, r.predicate, r.value, str(r.facets)) for r in facts.collect())


@pytest.mark.parametrize("seed", [3, 4])
def test_resolve_equals_a_fold(spark, seed):
    rows = random_log(seed=seed)
    assert as_rows(mutate.resolve(log_frame(spark, rows), LISTS)) == fold(rows, LISTS)


def test_resolve_is_idempotent(spark):
    rows = random_log(400)
    once = mutate.resolve(log_frame(spark, rows), LISTS)
    assert as_rows(mutate.resolve(mutate.as_log(once, 5), LISTS)) == as_rows(once)


def test_compacted_log_has_the_same_outcome_with_late_changes(spark):
    rows = random_log(600, seed=9)
    late = rows[::7]
    early = [r for i, r in enumerate(rows) if i % 7]
    kept = feeds.compact(log_frame(spark, early), LISTS)
    assert kept.count() < len(early)
    both = kept.unionByName(log_frame(spark, late))
    assert as_rows(mutate.resolve(both, LISTS)) == fold(rows, LISTS)


@pytest.mark.parametrize("merge_every", [1, 2, 3, 16])
def test_streaming_state_survives_repeated_batches(spark, tmp_path, merge_every):
    rows = random_log(300, seed=5)
    state = feeds.StreamingState(spark, str(tmp_path / "state"), LISTS, merge_every)
    parts = [rows[i : i + 60] for i in range(0, 300, 60)]
    for i, part in enumerate(parts):
        state.fold(log_frame(spark, part), i)
        if i in (1, 3):
            state.fold(log_frame(spark, part), i)
        assert as_rows(state.state(i)) == fold(rows[: 60 * (i + 1)], LISTS)


def test_streaming_resumes_from_its_checkpoint(spark, tmp_path):
    rows = random_log(200, seed=6)
    source = str(tmp_path / "log")
    state = feeds.StreamingState(spark, str(tmp_path / "state"), LISTS)
    for part in (rows[:120], rows[120:]):
        log_frame(spark, part).coalesce(1).write.mode("append").parquet(source)
        run = state.start(feeds.log_stream(spark, source, 1), str(tmp_path / "progress"), available_now=True)
        run.awaitTermination()
    assert as_rows(state.state(1)) == fold(rows, LISTS)


def test_subscription_delivers_each_change_once(spark, tmp_path):
    rows = random_log(200, seed=7)
    source, sink, progress = (str(tmp_path / x) for x in ("log", "sink", "progress"))
    for part in (rows[:120], rows[120:]):
        log_frame(spark, part).write.mode("append").parquet(source)
        feeds.subscribe(feeds.log_stream(spark, source), ["na"], sink, progress, available_now=True).awaitTermination()
    got = sorted(r.seq for r in spark.read.schema(LOG_SCHEMA).parquet(sink).collect())
    assert got == [r["seq"] for r in rows if r["predicate"].startswith("na")]


def test_restore_equals_as_of(spark):
    rows = random_log(500, seed=8)
    log = log_frame(spark, rows)
    slices = [history.backup(log, 0, 60, force_full=True), history.backup(log, 60, 120), history.backup(log, 120, 999)]
    assert as_rows(history.restore(slices, 150, list_predicates=LISTS)) == as_rows(history.as_of(log, 150, LISTS))
    part = fold([r for r in rows if r["commit_ts"] <= 60 or 90 < r["commit_ts"] <= 150], LISTS)
    assert as_rows(history.restore(slices, 150, 90, LISTS)) == part


def test_export_writes_one_folder_per_predicate(spark, tmp_path):
    log = log_frame(spark, random_log(200))
    for form in ("rdf", "json"):
        path = str(tmp_path / form)
        history.export(spark, log, path, 50, 0, form, LISTS)
        lines = spark.read.text(path)
        assert "predicate" in lines.columns and lines.count() == history.as_of(log, 50, LISTS).count()


def test_conflicts_equal_all_pairs(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        length = rng.choice([0, 1, 1, 2, 5, 30, 900])
        rows.append((0, 1 if i % 3 == 0 else rng.randrange(2, 5), rng.choice(["a", "b", "free"]), i, i + length))
    log = spark.createDataFrame(rows, "namespace long, subject long, predicate string, start_ts long, commit_ts long")
    got = sorted(map(tuple, history.conflicts(log, no_conflict=["free"]).collect()))
    want = sorted(
        (a[0], a[1], a[2], a[3], b[3])
        for a in rows for b in rows
        if a[:3] == b[:3] and a[2] != "free" and a[3] < b[3] and b[3] < a[4] and a[3] < b[4]
    )
    assert got == want and want
    assert history.conflicts(log.where("namespace = 9")).count() == 0


# search -----------------------------------------------------------------------
def great_circle(lon1, lat1, lon2, lat2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * geo.EARTH_RADIUS * math.asin(min(1, math.sqrt(a)))


def test_near_equals_brute_force(spark):
    rng = random.Random(4)
    points = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(500)] + [(900, 180.0, 0.0), (901, -180.0, 0.0), (902, 7.0, 90.0)]
    centres = [(1, 179.5, 0.0, 9e5), (2, 10.0, 89.0, 4e5), (3, -30.0, -88.0, 2e6), (4, 0.0, 0.0, 2.1e7), (5, 12.0, 45.0, 5e5), (6, 7.0, 89.9, 2e4), (7, 180.0, 0.0, 10.0), (8, 20.0, 20.0, 0.0)]
    found = search.near(
        spark.createDataFrame(points, "uid long, lon double, lat double"),
        spark.createDataFrame(centres, "centre long, lon double, lat double, radius double"),
    )
    got = sorted((r.centre, r.uid) for r in found.collect())
    want = sorted((c, u) for c, clon, clat, radius in centres for u, lon, lat in points if great_circle(clon, clat, lon, lat) <= radius)
    assert got == want


@pytest.mark.parametrize("metric", ["euclidean", "dot", "cosine"])
def test_top_k_equals_brute_force(spark, metric, monkeypatch):
    monkeypatch.setattr(search, "MAX_QUERIES", 3)  # eight queries: several scans
    rng = np.random.default_rng(5)
    data = rng.normal(size=(300, 8)).astype(np.float32)
    data[7] = 0
    data[8] = data[9]
    asked = rng.normal(size=(8, 8)).round(3)
    vectors = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "uid long, embedding array<float>").repartition(6)
    queries = spark.createDataFrame([(i, [float(x) for x in q]) for i, q in enumerate(asked)], "query long, embedding array<double>")
    got = sorted((r.query, r.rank, r.uid) for r in search.top_k(vectors, queries, 4, metric).collect())
    want = []
    for i, q in enumerate(asked):
        scores = []
        for j, vec in enumerate(data.astype(np.float64)):
            if metric == "euclidean":
                s = round(float(np.sqrt(((vec - q) ** 2).sum())), 9)
            elif metric == "dot":
                s = -round(float(vec @ q), 9)
            else:
                size = np.linalg.norm(vec) * np.linalg.norm(q)
                if size == 0:
                    continue
                s = -round(float(vec @ q / size), 9)
            scores.append((s, j))
        want += [(i, rank, j) for rank, (_, j) in enumerate(sorted(scores)[:4], 1)]
    assert got == sorted(want)


def test_similarity_expression_agrees(spark):
    row = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0], [0.0, 0.0])], "a array<float>, b array<double>, z array<double>")
    a, b, z = F.col("a"), F.col("b"), F.col("z")
    got = row.select(
        search.similarity("euclidean", a, b), search.similarity("dot", a, b), search.similarity("cosine", a, b), search.similarity("cosine", a, z)
    ).first()
    assert got[0] == pytest.approx(math.sqrt(8)) and got[1] == 11.0 and got[2] == pytest.approx(11 / math.sqrt(125)) and got[3] is None


def test_random_projection_recall(spark, graph):
    """Approximate neighbours: all reported pairs are right, most true pairs are found."""
    vectors = graph.vectors()
    rows = vectors.select("uid", "embedding").collect()
    queries = spark.createDataFrame([(i, [float(x) for x in rows[i].embedding]) for i in range(0, 50, 5)], "query long, embedding array<double>")
    data = np.array([r.embedding for r in rows], dtype=np.float64)
    distance = {(i, rows[j].uid): float(np.linalg.norm(data[i] - data[j])) for i in range(0, 50, 5) for j in range(len(rows))}
    limit = float(np.quantile(list(distance.values()), 0.05))
    true = {k for k, x in distance.items() if x < limit}
    found = {(r.query, r.uid) for r in search.similar_pairs(vectors, queries, limit).collect()}
    assert found <= {k for k, x in distance.items() if x <= limit + 1e-6}
    recall = len(found & true) / len(true)
    assert recall >= 0.7, recall


@pytest.mark.parametrize(
    "pattern, needed",
    [("re.*widget", ["dge", "get", "idg", "wid"]), ("^blue b?olt", ["blu", "lue", "olt", "ue "]), ("ab*?cde", ["cde"]), ("a|bcd", []), ("/abcd/i", []),
     ("(abcd)", []), ("abc{2}", []), ("[abc]def", []), ("abc+def", ["abc", "def"]), ("abc++def", ["abc", "def"]), (r"abc\.def", [])],
)
def test_required_trigrams(pattern, needed):
    assert search.required_trigrams(pattern) == needed


@pytest.mark.parametrize("pattern", ["re.*widget", "ring$", "/SMALL/i", "^.?e", "a+l"])
def test_regexp_search_equals_a_scan(graph, pattern):
    from quadloom.operators.roots import to_java_pattern

    parts = graph.part().select("uid", "p_name")
    got = search.regexp_search(parts, search.trigram_index(parts, "p_name"), "p_name", pattern)
    want = parts.where(F.col("p_name").rlike(to_java_pattern(pattern)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_stored_index_is_read_by_pushed_filters(spark, graph, tmp_path):
    parts = graph.part().select("uid", "p_name")
    index = search.stored(search.trigram_index(parts, "p_name"), str(tmp_path / "trigrams"), "trigram")
    found = search.regexp_search(parts, index, "p_name", "re.*widget")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(trigram" in plan
    tested = [line for line in plan.splitlines() if "RLIKE" in line]
    assert tested and not any("Scan" in line or "Filter" in line for line in tested)  # on candidates only


def test_inverted_lists_of_a_common_term(spark):
    rows = [("text", "the", i) for i in range(1000)] + [("text", "rare", 5)]
    pages = search.inverted_lists(spark.createDataFrame(rows, "predicate string, term string, uid long"), page_size=300).collect()
    the = sorted((r.page, r.uids) for r in pages if r.term == "the")
    assert [len(u) for _, u in the] == [300, 300, 300, 100] and [x for _, u in the for x in u] == list(range(1000))


def test_reverse_index_splits_a_hot_target(spark):
    edges = spark.createDataFrame([(i, 0 if i % 3 else i) for i in range(1, 3001)], "src long, dst long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small data stays spread
    try:
        sizes = search.reverse_index(edges).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 2000


def test_facts_schema_is_what_operators_produce(spark):
    log = log_frame(spark, random_log(50))
    assert mutate.resolve(log, LISTS).columns == FACT_SCHEMA.fieldNames()


# joins ------------------------------------------------------------------------
def test_joins_reduce_a_repeating_right_side(spark, capsys):
    from quadloom.plans.semi import having, lacking, with_partners

    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k long, name string")
    right = spark.createDataFrame([(1, 10)] * 5 + [(2, 20), (None, 30)], "r long, x long")
    keyed = right.withColumnRenamed("r", "k")
    assert sorted(r.name for r in having(left, keyed, "k").collect()) == ["a", "b"]
    assert sorted(r.name for r in lacking(left, keyed, "k").collect()) == ["c", "n"]
    got = sorted(map(tuple, with_partners(left, right, "k", "r").collect()), key=str)
    want = sorted(map(tuple, left.join(right, left["k"] == right["r"], "left").select("k", "name", "x").collect()), key=str)
    assert got == want
    having(left, keyed, "k").explain()
    assert "HashAggregate" in capsys.readouterr().out


def test_no_plan_compares_everything_with_everything(graph, spark):
    """Queries that join on ranges, grids or variables never fall back to a nested loop."""
    import __spark_entry__ as entry

    for name in ("c07_upsert_variables", "d10_regexp", "e04_expand_all", "k08_geo_radius", "n04_conflicts", "c08_conditional", "l12_pending", "g08_latest"):
        plan = entry.queries()[name](spark, graph.sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_similar_pairs_of_close_vectors(spark):
    """Every vector with an id divisible by 20 asks at a threshold with few neighbours: recall is
    0.9 or more whatever the scale of the vectors, the bucket length follows it."""
    for scale in (1.0, 50.0):
        cells = F.transform("embedding", lambda x: x.cast("double") * scale)
        vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select(F.col("vec_id").cast("long").alias("uid"), cells.alias("embedding"))
        queries = vectors.where("uid % 20 = 0").select(F.col("uid").alias("query"), "embedding")
        rows = vectors.collect()
        ids, e = np.array([r["uid"] for r in rows]), np.array([r["embedding"] for r in rows])
        asked = np.flatnonzero(ids % 20 == 0)
        far = np.sqrt(((e[asked][:, None, :] - e[None, :, :]) ** 2).sum(axis=2))
        limit = float(np.quantile(far, 0.05))
        true = {(int(ids[i]), int(ids[j])) for i, row in zip(asked, far) for j in np.flatnonzero(row <= limit)}
        got = {(r["query"], r["uid"]) for r in search.similar_pairs(vectors, queries, limit).collect()}
        assert got <= true and len(got) >= 0.9 * len(true)


def test_folders_are_written_without_sorting_the_rows(spark, monkeypatch, tmp_path):
    """Tasks may keep a file a folder open while folders are written, and only then."""
    from pyspark.sql import DataFrameWriter
    from quadloom.plans import cut

    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **b: (seen.append(int(spark.conf.get(key, "0"))), write(self, path, *a, **b)))
    rows = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(300)] + [(None, None), (7, "b")], "x long, name string").repartition(3)
    got = cut.written(rows, "folders", partition_by=["name"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    assert seen == [cut.OPEN_FILES] and int(spark.conf.get(key, "0")) == 0


def test_the_last_level_is_not_written(spark, graph, monkeypatch):
    """The product of the ways into and out of a hub is neither stored nor joined by uid again."""
    from quadloom.catalog.e_traversal import two_hops
    from quadloom.operators import traverse

    names, keep = [], traverse.written
    monkeypatch.setattr(traverse, "written", lambda df, name="cut", **more: names.append(name) or keep(df, name, **more))
    traverse.expand_all(two_hops(graph), "Customer", 2)
    assert sorted(names) == ["edges", "level", "nodes"]


def test_pages_of_stored_rows_are_not_written_again(spark, monkeypatch):
    from quadloom.plans import pages

    names, keep = [], pages.written
    monkeypatch.setattr(pages, "written", lambda df, name="cut", **more: names.append(name) or keep(df, name, **more))
    rows = spark.createDataFrame([("text", "the", i) for i in range(500)] + [("text", None, 3)] * 301, "predicate string, term string, uid long")
    lists = search.inverted_lists(rows, page_size=300)
    assert names == ["children"]
    assert "BroadcastHashJoin" in lists._jdf.queryExecution().sparkPlan().toString()


@pytest.fixture(scope="module")
def one_split(spark, tmp_path_factory):
    """Customers in one file with one row group, more than a task should make facts of; equal and null keys among them."""
    from quadloom.plans.spread import DEAL_ROWS

    at = tmp_path_factory.mktemp("one_split")
    key = F.when(F.col("id") % 3 == 0, F.col("id")).when(F.col("id") % 3 == 1, 7).cast("int")
    rows = spark.range(0, 2 * DEAL_ROWS + 2, 1, 1).select(
        key.alias("c_custkey"), F.format_string("n%d", "id").alias("c_name"), (F.col("id") % 25).cast("int").alias("c_nationkey"),
        (F.col("id") % 200 - 100).cast("double").alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"))
    rows.write.parquet(f"{at}/customer.parquet")
    spark.range(0, 25, 1, 1).select(
        F.col("id").cast("int").alias("n_nationkey"), (F.col("id") % 5).cast("int").alias("n_regionkey"), F.format_string("N%d", "id").alias("n_name")
    ).write.parquet(f"{at}/nation.parquet")
    return str(at)


def test_a_split_with_many_rows_is_dealt_out(spark, one_split):
    from quadloom.plans.spread import DEAL_ROWS
    from quadloom.sources.tables import Graph

    plain, dealt = Graph(spark, one_split), Graph(spark, one_split).dealt()
    sizes = [r["count"] for r in dealt.customer().groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2 * DEAL_ROWS + 2 and len(sizes) == 3 and max(sizes) < DEAL_ROWS
    total = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns) % 1_000_003)).first()
    assert total(dealt.customer()) == total(plain.customer())
    assert dealt.nation().rdd.getNumPartitions() == plain.nation().rdd.getNumPartitions()


@pytest.mark.parametrize("name", ["c07_upsert_variables", "c12_save"])
def test_facts_of_a_snapshot_are_folded_in_bounded_tasks(spark, one_split, name):
    """The fold sorts what a task reads, so a scan goes through a deal before its rows become facts."""
    import __spark_entry__ as entry

    plan = entry.queries()[name](spark, one_split)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Generate") :]
    assert "RepartitionByExpression [_place" in below
