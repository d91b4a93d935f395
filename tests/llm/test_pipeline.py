"""Each stage of the pipeline against plain versions, on its own input."""

import pytest

import corpus_pipeline
from quadloom.plans.cut import written
from tests.llm import plain

SMALL = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def rows(df):
    return [r.asDict() for r in df.collect()]


def order(found):
    return sorted(found, key=str)


@pytest.mark.parametrize("table", ["odd", "none", "documents"])
def test_stages(spark, request, table):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet") if table == "documents" else written(request.getfixturevalue(table))
    columns = docs.columns

    def stage(name, df):
        out = written(STAGES[name](spark, df, SMALL), "test")
        assert name == "packing" or out.columns == columns
        return out, rows(df), rows(out)

    docs, before, after = stage("language", docs)
    assert order(after) == order([r for r in before if any(c.isalpha() for c in r["text"] or "")])
    docs, before, after = stage("near_copies", docs)
    groups = {tuple(g) for g in plain.reachable([plain.simhash(r["text"]) for r in before])}
    assert len(after) == len(groups) and all(r in before for r in after)
    docs, before, after = stage("decontamination", docs)
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    short = [r for r in before if len(r["text"]) < 3000]
    assert order(r for r in after if len(r["text"]) < 3000) == order(r for r in short if not plain.contamination(r["text"], items)[4])
    docs, before, after = stage("personal_data", docs)
    assert len(before) == len(after)
    for r in after:
        assert not plain.personal(r["text"])
    clean = [r for r in before if not any(c.isdigit() or c == "@" for c in r["text"])]
    assert all(r in after for r in clean)
    docs, before, after = stage("packing", docs)
    assert sum(r["length"] for r in after) == sum(len(r["text"].encode()) + 1 for r in before)


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "piece", "start", "length", "bin", "capacity", "offset"] and out.count() > 0
