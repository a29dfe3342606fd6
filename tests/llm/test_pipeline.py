"""The pipeline's stages against brute force, and its SQL-checked queries."""

import pytest

import corpus_pipeline
from tallyworks.llm.queries import QUERIES, SQL, table
from tests.compare import connect, differences
from tests.llm.test_duplicates import components_of, hits_of, passages_of, sha

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), SQL[name]) is None


def test_stages(spark):
    docs = table(spark, FOLDER, "documents")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(stage(spark, steps[-1], FOLDER).cache())
        assert name == corpus_pipeline.STAGES[-1][0] or steps[-1].columns == docs.columns
    good, single, cut, clean, encoded = [[tuple(r) for r in s.collect()] for s in steps[1:]]
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    kept = {r[0] for r in good}
    right = [(labels[i] == 1) == (i in kept) for i in labels]
    assert sum(right) / len(right) > 0.95
    assert {r[0] for r in single} == {i for i, (_, root) in components_of(good).items() if i == root}
    want = passages_of(single)
    assert {r[0]: sha(" ".join((r[1] or "").split())) for r in cut} == {i: x[2] for i, x in want.items()}
    assert all(r[4] == len(r[1]) for r in cut)
    items = [tuple(r) for r in table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    assert {r[0] for r in clean} == {i for i, x in hits_of(cut, items).items() if not x[4]}
    assert {r[0] for r in encoded} == {r[0] for r in clean} and all(r[2] and r[3] for r in encoded)


def test_run_equals_the_last_stage(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "ids", "parity", "restored", "n_tokens"} <= set(got.columns) and got.count() > 0
