"""Stages against what they must keep and drop; the whole run; planted documents."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = cp.table(spark, SF_DIR, "documents"), []
    for name, stage in cp.STAGES:
        docs = cp.materialize(stage(spark, docs, SF_DIR), f"test-{name}")
        out.append(docs)
    return [cp.table(spark, SF_DIR, "documents"), *out]


def test_columns_and_rows(spark, stages):
    for before, after in zip(stages[:-2], stages[1:-1], strict=True):
        assert after.columns == before.columns
        assert after.exceptAll(before).count() == 0
    assert stages[-1].count() == stages[-2].count()
    counts = [s.count() for s in stages]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 600
    assert {r[0] for r in cp.run(spark, SF_DIR).select("doc_id").collect()} == {r[0] for r in stages[-1].select("doc_id").collect()}


def test_labels(spark, stages):
    labels = cp.table(spark, SF_DIR, "labels")
    kept = {r["doc_id"] for r in stages[1].select("doc_id").collect()}
    toxic = {r["doc_id"] for r in labels.where("toxic = 1").collect()}
    clean = {r["doc_id"] for r in labels.where("toxic = 0 and quality = 1").collect()}
    assert len(toxic & kept) < 0.2 * len(toxic) and len(clean & kept) > 0.98 * len(clean)


def test_language_keeps_clean(stages):
    assert stages[2].count() > 0.99 * stages[1].count()


def test_one_of_each_group_and_no_leak(spark, stages):
    texts = [r["text"] for r in stages[3].select("text").collect()]
    assert len(set(texts)) == len(texts)
    items = [r["text"] for r in cp.table(spark, SF_DIR, "benchmark").collect()]
    assert not [t for t in (r["text"] for r in stages[4].select("text").collect()) if any(i in t for i in items)]


def test_ids_decode(spark, stages):
    got = stages[5].join(stages[4].select("doc_id", F.sha2("text", 256).alias("want")), "doc_id")
    assert got.where(F.col("want") != F.col("decoded_sha256")).count() == 0
    assert got.where(F.size("ids") != F.col("n_tokens")).count() == 0


def test_planted(spark):
    draw = np.random.default_rng(0)
    rows = [tuple(r) for r in cp.table(spark, SF_DIR, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    item = cp.table(spark, SF_DIR, "benchmark").first()["text"]
    words = [r for r in rows if r[2] == "en" and len(r[1].split()) > 300][0][1].split()
    fresh = list(draw.permutation(words))
    near = list(fresh)
    near[40], near[200] = "changedword", "otherword"
    planted = [(10_001, " ".join(fresh)), (10_002, " ".join(near)), (10_003, " ".join(fresh)),
               (10_004, " ".join([*map(str, draw.permutation(words)), item]))]
    docs = spark.createDataFrame(rows + [(d, t, "en", "new", len(t)) for d, t in planted], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES[2:4]:
        docs = cp.materialize(stage(spark, docs, SF_DIR), "planted")
    kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert 10_001 in kept and not kept & {10_002, 10_003, 10_004}


def test_empty_and_odd_tables(spark):
    docs = cp.table(spark, SF_DIR, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "123 !!", None, None, None)], docs.schema)
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
        stage(spark, odd, SF_DIR).collect()
    assert cp.language(spark, odd, SF_DIR).count() == 0
    assert cp.near_copies(spark, odd, SF_DIR).where("doc_id = 1").count() == 1
