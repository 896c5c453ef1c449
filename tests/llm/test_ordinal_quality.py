"""Ordinal regression: gradient, ordering, held-out grades, odd tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ordinal_quality as oq


def test_features_are_whole_text_and_order_free():
    assert oq.features("").tolist() == []
    a, b = oq.features("alpha beta gamma"), oq.features("gamma alpha beta")
    assert a.tolist() == b.tolist()
    assert set(oq.word_features("omega")) <= set(oq.features("alpha " * 50_000 + "omega").tolist())


def test_scores_are_sums_of_weights():
    draw = np.random.default_rng(1)
    model = oq.Ordinal((draw.normal(size=1 << oq.BITS) * (draw.random(1 << oq.BITS) < 0.5)).astype(np.float32), np.array([-1.0, 1.0]))
    texts = ["", "One two two THREE!!", "größe ähnlich ßß", "a b c d " * 40]
    want = [model.weights[oq.features(t)].astype(np.float64).sum() for t in texts]
    np.testing.assert_allclose(oq.score_texts(model, texts), want, rtol=1e-9, atol=1e-9)
    tails = model.tails(np.array([-2.0, 0.0, 3.0]))
    assert (np.diff(tails, axis=1) < 0).all() and (np.diff(tails, axis=0) > 0).all()
    np.testing.assert_allclose(tails[1], [1 / (1 + np.exp(-1)), 1 / (1 + np.exp(1))])


def test_learns_an_order():
    rows = [oq.features(t) for t in ("vile rant", "plain note", "fine essay")] * 60
    model = oq.fit_rows(rows, np.array([0, 1, 2] * 60), 3, rounds=10)
    assert model.thresholds[0] < model.thresholds[1]
    s = oq.score_texts(model, ["vile rant", "plain note", "fine essay"])
    assert s[0] < s[1] < s[2]
    expected = model.tails(s).sum(axis=1)
    assert expected[0] < 0.6 and expected[2] > 1.4


def test_held_out_grades(spark):
    base = "/root/testdata/sf0.1/"
    docs, graded = spark.read.parquet(base + "documents.parquet"), oq.ratings(spark.read.parquet(base + "labels.parquet"))
    held = F.xxhash64("doc_id") % 5 == 0
    model = oq.fit(docs, graded.where(~held), 3)
    got = oq.grade_documents(docs.join(graded.where(held), "doc_id"), model).toPandas()
    chosen = got["tail"] >= oq.LEAST_TAIL
    assert chosen[got["grade"] == 2].mean() > 0.98
    assert chosen[got["grade"] == 0].mean() < 0.3
    assert chosen[got["grade"] == 1].mean() < 0.4


def test_tables(spark):
    rows = [(1, None, 0, "x"), (2, "", 1, "x"), (3, "good text", 2, "x"), (3, "good text", 2, "x"), (None, "word", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, grade int, tail string")
    model = oq.fit(df.drop("grade"), df.select("doc_id", "grade"), 3)
    got = oq.grade_documents(df, model)
    assert got.columns == ["doc_id", "text", "grade", "expected_grade", "tail"] and got.count() == 5
    assert got.where("tail between 0 and 1 and expected_grade between 0 and 2").count() == 5
    assert oq.grade_documents(df.limit(0), model).count() == 0
    none = oq.fit(df, df.select("doc_id", "grade").limit(0), 3)
    assert oq.grade_documents(df, none).where("tail > 0.999999").count() == 5
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 1, 0), (4, None, None), (5, 0, 1)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, oq.ratings(labels).collect())) == [(1, 0), (2, 1), (3, 2), (5, 0)]


def test_sample_is_bounded_and_independent_of_partitions(spark):
    rows = [(i, f"word{i % 7} text{i}", i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    a, b = (oq.fit(df.repartition(n).drop("grade"), df.select("doc_id", "grade").repartition(n), 3, max_rows=100) for n in (2, 7))
    np.testing.assert_array_equal(a.weights, b.weights)
    assert a.thresholds.tolist() == pytest.approx(b.thresholds.tolist())
