"""Gradients by differences, probabilities that sum to one, windows, counts, held-out gain."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import gated_lm as g


def small(n_words=7, hidden=5, dtype=np.float64):
    counts = np.concatenate([[4], np.arange(n_words, 0, -1), np.arange(g.TAILS)]).astype(float)
    lay = g.layout(counts, classes=3)
    p = {k: v.astype(dtype) for k, v in g.start_parameters(counts, lay, 4, hidden).items()}
    p["wc"] *= 5
    p["ww"] *= 5
    return g.Network(p, lay), len(counts)


def test_probabilities_sum_to_one():
    net, n = small()
    states = np.random.default_rng(0).normal(size=(3, 5))
    total = sum(np.exp(net.output(states, np.full(3, k))[0]) for k in range(n))
    np.testing.assert_allclose(total, 1)


def test_start_is_the_unigram_distribution():
    net, n = small()
    logp, _ = net.output(np.zeros((n, 5)), np.arange(n))
    counts = np.concatenate([[4], np.arange(7, 0, -1), np.arange(g.TAILS)]) + 0.5
    np.testing.assert_allclose(np.exp(logp), counts / counts.sum(), rtol=1e-5)


def test_gradients(monkeypatch):
    monkeypatch.setattr(np, "float32", np.float64)
    net, n = small()
    draw = np.random.default_rng(1)
    given, wanted = draw.integers(0, n, (6, 4)), draw.integers(0, n, (6, 4))
    start = draw.random((6, 4)) < 0.2
    h = draw.normal(size=(4, 5))
    _, grad, _ = net.gradients(given, wanted, h, start)

    def loss():
        states, _, _ = net.forward(given, h, start)
        return -net.output(states.reshape(-1, 5), wanted.reshape(-1))[0].sum()

    for name, x in net.p.items():
        for at in map(tuple, np.argwhere(np.ones(x.shape))[draw.integers(0, x.size, 12)]):
            keep, eps = x[at], 1e-5
            x[at] = keep + eps
            up = loss()
            x[at] = keep - eps
            down = loss()
            x[at] = keep
            assert grad[name][at] == pytest.approx((up - down) / 2 / eps, rel=1e-4, abs=1e-6), name


def test_state_is_carried_over_windows_and_lanes():
    net, n = small(dtype=np.float32)
    draw = np.random.default_rng(2)
    docs = [draw.integers(0, n, k).astype(np.int32) for k in (0, 1, 5, 90, 3, 17, 40)]
    one = np.array([g.score_documents(net, [d], 1000)[0] for d in docs])
    for window, lanes in ((1, 1), (4, 3), (16, 2), (7, 100)):
        np.testing.assert_allclose(g.score_documents(net, docs, window, lanes), one, rtol=1e-4)
    # Whole documents, one step at a time, from the definition.
    for d, got in zip(docs, one, strict=True):
        h, total = np.zeros((1, 5), np.float32), 0.0
        for given, wanted in zip([g.END, *d], [*d, g.END], strict=True):
            states, h, _ = net.forward(np.array([[given]]), h, np.array([[False]]))
            total += net.output(states[0], np.array([wanted]))[0][0]
        assert got == pytest.approx(total, rel=1e-4)


def test_lanes_hold_every_token_once():
    docs = [np.arange(k, dtype=np.int32) + 1 for k in (3, 0, 50, 2, 2)]
    lanes = g.lanes_of(docs, 3)
    seen = Counter()
    for a, b, n in g.windows(lanes, 4):
        seen.update(zip(lanes.owner[a:b, :n].ravel().tolist(), lanes.wanted[a:b, :n].ravel().tolist(), strict=True))
    assert seen == Counter((k, t) for k, d in enumerate(docs) for t in [*d.tolist(), g.END])


def test_counts_and_scores(spark, monkeypatch):
    monkeypatch.setattr(g, "FREQUENT", 12)
    texts = ["a b a", "a c d e f g", "", None, "q r s t u v w", "A B zz!", "a b a", "ß ü ß\x0bq", "only here"] * 3
    rows = [(i, t, i % 4 != 0) for i, t in enumerate(texts)] + [(None, "a a lost", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lesson boolean").repartition(3)
    counts = g.materialize(g.count_words(docs.where("lesson and doc_id is not null")), "t")
    voc = g.vocabulary(counts, docs.where("lesson and doc_id is not null").count(), model_words=5, frequent=12)
    coded = g.encode(docs, voc)
    net = g.train(coded.where("lesson and doc_id is not null"), voc, rounds=2)
    got = g.score(coded, net, voc, counts).collect()
    want = Counter()
    lessons = [t for i, t, l in rows if l and i is not None]
    for t in lessons:
        want.update(["\0end", *(w.decode() for w in g.words_of(t))])
    n, v = sum(want.values()), len(want)
    assert (voc.n_tokens, voc.n_different) == (n, v)
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        tokens = [*(w.decode() for w in g.words_of(t)), "\0end"]
        r = by_id[i]
        assert r["n_tokens"] == len(tokens) and r["n_known"] == sum(want[w] > 0 for w in tokens)
        assert r["base_score"] == pytest.approx(sum(math.log10((want[w] + 1) / (n + v + 1)) for w in tokens))
        # The network's part, and the share of each word behind its tail symbol.
        x = [voc.words.index(w.encode()) + 1 if w.encode() in voc.words[:5] else 6 + g.tail_of(w.encode()) for w in tokens[:-1]]
        own = g.score_documents(net, [np.array(x, np.int32)])[0] / g.LOG10
        for k, w in zip(x, tokens[:-1], strict=True):
            if k >= 6:
                own += math.log10((want[w] + 1) / (voc.tail_tokens[k - 6] + voc.tail_words[k - 6] + 1))
        assert r["score"] == pytest.approx(own, rel=1e-4)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = g.learn_and_score(docs.limit(0).withColumn("lesson", F.lit(True)), "lesson")
    assert none.count() == 0
    untaught = g.learn_and_score(docs.withColumn("lesson", F.lit(False)), "lesson").collect()
    assert [(r["n_known"], r["base_score"], r["train_tokens"]) for r in untaught] == [(0, 0.0, 0)] * 2


def test_held_out_texts_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    got = g.learn_and_score(docs.withColumn("lesson", ~held), "lesson").where("not lesson").agg(
        F.sum("score"), F.sum("base_score"), F.sum("n_tokens"), F.avg((F.col("score") > F.col("base_score")).cast("int"))).first()
    assert got[0] > got[1] + 0.2 * got[2] and got[3] > 0.9
