"""Code lengths against a slow dictionary version; held-out accuracy; odd tables."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import context_trees as ct

TRAIN = [("en", "the cat sat on the mat and the hat"), ("en", "that is the thing"), ("de", "der Hund läuft über die Straße"),
         ("de", "das ist der Hund"), ("fr", "le chat est là, où le vent va")]
ODD = ["the der le", "xyz", "ß", "日本", "a", "Straße the", "zzzz the \x00 x"]


def slow(train, order):
    """code(lang, text) by dictionaries, straight from the definition."""
    counts = {}
    for lang, text in train:
        raw = bytes(order) + text.encode()
        for i in range(order, len(raw)):
            for k in range(order + 1):
                counts.setdefault(lang, defaultdict(lambda: defaultdict(int)))[raw[i - k:i]][raw[i]] += 1

    def bits(lang, context, byte):
        seen = counts[lang].get(context)
        if seen:
            n, q = sum(seen.values()), len(seen)
            if byte in seen:
                return -math.log2(seen[byte] / (n + q))
            price = -math.log2(q / (n + q))
        else:
            price = 0.0
        return price + (bits(lang, context[1:], byte) if context else 8.0)

    def code(lang, text):
        raw = bytes(order) + text.encode()
        return sum(bits(lang, raw[i - order:i], raw[i]) for i in range(order, len(raw)))

    return code


@pytest.mark.parametrize("order", [0, 1, 2, 3, 4])
def test_code_lengths(spark, order):
    train = spark.createDataFrame(TRAIN, "lang string, text string").repartition(3)
    trees = ct.learn(train, order)
    assert trees.langs == ["de", "en", "fr"]
    code = slow(TRAIN, order)
    texts = [*ODD, "", *(t for _, t in TRAIN)]
    bits, sizes = ct.code_lengths(trees, texts)
    assert sizes.tolist() == [len(t.encode()) for t in texts]
    for t, got in zip(texts, bits, strict=True):
        np.testing.assert_allclose(got, [code(x, t) for x in trees.langs], rtol=1e-4, atol=1e-3)


def test_windows_over_texts_and_batches():
    texts = ["abc", "", "x", "abcabc" * 5]
    data, starts = ct._bytes_of(texts, 3)
    got = sorted(ct._windows(data, starts, 3).tolist())
    want = sorted(int.from_bytes((b"\0\0\0" + t.encode())[i:i + 4], "big") for t in texts for i in range(len(t)))
    assert got == want


@pytest.mark.parametrize("order", [0, 1, 3])
def test_joins_give_the_same_code_lengths(spark, order):
    """Far more windows than a task may hold: the same code lengths, from all counts."""
    train = spark.createDataFrame(TRAIN, "lang string, text string")
    tables, code = ct.learn(train, order, max_windows=5), slow(TRAIN, order)
    assert isinstance(tables, ct.Tables)
    texts = [t for t in [*ODD, *(t for _, t in TRAIN)] if t.strip()]
    rows = [(k, t) for k, t in enumerate([*texts, texts[0], None, "", "12 3"])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_key", F.lit("kept"))
    got = {r["doc_id"]: r for r in ct.identify(df, tables).collect()}
    tree = {r["doc_id"]: r for r in ct.identify(df, ct.learn(train, order)).collect()}
    assert len(got) == len(rows) and {r["text_key"] for r in got.values()} == {"kept"}
    for k, t in rows:
        assert got[k]["lang_pred"] == tree[k]["lang_pred"]
        assert got[k]["score"] == pytest.approx(tree[k]["score"], rel=1e-3)
        if t and got[k]["lang_pred"] != "und":
            bits = [code(x, t) / len(t.encode()) for x in tables.langs]
            assert got[k]["bits_per_byte"] == pytest.approx(min(bits), rel=1e-9)


def test_a_rare_language_keeps_its_contexts(spark):
    """One language has nearly all rows; with the tables a text of the other is still told from its few windows."""
    train = spark.createDataFrame([TRAIN[0]] * 300 + [("eo", "ĝi estas la ŝipo de la ĉevalo")], "lang string, text string")
    tables = ct.learn(train, 3, max_windows=10)
    df = spark.createDataFrame([(1, "la ŝipo estas ĉevalo"), (2, "the cat on the hat"), (None, "ĝi estas")], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in ct.identify(df, tables).collect()) == [(0, "eo"), (1, "eo"), (2, "en")]
    assert ct.identify(df.limit(0), tables).count() == 0


def test_tables(spark):
    train = spark.createDataFrame([*TRAIN, (None, "x"), ("en", None), ("en", "")], "lang string, text string")
    trees = ct.learn(train)
    rows = [(1, "the cat", "q"), (2, None, "q"), (3, "", "q"), (4, "123 !!", "q"), (None, "der Hund", "q"), (1, "the cat", "q")]
    got = ct.identify(spark.createDataFrame(rows, "doc_id long, text string, score string"), trees).collect()
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in got) == [
        (0, "de"), (1, "en"), (1, "en"), (2, "und"), (3, "und"), (4, "und")]
    assert all(0 <= r["score"] <= 1 for r in got)
    assert ct.identify(spark.createDataFrame(rows, "doc_id long, text string, score string").limit(0), trees).count() == 0
    nothing = ct.learn(train.limit(0))
    assert {r["lang_pred"] for r in ct.identify(spark.createDataFrame(rows, "doc_id long, text string, k string"), nothing).collect()} == {"und"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    side = F.crc32(F.col("doc_id").cast("string")) % 3
    got = ct.identify(docs.where(side == 1), ct.learn(docs.where(side != 1)))
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.97
