"""Extra columns with the names helpers would like to have; bounded lists on the driver."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat_layout, gated_lm, ordinal_quality, simhash_trie, template_leaks, url_alias

TEXT = "which of the seven planets near the bright sun is the largest one of all"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, TEXT), (2, TEXT), (3, " ".join(f"w{k}" for k in range(40))), (None, None)]
    names = ("_id", "_key", "stay_id", "stay_key", "_leak_id", "leak_id", "leak_key", "text_key", "rated_key", "own_key", "rated_grade", "n", "component", "r")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({n: F.lit("kept") for n in names})


def test_keep_one(docs):
    kept = simhash_trie.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["_id"]) for r in kept.collect()) == [(0, "kept"), (1, "kept"), (3, "kept")]


def test_drop_leaks(spark, docs):
    items = spark.createDataFrame([("i", TEXT)], "item_id string, text string")
    left = template_leaks.drop_leaks(docs, items)
    assert left.columns == docs.columns and sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 3]


def test_fit(spark, docs):
    graded = spark.createDataFrame([(1, 0), (2, 0), (3, 2)], "doc_id long, grade int")
    model = ordinal_quality.fit(docs, graded, 3)
    assert ordinal_quality.grade_documents(docs, model).count() == 4


def test_judge_urls(spark):
    rules = url_alias.rules_table(spark, (("a.com", "/", "block"),))
    pages = spark.createDataFrame([(1, "http://a.com/x", None), (2, None, None), (3, "no address", "<html>")], "page_id long, url string, html string")
    names = ("said", "x_rule", "x_verdict", "x_host", "k_node", "k_host", "k_said", "verdict")
    got = url_alias.judge_urls(pages.withColumns({n: F.lit("kept") for n in names}), rules).collect()
    assert sorted((r["page_id"], r["rule"], r["verdict"], r["said"], r["k_node"]) for r in got) == [
        (1, "a.com/", "block", "kept", "kept"), (2, None, "allow", "kept", "kept"), (3, None, "allow", "kept", "kept")]


def test_canonical_turns(spark):
    df = spark.createDataFrame([(1, "user", "hi", 0, "kept")], "conv_id long, role string, text string, turn long, record string").withColumn("_record", F.lit("too"))
    got = chat_layout.canonical_turns(df, F.to_variant_object(F.struct("role", "text", "turn"))).first()
    assert (got["record"], got["_record"], got["turns"][0]["text"]) == ("kept", "too", "hi")


@pytest.mark.parametrize("most", [0, 1, 2, 3, 5, 7, 8, 9, 100])
def test_least_count(spark, most):
    counts = [1, 1, 1, 2, 7, 8, 8, 1000, 70_000]
    df = spark.createDataFrame([(f"w{k}", c) for k, c in enumerate(counts)], "word string, c long")
    least = gated_lm.least_count(df, most)
    assert sum(c >= least for c in counts) <= most
    assert least == 1 or sum(c >= least - 1 for c in counts) > most
    vocabulary = gated_lm.vocabulary(df, 3, 4, most)
    assert list(vocabulary.counts) == sorted((c for c in counts if c >= least), reverse=True)
