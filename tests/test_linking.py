"""Whole-word links against Python's own word boundaries, for every term and text."""

import random
import re

import pytest

from tidemark import operators as op
from tidemark.operators import scale

TERMS = [
    "ring", "Red Ring", "red", "vitamin b 12", "vitamin b 6", "a-b", "a-b-c", "(x)", "x)", "(x", "--", "-",
    "é", "été d'or", "c++", "b", "12", "of the", "the", "the  end", "_u", "u_v", "ss", ".",
]
TEXTS = [
    "", "ring", "RING-fence", "the red ring, red.", "redring red ringed", "vitamin b 12 and vitamin b 1",
    "a-b", "a-b-c", "aa-bb", "x(x)x", "(x)", "y(x)", "x)y", "a--b", "--", "a-b--c", "été d'or", "l'été",
    "c++", "c++x", "xc++d", "b12", "of  the", "of the end", "the  end", "_u", "u_v", "u", "STRASSE ss",
    "a.b", "...", "a", None, "12 b 12", "  ring  ",
]


def brute(terms, texts):
    out = set()
    for t in terms:
        found = re.compile(rf"\b{re.escape(t.lower())}\b")
        out |= {(t.lower(), i) for i, x in enumerate(texts) if x is not None and found.search(x.lower())}
    return out


def link(spark, terms, texts):
    t = spark.createDataFrame([(t,) for t in terms], "term STRING")
    x = spark.createDataFrame(list(enumerate(texts)), "key LONG, text STRING")
    got = [tuple(r) for r in op.word_boundary_link(t, x, "term", "key", "text").collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_by_hand(spark):
    assert link(spark, TERMS, TEXTS) == brute(TERMS, TEXTS)


@pytest.mark.parametrize("limit", [64 << 20, -1])
def test_random_texts(spark, monkeypatch, limit):
    monkeypatch.setattr(scale, "BROADCAST_BYTES", limit)
    rng = random.Random(11)
    bits = ["the", "a", "b", "ring", "été", "-", " ", " ", " ", ".", "(", ")", "12", "_", "--", "  "]
    texts = ["".join(rng.choices(bits, k=rng.randrange(30))) for _ in range(300)]
    terms = list({"".join(rng.choices(bits, k=rng.randrange(1, 5))) for _ in range(200)})
    assert link(spark, terms, texts) == brute(terms, texts)


def test_single_words_only(spark):
    words = ["ring", "Red", "é", "_u", "12", "the", "absent"]
    assert link(spark, words, TEXTS) == brute(words, TEXTS)


def test_no_terms(spark):
    assert link(spark, [], TEXTS) == link(spark, [""], TEXTS) == set()


def test_phrases(spark):
    x = spark.createDataFrame(
        [(1, "Say The End."), (2, "the ending"), (3, "c++ (now)"), (4, None), (5, "anathe end")],
        "id INT, t STRING",
    )
    def hits(*p):
        return [r.id for r in x.where(op.match_any_phrase(x.t, p)).orderBy("id").collect()]
    assert hits("the end") == [1]
    assert hits("THE", "c++") == [1, 2, 3]
    assert hits("(now)") == [3] and hits() == []


def test_topics(spark, rows):
    x = spark.createDataFrame([(1, "red ring and blue"), (2, "nothing"), (3, "Blue")], "id INT, t STRING")
    topics = spark.createDataFrame(
        [("colour", "red"), ("colour", "blue"), ("shape", "red ring"), ("sea", "Blue")],
        "topic STRING, phrase STRING",
    )
    assert rows(op.tag_topics(x, "id", "t", topics)) == [(1, ["colour", "sea", "shape"]), (3, ["colour", "sea"])]
