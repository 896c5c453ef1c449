"""Runs against a search over all periods and places; planted repetitions, collapsing, odd tables."""

import hashlib
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries, word_runs
from tidemark.llm.shared import table

SF_DIR = "/root/testdata/sf0.001"


def slow_runs(w):
    """Every maximal stretch of every period, kept if no smaller period fits it."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            e = i
            while e < n and w[e] == w[e - q]:
                e += 1
            s = i - q
            smallest = not any(all(w[k] == w[k - p] for k in range(s + p, e)) for p in range(1, q))
            if e - s >= max(6, 4 * q) and smallest:
                out.append((s, e - s, q))
            i = e
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_collapse(w, runs):
    drop = {k for s, n, q in runs for k in range(s + q, s + n)}
    return [x for k, x in enumerate(w) if k not in drop]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9)), max_size=8))
def test_same_as_slow(parts):
    w = [x for unit, times in parts for x in unit * times]
    runs = word_runs.find_runs(w)
    assert runs == slow_runs(w)
    assert word_runs.collapse(w, runs) == slow_collapse(w, runs)


def test_random_texts_of_few_words():
    draw = np.random.default_rng(3)
    for _ in range(200):
        n, k = int(draw.integers(0, 160)), int(draw.integers(1, 5))
        w = draw.integers(0, k, n).tolist()
        if n > 60:
            p = int(draw.integers(1, 30))
            w[20:] = [w[20 + i % p] for i in range(n - 20)]
        assert word_runs.find_runs(w) == slow_runs(w)


def test_long_uniform_texts_take_linear_steps():
    start = time.perf_counter()
    assert word_runs.find_runs(["a"] * 100_000) == [(0, 100_000, 1)]
    assert word_runs.find_runs(["a", "b"] * 50_000) == [(0, 100_000, 2)]
    unit = [str(k) for k in range(7_000)]
    assert word_runs.find_runs(unit * 5) == [(0, 35_000, 7_000)]
    assert time.perf_counter() - start < 20


def test_query_same_as_slow(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_word_runs"](spark, SF_DIR).collect()}
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    with_runs = 0
    for d in docs:
        w = (d["text"] or "").encode().split()
        h, n = zlib.crc32(str(d["doc_id"]).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 900:
            continue
        runs, r = slow_runs(w), got[d["doc_id"]]
        with_runs += bool(runs)
        assert r["n_runs"] == len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(slow_collapse(w, runs))).hexdigest()
    assert with_runs > 5


@pytest.mark.parametrize("operator", [word_runs.periodic_runs, word_runs.run_digests])
def test_odd_tables(spark, operator):
    again = "la " * 50
    rows = [(None, None, 1, "x"), (1, "", 1, "x"), (1, "", 1, "x"), (2, " \t\n", 1, "x"), (3, again, 1, "x"), (3, again, 1, "x"), (None, again, 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_runs int, collapsed string")
    got = operator(df).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_runs"], r["period"]) for r in got) == [
        (False, 1, 0, None), (False, 1, 0, None), (False, 2, 0, None), (False, 3, 1, 1), (False, 3, 1, 1), (True, 0, 0, None), (True, 0, 1, 1)]
    assert operator(df.limit(0)).count() == 0


def test_operator_gives_texts_and_spans(spark):
    df = spark.createDataFrame([(1, "see  a b a b\na b a b end end end end end end")], "doc_id long, text string")
    r = word_runs.periodic_runs(df).first()
    assert r["runs"] == [[1, 8, 2], [9, 6, 1]] and r["collapsed"] == "see a b end" and (r["start"], r["exponent_milli"]) == (1, 4000)
