"""Distributed building blocks against plain Python, with one key or order holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark import operators as op
from tidemark.operators import scale


def test_number_rows_is_total_and_dense(spark):
    values = [(i, i % 3) for i in range(5000)]
    random.Random(1).shuffle(values)
    df = spark.createDataFrame(values, "id LONG, k LONG")
    got = op.number_rows(df, ["k", F.desc("id")]).collect()
    want = sorted(values, key=lambda t: (t[1], -t[0]))
    assert [(r.id, r.k) for r in sorted(got, key=lambda r: r.row_no)] == want
    assert sorted(r.row_no for r in got) == list(range(5000))


@pytest.mark.parametrize("limit", [64 << 20, -1])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, rows, how, limit, monkeypatch):
    monkeypatch.setattr(scale, "BROADCAST_BYTES", limit)
    hot = [(i, 7) for i in range(3000)]
    rest = [(3000 + i, i) for i in range(3000)] + [(9000 + i, None) for i in range(500)]
    facts = spark.createDataFrame(hot + rest, "id LONG, k LONG")
    keyed = spark.createDataFrame([(k, f"v{k}") for k in range(0, 2000, 7)], "k LONG, v STRING")
    got = scale.salted_join(facts, keyed, "k", how, ["id"])
    assert rows(got) == rows(facts.join(keyed, "k", how))


def test_salted_join_spreads_the_hot_key(spark, monkeypatch):
    monkeypatch.setattr(scale, "BROADCAST_BYTES", -1)
    facts = spark.range(20000).select("id", F.lit(1).alias("k"))
    keyed = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = scale.salted_join(facts, keyed, "k", "inner", ["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20000 and len(sizes) >= 6 and max(sizes) < 6000


def test_lookup_join_beyond_the_size_limit(spark, rows, monkeypatch):
    facts = spark.range(4000).select("id", (F.col("id") % 3).alias("k"))
    lookup = spark.createDataFrame([(0, "a"), (0, "b"), (2, "c")], "k LONG, v STRING")
    small = rows(scale.lookup_join(facts, lookup, "k", ["id"]))
    monkeypatch.setattr(scale, "BROADCAST_BYTES", -1)
    assert rows(scale.lookup_join(facts, lookup, "k", ["id"])) == small
    assert len(small) == 1334 * 2 + 1333


def test_running_before(spark):
    values = [random.Random(2).randrange(100) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(values)), "n LONG, v LONG")
    got = op.running_before(df, "n", "v", "before", F.floor(F.col("n") / 16)).collect()
    assert {r.n: r.before for r in got} == {i: sum(values[:i]) for i in range(200)}


@pytest.mark.parametrize("block", [5, 64, 100000])
def test_rolling_rate_across_blocks(spark, block):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.8 else f"n{i % 4}", i, rng.randrange(1, 9), rng.randrange(50))
            for i in range(400)]
    df = spark.createDataFrame(data, "name STRING, k LONG, dur LONG, val LONG")
    got = {r.k: (r.rate, r.total) for r in
           op.rolling_rate(df, "name", "k", "dur", "val", n=5, block=block).collect()}
    by_name = {}
    for name, k, dur, val in data:
        seen = by_name.setdefault(name, [])
        seen.append((dur, val))
        last = seen[-5:]
        assert got[k] == (sum(v for _, v in last) / sum(d for d, _ in last), sum(v for _, v in seen))
    assert len(got) == len(data)


def test_dedupe_picks_by_order(spark, rows):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), ("b", None, "z"), ("b", 3, "w"), (None, 1, "n"), (None, 0, "m")],
        "k STRING, seq INT, v STRING",
    )
    assert rows(op.dedupe_keep_first(df, ["k"], ["seq"])) == [("a", 1, "y"), ("b", None, "z"), (None, 0, "m")]
    assert rows(op.dedupe_keep_last(df, ["k"], ["seq"])) == [("a", 2, "x"), ("b", 3, "w"), (None, 1, "n")]


def test_numbering_keeps_odd_column_names(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "`row no` INT, `a,b;(c)=` STRING")
    assert sorted((r[2], r[0], r[1]) for r in op.number_rows(df, [F.col("`row no`")]).collect()) == [
        (0, 1, "a"), (1, 2, "b")]


def test_dedupe_aggregates_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = op.dedupe_keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    before = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[:before] and "Partial" in plan[before:]


def test_salted_join_reads_facts_once_when_the_keys_are_few(spark):
    facts = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    keyed = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    plan = scale.salted_join(facts, keyed, "o_custkey")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") == 1 and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_with_a_lower_bound_and_known_counts(spark, rows, how):
    """A table over the caller's bound is not broadcast, and given counts find the hot key without a look at the facts."""
    facts = spark.range(4_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).alias("k"), "id")
    keyed = spark.range(0, 4_000, 2).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    counts = spark.createDataFrame([(0, 2_667), (6, 1)], "k long, _n long")
    got = scale.salted_join(facts, keyed, "k", how, ["id"], 1_000, counts)
    assert rows(got) == rows(facts.join(keyed, "k", how))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = scale.salted_join(facts, keyed, "k", how, ["id"], 1_000, counts)._jdf.queryExecution().executedPlan().toString()
        # Only the hot keys are sent, once for each side.
        assert plan.count("BroadcastExchange") <= 2 and "SortMergeJoin" in plan
        assert "SortMergeJoin" not in scale.salted_join(facts, keyed, "k", how, ["id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
