"""Small helpers the operators of this folder share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import collect_garbage, forget, materialize
from ..session import prepare as prepare_session

__all__ = ["collect_garbage", "components", "forget", "materialize", "prepare", "fresh", "table"]


# Rows and bytes of text that Spark hands to a Python task at once.
BATCH_ROWS, BATCH_BYTES = 1_000, 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """The package's session settings, and small Arrow batches: rows here hold whole texts.

    Python tasks get the package's folder on their path, where it exists on their machine.
    """
    prepare_session(spark)
    home = str(Path(__file__).resolve().parents[2])
    given = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in given.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, given]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use (names compare without case, as in Spark)."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name = f"_{name}"
    return name


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of an edge list: rows (node, component), component = smallest node.

    Alternates the two star operations (large star: link every larger neighbour to the smallest
    known neighbour; small star: link every smaller neighbour to it) until the edges stop
    changing. Each step is a partial minimum per node and one join to it; the minima are written
    to the shared folder first, so that both inputs of the join are plain exchanges and Spark can
    split the rows of a very connected node. Tables of a round are removed when the next one is stored. Nodes without an edge to another node are not
    returned. Null ends and self links are ignored.
    """
    state = (
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"),
                     F.col(a).alias("_a"), F.col(b).alias("_b"))
        .where(F.col("_a").isNotNull() & F.col("_b").isNotNull() & (F.col("hi") != F.col("lo")))
        .select("hi", "lo").distinct()
    )
    state = materialize(state, "edges")
    seen = _mark(state)
    while seen[0]:
        both = state.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            state.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        first = least = materialize(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = (
            both.where(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo")).where(F.col("hi") != F.col("lo"))
        )
        # Every node that is not the smallest of its neighbours keeps its link to the smallest.
        kept = least.where(F.col("m") < F.col("u")).select(F.col("u").alias("hi"), F.col("m").alias("lo"))
        large = materialize(large.unionByName(kept).distinct(), "large")
        least = materialize(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        small = (
            large.join(least, "hi").where(F.col("lo") != F.col("m"))
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionByName(least.select("hi", F.col("m").alias("lo")))
        )
        before, state = state, materialize(small.distinct(), "edges")
        forget(before, first, large, least)
        now = _mark(state)
        if now == seen:
            break
        seen = now
    stars = state.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return stars.unionByName(
        stars.select(F.col("component").alias("node"), "component").distinct())
