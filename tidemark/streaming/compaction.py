"""Tiered merging of the batch folders of a streaming upsert.

``stream_graph_upsert`` writes one folder for each batch and never looks back. A compaction folds whole
batches into runs: tables with one row for each key, sorted by key, that hold all a later fold needs
(the last values and their batch, the first value of kept columns and its batch, the span of stamps).
Folding is associative, so runs fold into larger runs: ``fan`` runs of one level become one of the
next. After n batches a reader opens fewer than ``fan`` runs for each of log_fan(n) levels and at most
``fan`` batch folders.

Which runs count, and up to which batch they reach, is one small file published under the next
number. The newest batch folder is never folded: a stream may write it again after a restart, all
earlier ones are finished. What a compaction replaced is deleted by the compaction after the next
manifest, so readers that have just opened it can go on. One compaction runs at a time; a second one
fails when it publishes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import quoted
from ..sources.files import Files

FAN = 10


def batch_states(batches: DataFrame, key: str, keep: Sequence[str]) -> DataFrame:
    """Rows of batches as states of their keys: what a fold needs of them."""
    values = [c for c in batches.columns if c not in (key, "as_of", "batch_id", *keep)]
    return batches.select(
        quoted(key), F.struct(*[quoted(c) for c in values]).alias("last"), F.col("batch_id").cast("long").alias("last_batch"),
        F.struct(*[F.when(quoted(c).isNotNull(), F.struct(F.col("batch_id").cast("long").alias("batch"), quoted(c).alias("value"))).alias(c)
                   for c in keep if c in batches.columns] or [F.lit(0).alias("none")]).alias("first"),
        F.col("as_of").alias("first_as_of"), F.col("as_of").alias("last_as_of"), F.lit(1).cast("long").alias("n"))


def fold_states(states: DataFrame, key: str) -> DataFrame:
    """One state for each key; states may come from batches or from folds."""
    kept = [f.name for f in states.schema["first"].dataType.fields]
    first = F.struct(*[F.min(F.col("first")[c]).alias(c) for c in kept])
    return states.groupBy(quoted(key)).agg(
        F.max_by("last", "last_batch").alias("last"), F.max("last_batch").alias("last_batch"), first.alias("first"),
        F.min("first_as_of").alias("first_as_of"), F.max("last_as_of").alias("last_as_of"), F.sum("n").alias("n"))


def nodes_of(states: DataFrame, key: str) -> DataFrame:
    """The node table that folded states stand for."""
    kept = [f.name for f in states.schema["first"].dataType.fields if f.name != "none"]
    return states.select(
        quoted(key), "last.*", *[F.col("first")[c]["value"].alias(c) for c in kept], F.lit("FULL").alias("hydrated"),
        F.col("first_as_of").alias("record_created_at"), F.when(F.col("n") > 1, F.col("last_as_of")).alias("record_updated_at"))


class BatchLog:
    """The batch folders below ``path`` and the runs that older ones are folded into."""

    def __init__(self, spark: SparkSession, path: str, key: str = "id", keep: Sequence[str] = ("created_at",), fan: int = FAN):
        if fan < 2:
            raise ValueError("fan must be 2 or more")
        self.spark, self.path, self.key, self.keep, self.fan = spark, path.rstrip("/"), key, list(keep), fan
        self.files = Files(spark)

    def manifest(self) -> tuple[int, dict]:
        """(number, content) of the last manifest; number 0 before the first."""
        numbers = [int(n.removesuffix(".json")) for n in self.files.names(f"{self.path}/_runs/manifests") if n.endswith(".json")]
        if not numbers:
            return 0, {"upto": -1, "runs": [], "replaced": []}
        return max(numbers), json.loads(self.files.read(f"{self.path}/_runs/manifests/{max(numbers):010d}.json"))

    def open_batches(self, upto: int) -> list[int]:
        """Numbers of the batch folders after ``upto``."""
        found = [int(n.removeprefix("batch_id=")) for n in self.files.names(self.path) if n.startswith("batch_id=")]
        return sorted(b for b in found if b > upto)

    def folders(self) -> list[str]:
        """What a reader opens now."""
        _, content = self.manifest()
        return [*(r["folder"] for r in content["runs"]), *(f"batch_id={b}" for b in self.open_batches(content["upto"]))]

    def _batches(self, numbers: Sequence[int]) -> DataFrame:
        return self.spark.read.option("basePath", self.path).parquet(*[f"{self.path}/batch_id={b}" for b in numbers])

    def _states(self, runs: Sequence[dict], numbers: Sequence[int]) -> DataFrame | None:
        states = batch_states(self._batches(numbers), self.key, self.keep) if numbers else None
        if runs:
            old = self.spark.read.parquet(*[f"{self.path}/{r['folder']}" for r in runs])
            states = old if states is None else states.unionByName(old)
        return states

    def read(self) -> DataFrame:
        """The node table after all batches, as ``read_nodes`` gives it from the batches themselves."""
        _, content = self.manifest()
        states = self._states(content["runs"], self.open_batches(content["upto"]))
        if states is None:
            raise FileNotFoundError(f"{self.path}: no batch yet")
        return nodes_of(fold_states(states, self.key), self.key)

    def compact(self) -> int:
        """Fold finished batches if there are ``fan`` or more; returns how many were folded."""
        number, content = self.manifest()
        finished = self.open_batches(content["upto"])[:-1]
        if len(finished) < self.fan:
            return 0
        runs, merged, count = list(content["runs"]), [], len(finished)
        level = 1
        while count >= self.fan ** (level + 1):
            level += 1
        # As many runs of a level as make one of the next are written once, into the run they end in.
        while len(runs) >= self.fan - 1 and all(r["level"] <= level for r in runs[-(self.fan - 1):]):
            merged = runs[-(self.fan - 1):] + merged
            runs, level = runs[:-(self.fan - 1)], level + 1
        folder = f"_runs/data/{uuid.uuid4().hex}"
        states = fold_states(self._states(merged, finished), self.key)
        states.repartitionByRange(quoted(self.key)).sortWithinPartitions(quoted(self.key)).write.parquet(f"{self.path}/{folder}")
        runs.append({"level": level, "folder": folder, "first": merged[0]["first"] if merged else finished[0], "upto": finished[-1]})
        body = {"upto": finished[-1], "runs": runs, "replaced": [*(r["folder"] for r in merged), *(f"batch_id={b}" for b in finished)]}
        if not self.files.create(f"{self.path}/_runs/manifests/{number + 1:010d}.json", json.dumps(body)):
            raise RuntimeError(f"{self.path}: another compaction was faster")
        for old in content["replaced"]:
            self.files.delete(f"{self.path}/{old}")
        return len(finished)
