"""Tables kept in hash buckets of their key, changed by copy on write.

A table's rows lie in ``buckets`` folders by a hash of the key columns. A change reads and rewrites
only the buckets that its keys fall in; all other buckets stay as they are, shared by the old and the
new version. What a version consists of is one small file, the manifest, that names the folder of
every bucket of every table. It is created under the number of the version, which fails if that
number is taken: a version is either published as a whole, for all tables together, or not at all,
and two writers cannot both follow the same version. Readers of an older version are not disturbed;
``vacuum`` removes folders that no version in reach names.

    root/manifests/0000000007.json      {"batch": 12, "tables": {"tweets": {"3": "data/.../store_bucket=3"}}}
    root/data/<write>/<table>/store_bucket=<b>/part-*.parquet

A manifest grows with the number of buckets and tables, not with rows. Changes carry a batch number:
one that is not above the last published number is known to be written already and changes nothing,
so a stream may repeat its batches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scale import salted_join
from .files import Files

BUCKETS = 64


class VersionTakenError(RuntimeError):
    """Another writer published the next version first; the change has to start again from it."""


class BucketStore:
    """Versioned tables; ``tables`` gives each one's schema (as DDL) and key columns."""

    def __init__(
        self, spark: SparkSession, root: str, tables: Mapping[str, tuple[str, Sequence[str]]], buckets: int = BUCKETS,
    ):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.schemas = {n: spark.createDataFrame([], ddl).schema for n, (ddl, _) in tables.items()}
        self.keys = {n: list(keys) for n, (_, keys) in tables.items()}
        self.files = Files(spark)

    # --- versions ---------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.files.names(f"{self.root}/manifests") if n.endswith(".json"))

    def version(self) -> int:
        """The last published version; 0 before the first."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version == 0:
            return {"batch": -1, "tables": {}, "counters": {}}
        return json.loads(self.files.read(f"{self.root}/manifests/{version:010d}.json"))

    # --- reading ----------------------------------------------------------------------------

    def bucket_of(self, table: str, columns: Sequence[str | Column] | None = None) -> Column:
        """The bucket of a key; ``columns`` name the key in another table. Values are compared as the table's types."""
        kinds = [self.schemas[table][k].dataType for k in self.keys[table]]
        given = [F.col(c) if isinstance(c, str) else c for c in (columns or [f"`{k}`" for k in self.keys[table]])]
        return F.pmod(F.xxhash64(*[c.cast(k) for c, k in zip(given, kinds, strict=True)]), F.lit(self.buckets)).cast("int")

    def read(self, table: str, version: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """A table, or only some of its buckets, at a version."""
        folders = self.manifest(version)["tables"].get(table, {})
        wanted = folders if buckets is None else {str(b): folders[str(b)] for b in buckets if str(b) in folders}
        if not wanted:
            return self.spark.createDataFrame([], self.schemas[table])
        return self.spark.read.schema(self.schemas[table]).parquet(*[f"{self.root}/{wanted[b]}" for b in sorted(wanted, key=int)])

    def touched(self, table: str, rows: DataFrame, columns: Sequence[str | Column] | None = None) -> set[int]:
        """Buckets that keys of ``rows`` fall in; at most as many numbers as there are buckets."""
        return {r[0] for r in rows.select(self.bucket_of(table, columns).alias("b")).distinct().collect()}

    def lookup(self, table: str, rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """Stored rows whose key is among those of ``rows``; only the buckets of those keys are read."""
        names = list(columns or self.keys[table])
        part = self.read(table, buckets=self.touched(table, rows, names))
        wanted = rows.select(*[F.col(c).cast(part.schema[k].dataType).alias(k) for c, k in zip(names, self.keys[table], strict=True)])
        return salted_join(part, wanted.distinct(), self.keys[table], "left_semi", [c for c in part.columns if c not in self.keys[table]])

    # --- changing ---------------------------------------------------------------------------

    def stage(self, table: str, rows: DataFrame, buckets: Iterable[int]) -> dict[str, str | None]:
        """Write the new content of some buckets and return their folders; a bucket without rows has none.

        Rows outside those buckets are an error: they would be lost or doubled.
        """
        allowed = sorted(set(buckets))
        target = f"data/{uuid.uuid4().hex}/{table}"
        own = F.col("store_bucket")
        inside = own.isin(allowed) if allowed else F.lit(False)
        checked = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schemas[table].fields]).withColumn(
            "store_bucket", self.bucket_of(table))
        checked = checked.withColumn("store_bucket", F.when(inside, own).otherwise(
            F.raise_error(F.concat(F.lit(f"{table}: row of bucket "), own.cast("string"), F.lit(" is not part of this change"))).cast("int")))
        # Rows of a bucket meet before the write; large buckets are split again.
        checked.hint("rebalance", F.col("store_bucket")).write.partitionBy("store_bucket").parquet(f"{self.root}/{target}")
        written = {n.removeprefix("store_bucket="): f"{target}/{n}" for n in self.files.names(f"{self.root}/{target}") if n.startswith("store_bucket=")}
        return {str(b): written.get(str(b)) for b in allowed}

    def publish(
        self, base: int, changes: Mapping[str, Mapping[str, str | None]], batch: int | None = None,
        counters: Mapping[str, int] | None = None,
    ) -> int:
        """Make the staged buckets the next version after ``base``, for all tables at once; ``counters`` are
        numbers to keep with it, such as the next free id."""
        before = self.manifest(base)
        tables = {n: dict(folders) for n, folders in before["tables"].items()}
        for name, folders in changes.items():
            held = tables.setdefault(name, {})
            for b, folder in folders.items():
                if folder is None:
                    held.pop(b, None)
                else:
                    held[b] = folder
        body = json.dumps({"batch": before["batch"] if batch is None else batch, "tables": tables,
                           "counters": {**before["counters"], **(counters or {})}})
        if not self.files.create(f"{self.root}/manifests/{base + 1:010d}.json", body):
            raise VersionTakenError(f"{self.root}: version {base + 1} is there already")
        return base + 1

    def written(self, batch: int | None) -> bool:
        """Whether a batch of this number is part of the last version."""
        return batch is not None and batch <= self.manifest()["batch"]

    def update(
        self, table: str, keys: DataFrame, change: Callable[[DataFrame], DataFrame], batch: int | None = None,
        columns: Sequence[str] | None = None,
    ) -> int:
        """Replace the buckets that ``keys`` fall in by ``change`` of their rows, and publish.

        ``change`` is any function from a node or edge table to its next state that touches nothing but
        rows of those keys, such as the upserts of ``operators.graph``.
        """
        if self.written(batch):
            return self.version()
        base = self.version()
        touched = self.touched(table, keys, columns)
        folders = self.stage(table, change(self.read(table, base, touched)), touched)
        return self.publish(base, {table: folders}, batch)

    # --- clearing ---------------------------------------------------------------------------

    def vacuum(self, keep: int = 2) -> int:
        """Forget all but the last ``keep`` versions and remove what only those named; returns folders removed.

        Not to be run while a change is being staged: what it has written is not named yet.
        """
        kept = self.versions()[-keep:]
        named = {f for v in kept for folders in self.manifest(v)["tables"].values() for f in folders.values()}
        for v in self.versions():
            if v not in kept:
                self.files.delete(f"{self.root}/manifests/{v:010d}.json")
        removed = 0
        for write in self.files.names(f"{self.root}/data"):
            for table in self.files.names(f"{self.root}/data/{write}"):
                for bucket in self.files.names(f"{self.root}/data/{write}/{table}"):
                    if bucket.startswith("store_bucket=") and f"data/{write}/{table}/{bucket}" not in named:
                        self.files.delete(f"{self.root}/data/{write}/{table}/{bucket}")
                        removed += 1
        return removed


def schema_ddl(schema: T.StructType) -> str:
    """Column list of a schema, as ``BucketStore`` takes it."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
