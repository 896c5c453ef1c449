"""An hourly Parquet archive that holds every batch exactly once.

A batch is written to a folder of its own first. It becomes part of the archive when a record is
created under its name, (query, batch number); the record names the folder's partitions. The name can
be taken once, so a batch that is sent again, after a crash or because another sink failed, finds its
record and adds nothing, and what a failed try left is named by no record and never read.

    path/write=<id>/job_name=<job>/ingest_hour=<hour>/part-*.parquet
    path/_commits/<query>/<batch>.json      {"parts": [{"folder": ..., "job_name": ..., "ingest_hour": ...}]}

Readers ask the records for the folders of an hour and open only those.
"""

from __future__ import annotations

import json
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import Files

# Rows per file of the archive.
MAX_RECORDS_PER_FILE = 5_000_000
_RECORD = "parts array<struct<folder: string, job_name: string, ingest_hour: string>>"


def file_name(text: str) -> str:
    return re.sub(r"[^A-Za-z0-9_-]", "", text)


class HourlyArchive:
    """The archive below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)

    def _record(self, query: str, batch: int) -> str:
        return f"{self.path}/_commits/{file_name(query)}/{batch:012d}.json"

    def committed(self, query: str, batch: int) -> bool:
        return self.files.exists(self._record(query, batch))

    def stage(self, df: DataFrame, job_name: str, ingest_hour: str | None = None, codec: str = "snappy") -> str:
        """Write rows to a folder that no reader opens yet, and return its name.

        Without ``ingest_hour`` the frame brings its own column of that name.
        """
        if codec not in ("none", "snappy"):
            raise ValueError(f"unknown codec {codec!r}")
        out = df.withColumn("job_name", F.lit(file_name(job_name)))
        if ingest_hour is not None:
            out = out.withColumn("ingest_hour", F.lit(ingest_hour))
        else:
            # Rows of an hour meet before the write, or every task would open a file per hour; the
            # rebalance splits hours that are too large for one task.
            out = out.hint("rebalance", F.col("ingest_hour"))
        write = f"write={uuid.uuid4().hex}"
        out.write.partitionBy("job_name", "ingest_hour").option("compression", codec).option(
            "maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(f"{self.path}/{write}")
        return write

    def commit(self, query: str, batch: int, write: str) -> bool:
        """Make a staged folder part of the archive under the batch's name; False if the name is taken."""
        parts = []
        for job in self.files.names(f"{self.path}/{write}"):
            for hour in self.files.names(f"{self.path}/{write}/{job}"):
                parts.append({"folder": f"{write}/{job}/{hour}", "job_name": unquote(job.split("=", 1)[1]),
                              "ingest_hour": unquote(hour.split("=", 1)[1])})
        return self.files.create(self._record(query, batch), json.dumps({"parts": parts}))

    def add(
        self, df: DataFrame, query: str, batch: int, job_name: str, ingest_hour: str | None = None, codec: str = "snappy",
    ) -> bool:
        """Write a batch once; False if it was there."""
        if self.committed(query, batch):
            return False
        return self.commit(query, batch, self.stage(df, job_name, ingest_hour, codec))

    def parts(self, ingest_hour: str | None = None, job_name: str | None = None) -> list[str]:
        """Committed folders, of one hour or job if given."""
        if not self.files.names(f"{self.path}/_commits"):
            return []
        records = self.spark.read.schema(_RECORD).json(f"{self.path}/_commits/*")
        found = records.select(F.explode("parts").alias("p")).select("p.*")
        for column, wanted in (("ingest_hour", ingest_hour), ("job_name", job_name and file_name(job_name))):
            if wanted is not None:
                found = found.where(F.col(column) == wanted)
        return sorted(r["folder"] for r in found.select("folder").collect())

    def read(self, schema: T.StructType | str, ingest_hour: str | None = None, job_name: str | None = None) -> DataFrame:
        """Committed rows, with the columns of ``schema`` and ``job_name`` and ``ingest_hour``."""
        plain = self.spark.createDataFrame([], schema).schema
        kept = [f for f in plain.fields if f.name not in ("job_name", "ingest_hour")]
        text = [T.StructField(n, T.StringType()) for n in ("job_name", "ingest_hour")]
        whole = T.StructType([*kept, *text])
        folders = self.parts(ingest_hour, job_name)
        if not folders:
            return self.spark.createDataFrame([], whole)
        reader = self.spark.read.schema(whole).option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{f}" for f in folders]).select(*[F.col(f"`{f.name}`") for f in whole.fields])

    def clear_failed(self) -> int:
        """Remove folders of tries that were never committed. Not to be run while a batch is being written."""
        named = {f.split("/", 1)[0] for f in self.parts()}
        failed = [n for n in self.files.names(self.path) if n.startswith("write=") and n not in named]
        for n in failed:
            self.files.delete(f"{self.path}/{n}")
        return len(failed)
