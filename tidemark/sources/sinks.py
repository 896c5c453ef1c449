"""Writers. Target folders are functions of the arguments, so a repeated run replaces its own
output instead of adding to it."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cleaning import make_serializable, quoted
from .archive import HourlyArchive, file_name

def sink_parquet_hourly(
    df: DataFrame, path: str, job_name: str, ingest_hour: str | None = None,
    codec: str = "snappy", query: str | None = None, batch: int = 0,
) -> bool:
    """Add a batch to the archive below ``path``, in ``job_name=/ingest_hour=`` folders; existing files are never touched.

    ``query`` and ``batch`` name the batch: sent again, it adds nothing and the result is False. Without
    ``query`` every call is a batch of its own. Without ``ingest_hour`` the frame brings its own column of
    that name. ``HourlyArchive.read`` reads what is committed.
    """
    name = query if query is not None else f"once-{uuid.uuid4().hex}"
    return HourlyArchive(df.sparkSession, path).add(df, name, batch, job_name, ingest_hour, codec)


def batch_path(
    root: str, job_name: str, kind: str, t0: str | dt.datetime, t1: str | dt.datetime
) -> str:
    def stamp(t: str | dt.datetime) -> str:
        return re.sub(r"[^0-9]", "", str(t))

    return f"{root.rstrip('/')}/{file_name(job_name)}/{file_name(kind)}/{stamp(t0)}_{stamp(t1)}"


def sink_batch(
    df: DataFrame, root: str, job_name: str, kind: str,
    t0: str | dt.datetime, t1: str | dt.datetime, fmt: str | None, codec: str = "snappy",
) -> str | None:
    """Write one batch and return its folder. No format writes nothing; ``parquet_s3`` is Parquet
    below an object-store root."""
    if fmt is None:
        return None
    if fmt not in ("csv", "json", "parquet", "parquet_s3"):
        raise ValueError(f"unknown format {fmt!r}")
    target = batch_path(root, job_name, kind, t0, t1)
    kind_of = "parquet" if fmt == "parquet_s3" else fmt
    writer = make_serializable(df, kind_of).write.mode("overwrite")
    if kind_of == "csv":
        # Blanks at either end of a text belong to it.
        writer.csv(
            target, header=True, quote='"', escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    elif kind_of == "json":
        writer.json(target, ignoreNullFields=False)
    else:
        writer.option("compression", codec).parquet(target)
    return target


def sink_quarantine(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Split rows by whether each value fits the schema.

    Returns the valid rows in schema form and the rejected ones as they were, with ``reason``
    naming the columns at fault.
    """
    checked = df
    bad = []
    for f in schema.fields:
        c = quoted(f.name)
        fits = c.try_cast(f.dataType).isNotNull() | c.isNull()
        if not f.nullable:
            fits = fits & c.isNotNull()
        bad.append(F.when(~fits, F.lit(f.name)))
    checked = df.withColumn("reason", F.array_join(F.array_compact(F.array(*bad)), ","))
    valid = checked.where(F.col("reason") == "").select(
        *[quoted(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    return valid, checked.where(F.col("reason") != "")


def write_quarantine(df: DataFrame, schema: T.StructType, valid_path: str, rejected_path: str) -> None:
    """Append the valid rows as Parquet and the rejected ones, with their reason, as JSON lines."""
    valid, rejected = sink_quarantine(df, schema)
    valid.write.mode("append").parquet(valid_path)
    rejected.write.mode("append").json(rejected_path, ignoreNullFields=False)


def sink_dual_flush(
    archive_fn: Callable[[DataFrame, int], None], graph_fn: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: archive, then graph. The graph write is tried even if the archive
    failed, and the archive's error is raised afterwards, so the batch is repeated as a whole.

    Both halves must know a batch by its number, as ``sink_parquet_hourly`` with ``query`` and ``archive_to_store``
    do: the half that succeeded the first time then adds nothing.
    """

    def flush(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        error: Exception | None = None
        try:
            try:
                archive_fn(held, batch_id)
            except Exception as e:  # noqa: BLE001 - raised below
                error = e
            graph_fn(held, batch_id)
        finally:
            held.unpersist()
        if error is not None:
            raise error

    return flush


def write_batch_table(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder per streaming batch; a repeated batch replaces its own folder."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
