"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Run-time settings every plan in this package relies on.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Stream state on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        **RUNTIME_CONF,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else created.

    Python tasks get the package's folder on their path, where it exists on their machine.
    """
    home = str(Path(__file__).resolve().parents[1])
    given = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in given.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, given]))
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    # Listing many hourly folders takes a job; one task per core is enough for it.
    spark.conf.set(
        "spark.sql.sources.parallelPartitionDiscovery.parallelism",
        str(spark.sparkContext.defaultParallelism),
    )
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        current = tempfile.mkdtemp(prefix="tidemark-")
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir()


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table below the shared folder and read it back.

    Cuts the lineage like a checkpoint, but computes the rows once, keeps them columnar, and lets
    later reads skip columns. The rows can no longer change when an executor is lost.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Remove tables ``materialize`` wrote that nothing reads any more; they must not be used again."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            target = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def collect_garbage(spark: SparkSession) -> None:
    """Lets Spark drop shuffle files and broadcasts that nothing refers to any more.

    Spark learns of them from the driver's collector alone, which a plan of many small jobs hardly ever
    makes run in full; until then files and the driver's heap grow with every job.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def work_root(spark: SparkSession) -> str:
    """The folder of this application below the shared one."""
    return f"{checkpoint_root(spark).rstrip('/')}/tidemark-{spark.sparkContext.applicationId}"


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's folder."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Remove everything this application put in its working folder.

    To be called when no DataFrame made so far is needed any more, at the latest before the
    session is stopped.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
