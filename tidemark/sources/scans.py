"""Readers. Schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import STATUS_SCHEMA, TRIAL_SCHEMA


def scan_id_file(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One id per line, no header."""
    return spark.read.schema("id BIGINT").csv(path, header=False)


def scan_hourly_partition(
    spark: SparkSession, dirs: str | Sequence[str], hour: str, layout: str = "partition",
    schema: str = "id BIGINT",
) -> DataFrame:
    """The rows of one hour, ``hour`` as ``YYYY-MM-DD-HH``, from any number of folders.

    ``partition``: datasets with ``hour=`` folders; only the wanted folder is ever listed.
    ``files``: plain id files whose names end in ``<hour>.txt``. A missing hour gives no rows.
    """
    roots = [dirs] if isinstance(dirs, str) else list(dirs)
    reader = spark.read.schema(schema)
    if layout == "files":
        return reader.option("pathGlobFilter", f"*{hour}.txt").csv(roots)
    found = spark.createDataFrame([], schema)
    for root in roots:
        try:
            found = found.unionAll(reader.csv(f"{root.rstrip('/')}/hour={hour}"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def scan_status_archive(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Archived posts under the fixed schema; columns a file lacks are null."""
    return spark.read.schema(STATUS_SCHEMA).parquet(*([path] if isinstance(path, str) else path))


def scan_vocab_csv(
    spark: SparkSession, path: str, cols: Sequence[str] = ("Common name", "Synonyms")
) -> DataFrame:
    return spark.read.csv(path, header=True, quote='"', escape='"').select(*[f"`{c}`" for c in cols])


def scan_trials_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Pages of nested trial results; one JSON object per line unless ``multi_line``."""
    return spark.read.schema(TRIAL_SCHEMA).json(path, multiLine=multi_line)


def scan_topics(spark: SparkSession, topics: Mapping[str, Sequence[str]] | str) -> DataFrame:
    """``(topic, position, phrase)`` from a dictionary or from JSON files.

    A file holds one object over any number of lines, or one object per line. Text that is neither
    fails the job.
    """
    if isinstance(topics, str):
        form = "map<string, array<string>>"
        lines = F.filter(F.split("value", r"[\r\n]+"), lambda x: F.trim(x) != "")
        by_line = F.forall(lines, lambda x: x.rlike(r"^\s*\{.*\}\s*$") & F.from_json(x, form).isNotNull())
        objects = spark.read.text(topics, wholetext=True).where(F.trim("value") != "").select(
            F.explode(F.when(by_line, lines).otherwise(F.array("value"))).alias("object"))
        parsed = F.from_json("object", form)
        lists = objects.select(F.explode(
            F.when(parsed.isNotNull(), parsed).otherwise(
                F.raise_error(F.concat(F.lit("not a JSON object of phrase lists: "), F.substring("object", 1, 80))).cast(form))
        ).alias("topic", "phrases"))
    else:
        lists = spark.createDataFrame(
            [(t, list(p)) for t, p in topics.items()], "topic STRING, phrases ARRAY<STRING>"
        )
    return lists.select("topic", F.posexplode("phrases").alias("position", "phrase"))
