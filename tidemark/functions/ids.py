"""Time-ordered ids: 41 bits of milliseconds, 10 bits of machine, 12 bits of sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Start of the id clock and the machines that issue ids.
SNOWFLAKE_EPOCH_MS = 1288834974657
MACHINE_IDS = (375, 382, 361, 372, 364, 381, 376, 365, 363, 362,
               350, 325, 335, 333, 342, 326, 327, 336, 347, 332)


def snowflake_time(c: Column) -> Column:
    """Milliseconds since 1970 at which the id was issued."""
    return F.shiftright(c, 22) + F.lit(SNOWFLAKE_EPOCH_MS)


def snowflake_machine(c: Column) -> Column:
    return F.shiftright(c, 12).bitwiseAND(F.lit(1023))


def snowflake_sequence(c: Column) -> Column:
    return c.bitwiseAND(F.lit(4095))


def snowflake_id(ms: Column, machine: Column, sequence: Column) -> Column:
    """Compose an id from its three parts."""
    return (
        F.shiftleft(ms.cast("bigint") - F.lit(SNOWFLAKE_EPOCH_MS), 22)
        .bitwiseOR(F.shiftleft(machine.cast("bigint"), 12))
        .bitwiseOR(sequence.cast("bigint"))
    )


def expand_snowflake_ids(
    ranges: DataFrame, begin: str, end: str,
    machines: Sequence[int] = MACHINE_IDS, sequences: Sequence[int] = (0,),
) -> DataFrame:
    """Every candidate id of each row's ``[begin, end)`` milliseconds.

    A pure row expansion: no shuffle, and the parallelism is that of ``ranges``.
    """
    ms = F.when(F.col(end) > F.col(begin), F.sequence(F.col(begin), F.col(end) - 1))
    return (
        ranges.select("*", F.explode(ms).alias("ms"))
        .select("*", F.explode(F.array(*[F.lit(m) for m in machines])).alias("machine"))
        .select("*", F.explode(F.array(*[F.lit(s) for s in sequences])).alias("sequence"))
        .withColumn("id", snowflake_id(F.col("ms"), F.col("machine"), F.col("sequence")))
    )


def snowflake_id_range(
    spark: SparkSession, begin_ms: int, end_ms: int,
    machines: Sequence[int] = MACHINE_IDS, sequences: Sequence[int] = (0,),
) -> DataFrame:
    """Candidate ids of one span; ``spark.range`` spreads the milliseconds over the cluster."""
    ticks = spark.range(begin_ms, end_ms).select(
        F.col("id").alias("begin_ms"), (F.col("id") + 1).alias("end_ms")
    )
    return expand_snowflake_ids(ticks, "begin_ms", "end_ms", machines, sequences).select(
        "id", "ms", "machine", "sequence"
    )
