"""Building blocks that stay distributed when one key or one order holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# A key is hot when it holds more than this share of the rows, so there are at most 1,000 of them.
HOT_SHARE = 0.001
SALTS = 64
# Largest look-up table that is sent to every executor, by measured text size.
BROADCAST_BYTES = 64 << 20


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def number_rows(df: DataFrame, order_cols: Sequence[str | Column], name: str = "row_no") -> DataFrame:
    """Number the rows 0, 1, 2, ... in a total order without a one-task window.

    Rows are range-partitioned and sorted, get their position inside the partition, and are
    written to the shared folder so that the positions can never change on recomputation. Only one
    row count per partition is then summed up and broadcast (bounded by the number of partitions).
    ``order_cols`` must identify a row.
    """
    order = _columns(order_cols)
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    # The id holds the partition in its upper bits and the position in its lower 33 bits.
    placed = materialize(placed.withColumns({
        "_slice": F.shiftright("_place", 33),
        "_pos": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)),
    }).drop("_place"), "numbered")
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_slice").agg(F.count("*").alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_slice")
        .withColumn(name, F.col("_offset") + F.col("_pos"))
        .drop("_slice", "_pos", "_offset")
    )


def measured_bytes(df: DataFrame) -> int:
    """Size of a table's rows, counted; 0 without rows."""
    width = F.lit(8 * len(df.columns))
    for f in df.schema.fields:
        if f.dataType.typeName() in ("long", "integer", "short", "byte", "double", "float", "boolean", "date", "timestamp"):
            continue
        text = F.col(f"`{f.name}`")
        text = text if f.dataType.typeName() == "string" else F.to_json(F.array(text))
        width = width + F.coalesce(F.octet_length(text), F.lit(0))
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def salted_join(
    facts: DataFrame, keyed: DataFrame, on: str | Sequence[str], how: str = "inner",
    spread: Sequence[str] = (), broadcast_bytes: int | None = None, counts: DataFrame | None = None,
) -> DataFrame:
    """Join many rows to a table with one row per key when a few keys dominate.

    A keyed table of up to ``BROADCAST_BYTES`` is broadcast, and the facts are read once; ``broadcast_bytes``
    lowers that bound, as the driver holds such a table several times over while it is sent. Otherwise
    hot keys are found by a pre-aggregated count. Their facts are spread over ``SALTS`` parts by a
    hash of the ``spread`` columns and their keyed rows (at most 1,000, see ``HOT_SHARE``) are
    repeated once per part. Everything else joins as usual. Exact for any distribution; ``how`` is
    inner, left, left_semi or left_anti. ``counts``, if given, is a stored table of the keys with the number of
    their facts in ``_n``, which saves the count.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if measured_bytes(keyed) <= min(BROADCAST_BYTES, BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes):
        return facts.join(F.broadcast(keyed), keys, how)
    if counts is None:
        counts = facts.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_n")).scalar()
    hot = counts.where(F.col("_n") > total * F.lit(HOT_SHARE)).select(*keys, F.lit(True).alias("_hot"))
    hot = F.broadcast(hot)
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    part = F.pmod(F.xxhash64(*(spread or keys)), F.lit(SALTS)).cast("int")
    left = facts.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot") | no_key, part).otherwise(F.lit(0))
    ).drop("_hot")
    right = keyed.join(hot, keys, "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1)))
            .otherwise(F.array(F.lit(0)))
        ),
    ).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: str, spread: Sequence[str]
) -> DataFrame:
    """Inner join to a look-up table of any size whose keys may be frequent in ``facts``.

    The look-up table's real size is measured first. Up to ``BROADCAST_BYTES`` of text it is
    broadcast; beyond that every key is repeated ``SALTS`` times and the facts are spread over the
    copies, which needs no counting pass over ``facts``.
    """
    size = measured_bytes(lookup)
    if size == 0:
        # Nothing to look up: the plan below is known to be empty and reads no facts.
        return facts.where(F.lit(False)).join(lookup, on)
    if size <= BROADCAST_BYTES:
        return facts.join(F.broadcast(lookup), on)
    salted = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    part = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
    return facts.withColumn("_salt", part).join(salted, [on, "_salt"]).drop("_salt")


def running_before(
    df: DataFrame, order_col: str, value: str, name: str, block: Column, by: Sequence[str] = (),
) -> DataFrame:
    """Sum of ``value`` over all earlier rows (per ``by``), in two levels.

    ``block`` must be a non-decreasing function of ``order_col``. Rows are summed inside their
    block; only one total per block takes part in the long window.
    """
    df = df.withColumn("_block", block)
    inside = Window.partitionBy(*by, "_block").orderBy(order_col).rowsBetween(
        Window.unboundedPreceding, -1
    )
    over_blocks = (Window.partitionBy(*by) if by else Window).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = df.groupBy(*by, "_block").agg(F.sum(value).alias("_total")).select(
        *by, "_block", F.coalesce(F.sum("_total").over(over_blocks), F.lit(0)).alias("_base")
    )
    return (
        df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(totals, [*by, "_block"])
        .withColumn(name, F.col("_base") + F.col("_inside"))
        .drop("_block", "_base", "_inside")
    )
