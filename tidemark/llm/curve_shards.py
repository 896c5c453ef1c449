"""Shards of neighbouring documents along a Hilbert curve over several metadata dimensions.

Every dimension is quantised by depth: a value's cell is the share of all rows with smaller values,
in ``2 ** BITS`` steps, so a skewed dimension still uses the whole grid and a frequent value takes
as many cells as it has rows. Cells of all dimensions together are a point; its place on the curve
orders the rows, and the order is cut into runs of nearly equal size, one for each shard. Points
next to each other on the curve are next to each other in every dimension, so each shard spans a
small box and a filter on any dimension skips most shards by their least and greatest values.

``law`` says what the runs have in common: ``bytes`` (a row belongs to the shard that holds its
middle byte, so a shard is off by one row's size at most) or ``rows`` (counts at most one apart).

Only DataFrame functions. The texts are read once and leave the scan as size and checksum. The order
is a range partition of narrow rows that ends with a number of each row, so a point or a text that
holds any share of the rows is split over tasks; positions come from sums inside the slices and one
offset for each slice. The curve itself is a table of at most 24 states over eight digits for three
dimensions, followed digit by digit.

Defined results: a null text has size 8 and checksum 0 (as the empty text); a null dimension comes
before all values; rows of one point are ordered by checksum, size and doc_id (null first), so equal
texts of a point lie together; rows equal in all of these share the positions among them in any way.
Other columns stay out of the result, whatever they are called. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scale import salted_join
from .shared import fresh, materialize

# Steps of each dimension: 2 ** BITS.
BITS = 5
# Bytes a row takes besides its text.
ROW_BYTES = 8


def curve_states(n: int) -> tuple[list[int], list[int]]:
    """(rank, next state) by state * 2 ** n + digit, for the Hilbert curve in ``n`` dimensions.

    A state is an entry corner and a direction. A digit has one bit of every dimension; its rank is
    the place of that part of the cube on the curve, by the Gray code seen from the state.
    """
    size = 1 << n

    def turn(x: int, by: int) -> int:
        by %= n
        return ((x << by) | (x >> (n - by))) & (size - 1)

    def gray(x: int) -> int:
        return x ^ (x >> 1)

    def ones(x: int) -> int:
        return ((x ^ (x + 1)).bit_length() - 1) % n

    found, rank, following = {(0, 0): 0}, [], []
    order = [(0, 0)]
    for entry, direction in order:
        ranks, nexts = [0] * size, [0] * size
        for w in range(size):
            corner = gray(2 * ((w - 1) // 2)) if w else 0
            step = 0 if w == 0 else ones(w - 1) if w % 2 == 0 else ones(w)
            state = (entry ^ turn(corner, direction + 1), (direction + step + 1) % n)
            if state not in found:
                found[state] = len(order)
                order.append(state)
            digit = turn(gray(w), direction + 1) ^ entry
            ranks[digit], nexts[digit] = w, found[state]
        rank += ranks
        following += nexts
    return rank, following


def curve_index(cells: Sequence[Column], bits: int = BITS) -> Column:
    """Place of a point on the Hilbert curve, from one cell number below 2 ** bits for each dimension."""
    n = len(cells)
    rank, following = (F.array(*map(F.lit, t)) for t in curve_states(n))

    def digit(k: Column) -> Column:
        out = F.lit(0)
        for d, cell in enumerate(cells):
            bit = F.call_function("shiftright", cell.cast("int"), k).bitwiseAND(F.lit(1))
            out = out + F.shiftleft(bit, d)
        return out

    def step(at: Column, k: Column) -> Column:
        row = at["state"] * (1 << n) + digit(k)
        return F.struct(F.get(following, row).alias("state"), (at["place"] * (1 << n) + F.get(rank, row)).alias("place"))

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("place"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step)["place"]


def running_totals(rows: DataFrame, order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    """``rows`` with the sum of columns over all rows before, in a total order, under new names.

    Rows are dealt to slices by range and written; sums inside a slice get one offset for each slice.
    """
    placed = materialize(rows.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "slices")
    before = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    slices = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_slice").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    offsets = totals.select("_slice", *[F.coalesce(F.sum(f"_{n}").over(slices), F.lit(0)).alias(f"_{n}") for n in sums])
    inside = placed.withColumns({n: F.coalesce(F.sum(c).over(before), F.lit(0)) for n, c in sums.items()})
    # One row for each slice: bounded by the number of partitions.
    return inside.join(F.broadcast(offsets), "_slice").withColumns(
        {n: F.col(n) + F.col(f"_{n}") for n in sums}).drop("_slice", *[f"_{n}" for n in sums])


def depth_cells(rows: DataFrame, column: str, total: int, bits: int = BITS) -> DataFrame:
    """(value, cell) of the different values of a column; null is a value and the smallest."""
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    placed = running_totals(counts, [F.col("value").asc_nulls_first()], {"smaller": "n"})
    return placed.select("value", F.expr(f"smaller * {1 << bits} div {max(total, 1)}").cast("int").alias("cell"))


def _narrow(docs: DataFrame, dimensions: Sequence[str], tie: Column) -> DataFrame:
    """What the order needs of each row: (doc_id, size, text_crc32, d0, d1, ..., tie)."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES
    return docs.select(
        "doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        *[(size if d == "size" else F.col(d)).alias(f"d{k}") for k, d in enumerate(dimensions)], tie.alias("tie"))


def _places(narrow: DataFrame, n_dimensions: int, n_shards: int, law: str, bits: int) -> DataFrame:
    """(doc_id, size, text_crc32, place, shard, slot, tie) of every row of ``narrow``."""
    if law not in ("bytes", "rows"):
        raise ValueError(f"unknown law {law!r}")
    placed = rows = materialize(narrow, "narrow")
    whole = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    names = [f"d{k}" for k in range(n_dimensions)]
    for n in names:
        # Null takes part in the join as a value of its own.
        key = lambda c: F.to_json(F.struct(F.col(c).alias("v")))
        cells = depth_cells(rows, n, whole["n"], bits).select(key("value").alias("key"), F.col("cell").alias(f"{n}_cell"))
        placed = salted_join(placed.withColumn("key", key(n)), materialize(cells, "cells"), "key", spread=["tie"]).drop("key", n)
    placed = placed.withColumn("place", curve_index([F.col(f"{n}_cell") for n in names], bits)).drop(*[f"{n}_cell" for n in names])
    order = [F.col("place"), F.col("text_crc32"), F.col("size"), F.col("doc_id").asc_nulls_first(), F.col("tie")]
    ordered = running_totals(placed.withColumn("one", F.lit(1)), order, {"row": "one", "before": "size"})
    if law == "bytes":
        shard = F.expr(f"(2 * before + size) * {n_shards} div {2 * max(whole['bytes'], 1)}")
    else:
        shard = F.expr(f"row * {n_shards} div {max(whole['n'], 1)}")
    cut = materialize(ordered.withColumn("shard", shard.cast("int")), "shards")
    first = cut.groupBy("shard").agg(F.min("row").alias("first"))
    # One row for each shard.
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "place", "shard", (F.col("row") - F.col("first")).alias("slot"), "tie")


def shard_documents(
    docs: DataFrame, n_shards: int, dimensions: Sequence[str] = ("lang", "source", "size"), law: str = "bytes", bits: int = BITS,
) -> DataFrame:
    """(doc_id, size, text_crc32, place, shard, slot) of every row of ``docs``.

    ``dimensions`` are columns of ``docs``, or ``size`` for the size of the row. ``place`` is the
    place on the curve; ``slot`` numbers the rows of a shard from 0 along the curve.
    """
    return _places(_narrow(docs, dimensions, F.monotonically_increasing_id()), len(dimensions), n_shards, law, bits).drop("tie")


def write_shards(
    docs: DataFrame, path: str, n_shards: int, dimensions: Sequence[str] = ("lang", "source", "size"), law: str = "bytes",
) -> DataFrame:
    """Write ``docs`` as one folder for each shard, rows along the curve, and return each shard's row count and
    the least and greatest value of every dimension, by which readers skip shards.

    The rows are stored once with a number, so that each finds its place by an equal join whatever its
    columns hold. Files get the columns ``size``, ``slot`` and ``shard`` besides those of ``docs``
    (with leading underscores where ``docs`` has such a column).
    """
    tie, size, slot, shard = (fresh(docs, n) for n in ("tie", "size", "slot", "shard"))
    numbered = materialize(docs.withColumn(tie, F.monotonically_increasing_id()), "numbered")
    places = _places(_narrow(numbered, dimensions, F.col(tie)), len(dimensions), n_shards, law, BITS).select(
        F.col("tie").alias(tie), F.col("size").alias(size), F.col("slot").alias(slot), F.col("shard").alias(shard))
    met = numbered.join(places, tie).drop(tie)
    met.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).write.mode("overwrite").partitionBy(shard).parquet(path)
    read = docs.sparkSession.read.parquet(path)
    bounds = [(d, size if d == "size" else d) for d in dimensions]
    return read.groupBy(F.col(shard).alias("shard")).agg(
        F.count("*").alias("n_rows"), *[f(c).alias(f"{k}_{d}") for d, c in bounds for k, f in (("min", F.min), ("max", F.max))])
