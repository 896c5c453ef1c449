"""One row per key, distinct values, and set operations."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cleaning import fill_blank, quoted


def _one_per_key(
    df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], towards: Callable[[Column], Column]
) -> DataFrame:
    """The first row per key of a window, asked for as ``row_number() = 1``: the optimizer then keeps
    one row per key and task before the shuffle, so the number of copies of a key does not matter."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = [towards(quoted(c)) for c in (order_cols or rest)]
    window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).where(F.col("_place") == 1).drop("_place")


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order, nulls before values."""
    return _one_per_key(df, keys, order_cols, Column.asc_nulls_first)


def dedupe_keep_last(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    return _one_per_key(df, keys, order_cols, Column.desc_nulls_last)


def last_wins_map(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """Repeated keys: the last row wins."""
    return dedupe_keep_last(df, [key], [order_col])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; empty when unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def union_by_name_fill(
    first: DataFrame, second: DataFrame, key: str, order_col: str, fill: str = ""
) -> DataFrame:
    """Both sources with all columns as text; the first source wins for a shared key."""
    ranked = first.withColumn("_source", F.lit(0)).unionByName(
        second.withColumn("_source", F.lit(1)), allowMissingColumns=True
    )
    once = dedupe_keep_first(ranked, [key], ["_source", order_col]).drop("_source")
    filled = fill_blank(once)
    return filled if fill == "" else filled.replace("", fill)


def concat_same_schema(a: DataFrame, b: DataFrame) -> DataFrame:
    """Append a batch of exactly the same columns and types."""
    def shape(df: DataFrame) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]

    if shape(a) != shape(b):
        raise ValueError(f"schemas differ: {shape(a)} and {shape(b)}")
    return a.union(b)


def terms_union_all(drugs: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Drug names followed by synonyms, copies kept."""
    def as_term(df: DataFrame) -> Column:
        return F.lower(quoted(df.columns[0])).alias("term")

    return drugs.select(as_term(drugs)).unionAll(synonyms.select(as_term(synonyms)))


def split_counts(posts: DataFrame, mentions: DataFrame, urls: DataFrame) -> DataFrame:
    """Sizes of the three tables of a batch as one row."""
    sized = None
    for name, df in (("posts", posts), ("mentions", mentions), ("urls", urls)):
        part = df.select(F.lit(name).alias("kind"))
        sized = part if sized is None else sized.unionAll(part)
    return sized.agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("posts", "mentions", "urls")]
    )
