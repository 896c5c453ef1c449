"""Look-ups against the store of known posts and accounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cleaning import project_properties, quoted
from .dedupe import dedupe_keep_first
from .scale import number_rows


def _require_id(df: DataFrame, key: str) -> None:
    if key not in df.columns:
        raise TypeError(f"a column named {key!r} is required")


def _status(ids: DataFrame, store: DataFrame, key: str) -> DataFrame:
    _require_id(ids, key)
    return ids.select(F.col(key).cast("bigint").alias(key)).join(
        store.select(key, "hydrated"), key, "left"
    )


def tweet_hydration_status(ids: DataFrame, store: DataFrame, key: str = "id") -> DataFrame:
    """All requested ids with their stored status; unknown ids have null."""
    return _status(ids, store, key)


def account_hydration_status(ids: DataFrame, store: DataFrame, key: str = "id") -> DataFrame:
    return _status(ids, store, key)


def full_ids(store: DataFrame, key: str = "id") -> DataFrame:
    return store.where(F.col("hydrated") == "FULL").select(key)


def needs_hydration(
    df: DataFrame, store: DataFrame, key: str = "id", order_cols: Sequence[str] = ()
) -> DataFrame:
    """First row per id, without ids stored as FULL; unknown ids stay."""
    _require_id(df, key)
    once = dedupe_keep_first(df.withColumn(key, F.col(key).cast("bigint")), [key], order_cols)
    return once.join(full_ids(store, key), key, "left_anti").select(*[quoted(c) for c in df.columns])


def missing_ids_batched(
    ids: DataFrame, store: DataFrame, order_col: str, key: str = "id", batch: int = 100
) -> DataFrame:
    """Requested ids with batch number and whether they must be fetched."""
    numbered = number_rows(ids.select(*{key: 0, order_col: 0}), [order_col], "_no")
    known = full_ids(store, key).distinct().withColumn("_full", F.lit(True))
    return numbered.join(known, key, "left").select(
        key,
        F.floor(F.col("_no") / batch).alias("batch_no"),
        F.col("_full").isNull().alias("missing"),
    )


def cache_hit_rate(status: DataFrame) -> DataFrame:
    """Counts of a status table ``(id, hydrated)``: requested, cached, to fetch, never seen."""
    return status.agg(
        F.count("*").alias("requested"),
        F.count_if(F.col("hydrated") == "FULL").alias("cached"),
        F.count_if(~F.col("hydrated").eqNullSafe("FULL")).alias("missing"),
        F.count_if(F.col("hydrated").isNull()).alias("unseen"),
    )


def get_by_ids(
    store: DataFrame, ids: DataFrame, cols: Sequence[str] = (), key: str = "id"
) -> DataFrame:
    """Stored rows whose id is requested."""
    _require_id(ids, key)
    wanted = ids.select(F.col(key).cast("bigint").alias(key))
    return project_properties(store.join(wanted, key, "left_semi"), cols or store.columns)


def read_limited(df: DataFrame, order_cols: Sequence[str], limit: int | None = 1000) -> DataFrame:
    """The first rows in the given order; ``None`` reads everything."""
    return df if limit is None else df.orderBy(*order_cols).limit(limit)


def unseen_users(
    posts: DataFrame, enriched: DataFrame, profiles: DataFrame, user: str = "username",
    key: str = "id", order_cols: Sequence[str] = (),
) -> DataFrame:
    """Profiles of the users in ``posts`` that were not enriched before, one per id."""
    names = posts.select(user).distinct().join(enriched.select(user), user, "left_anti")
    known = profiles.join(names, user, "left_semi").select(*[quoted(c) for c in profiles.columns])
    return dedupe_keep_first(known, [key], order_cols)
