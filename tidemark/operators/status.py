"""Post types and flattening of nested post parts. All row-local, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import extract_mentions, extract_urls, wrap_hashtags
from ..functions.values import (
    NULL_TEXTS, epoch_seconds, millis_to_timestamp, parse_post_time, parse_repr_struct,
)
from ..schemas import ENTITIES_SCHEMA, INNER_STATUS_SCHEMA, USER_SCHEMA
from .cleaning import clean_datetimes, rename_status_ids


def _is_text(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.StringType)


def _nested(df: DataFrame, col: str, schema: T.StructType, legacy: bool) -> Column:
    """A nested part as a struct: stored as one, as JSON text, or as legacy literal text."""
    if not _is_text(df, col):
        return F.col(col)
    return parse_repr_struct(F.col(col), schema) if legacy else F.from_json(F.col(col), schema)


def flag_retweeted(df: DataFrame) -> DataFrame:
    present = F.col("retweeted_status").isNotNull()
    if _is_text(df, "retweeted_status"):
        present = present & ~F.col("retweeted_status").isin(*NULL_TEXTS)
    return df.withColumn("retweeted", present)


def tag_status_type(df: DataFrame) -> DataFrame:
    """First match of quote, share, reply; otherwise original. Nulls count as no match."""
    return df.withColumn(
        "status_type",
        F.when(F.col("is_quote_status"), "retweet_quote")
        .when(F.col("retweeted"), "retweet")
        .when(F.col("in_reply_to_status_id") > 0, "reply")
        .otherwise("original"),
    )


def _flatten_inner(
    df: DataFrame, col: str, status_type: str, prefix: str, legacy: bool
) -> DataFrame:
    # Parsed in place: a per-row parse is cheaper than de-duplicating the text with a shuffle.
    inner = F.when(F.col("status_type") == status_type, _nested(df, col, INNER_STATUS_SCHEMA, legacy))
    return df.withColumn("_inner", inner).withColumns({
        f"{prefix}id": F.col("_inner.id"),
        f"{prefix}created_at": epoch_seconds(parse_post_time(F.col("_inner.created_at"))),
        f"{prefix}user_id": F.col("_inner.user.id"),
    }).drop("_inner")


def flatten_retweets(df: DataFrame, legacy: bool = False) -> DataFrame:
    return _flatten_inner(df, "retweeted_status", "retweet", "retweet_", legacy)


def flatten_quotes(df: DataFrame, legacy: bool = False) -> DataFrame:
    return _flatten_inner(df, "quoted_status", "retweet_quote", "quote_", legacy)


def flatten_users(df: DataFrame, legacy: bool = False) -> DataFrame:
    """The author's fields as ``user_*``; ``user_created_at`` in epoch seconds."""
    fields = {f"user_{n}": F.col(f"_author.{n}") for n in USER_SCHEMA.fieldNames()}
    fields["user_created_at"] = epoch_seconds(parse_post_time(F.col("_author.created_at")))
    author = _nested(df, "user", USER_SCHEMA, legacy)
    return df.withColumn("_author", author).withColumns(fields).drop("_author")


def flatten_entities(df: DataFrame, legacy: bool = False) -> DataFrame:
    parsed = _nested(df, "entities", ENTITIES_SCHEMA, legacy)
    return df.withColumn("_found", parsed).withColumns(
        {n: F.col(f"_found.{n}") for n in ENTITIES_SCHEMA.fieldNames()}
    ).drop("_found")


def normalize_status(df: DataFrame, legacy: bool = False) -> DataFrame:
    """Archived posts to the flat table."""
    return (
        df.transform(rename_status_ids)
        .transform(clean_datetimes)
        .transform(flag_retweeted)
        .transform(tag_status_type)
        .transform(flatten_retweets, legacy)
        .transform(flatten_quotes, legacy)
        .transform(flatten_users, legacy)
        .transform(flatten_entities, legacy)
    )


def scraped_type(df: DataFrame, compat: bool = False) -> Column:
    """Type of a scraped post. ``compat`` keeps the old inverted quote test."""
    no_quote = F.coalesce(F.col("quote_url"), F.lit("")) == ""
    shared = F.col("retweet") if "retweet" in df.columns else F.lit(False)
    return (
        F.when(no_quote if compat else ~no_quote, "QUOTE_RETWEET")
        .when(shared, "RETWEET")
        .when(F.col("id") == F.col("conversation_id"), "TWEET")
        .otherwise("REPLY")
    )


def classify_scraped_type(df: DataFrame, compat: bool = False) -> DataFrame:
    return df.withColumn("tweet_type_twint", scraped_type(df, compat))


def normalize_scraped(df: DataFrame, compat: bool = False) -> DataFrame:
    """Scraped posts to the flat table, in one projection."""
    nothing = F.lit(None)
    renamed = {
        "status_id": F.col("id").cast("bigint"),
        "full_text": F.col("tweet"),
        "favorite_count": F.col("nlikes"),
        "retweet_count": F.col("nretweets"),
        "user_name": F.col("username"),
        "user_screen_name": F.col("name"),
    }
    taken = {"id", "tweet", "nlikes", "nretweets", "username", "name", "hashtags", "created_at"}
    rest = [F.col(c) for c in df.columns if c not in taken]
    return df.select(
        *[e.alias(n) for n, e in renamed.items()],
        *rest,
        millis_to_timestamp(F.col("created_at")).alias("created_at"),
        scraped_type(df, compat).alias("tweet_type_twint"),
        wrap_hashtags(F.col("hashtags")).alias("hashtags"),
        extract_mentions(F.col("tweet")).alias("user_mentions"),
        extract_urls(F.col("tweet")).alias("urls"),
        nothing.cast("string").alias("user_location"),
        nothing.cast("bigint").alias("user_followers_count"),
        nothing.cast("bigint").alias("user_friends_count"),
        nothing.cast("string").alias("user_profile_image_url"),
        nothing.cast("bigint").alias("reply_tweet_id"),
        nothing.cast("string").alias("retweeted_status"),
        F.lit(0).cast("bigint").alias("in_reply_to_status_id"),
    )


def classify_graph_type(df: DataFrame) -> DataFrame:
    """Preset type if there is one, else by the first id above zero: reply, quote, share."""
    have = set(df.columns)

    def positive(name: str) -> Column:
        return F.col(name) > 0 if name in have else F.lit(False)

    by_id = (
        F.when(positive("in_reply_to_status_id"), "REPLY")
        .when(positive("quoted_status_id"), "QUOTE_RETWEET")
        .when(positive("retweet_id"), "RETWEET")
        .otherwise("TWEET")
    )
    preset = F.nullif(F.col("tweet_type_twint"), F.lit("")) if "tweet_type_twint" in have else None
    return df.withColumn("tweet_type", by_id if preset is None else F.coalesce(preset, by_id))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` pseudo-random rows, the same ones for the same seed: a top-n by a hash of the key."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)
