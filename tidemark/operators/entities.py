"""Mention and link rows of posts, and the column sets of account and link tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalize_hashtags
from ..functions.urls import PART_NAMES, parse_url_parts
from .cleaning import quoted
from .status import classify_graph_type


def as_timestamp(as_of: str | dt.datetime):
    return F.lit(str(as_of)).cast("timestamp")


def _optional(df: DataFrame, name: str, type_: str):
    return (F.col(name) if name in df.columns else F.lit(None)).cast(type_)


def explode_mentions(
    df: DataFrame, job_name: str | None = None, job_id: str | None = None
) -> DataFrame:
    """One row per mentioned account of posts whose mentions carry ids."""
    return df.select("status_id", F.explode("user_mentions").alias("m")).select(
        F.col("status_id").alias("tweet_id"),
        F.col("m.id").alias("user_id"),
        F.col("m.name").alias("user_name"),
        F.col("m.screen_name").alias("user_screen_name"),
        F.lit(job_name).cast("string").alias("job_name"),
        F.lit(job_id).cast("string").alias("job_id"),
    )


def scraped_mentions(
    df: DataFrame, job_name: str | None = None, job_id: str | None = None
) -> DataFrame:
    """One row per post with its list of mentioned names."""
    return df.select(
        F.col("status_id").alias("tweet_id"),
        F.col("user_mentions").alias("user_screen_name"),
        F.lit(job_name).cast("string").alias("job_name"),
        F.lit(job_id).cast("string").alias("job_id"),
    )


def _url_text(df: DataFrame):
    """Links are plain text on scraped posts and ``{expanded_url}`` on archived ones."""
    element = df.schema["urls"].dataType.elementType
    return (lambda c: c["expanded_url"]) if isinstance(element, T.StructType) else (lambda c: c)


def _url_rows(df: DataFrame, job_name: str | None, job_id: str | None) -> DataFrame:
    parsed = df.where(F.col("_url").isNotNull()).withColumn("_p", parse_url_parts(F.col("_url")))
    return parsed.select(
        F.col("status_id").alias("tweet_id"),
        F.col("_url").alias("full_url"),
        F.lit(job_name).cast("string").alias("job_name"),
        F.lit(job_id).cast("string").alias("job_id"),
        *[F.col(f"_p.{n}").alias(n) for n in PART_NAMES],
    )


def explode_urls(
    df: DataFrame, job_name: str | None = None, job_id: str | None = None
) -> DataFrame:
    """One row per link with its parts."""
    text = _url_text(df)
    rows = df.select("status_id", F.explode("urls").alias("_u")).select(
        "status_id", text(F.col("_u")).alias("_url")
    )
    return _url_rows(rows, job_name, job_id)


def first_url(
    df: DataFrame, job_name: str | None = None, job_id: str | None = None
) -> DataFrame:
    """The first link of each post that has one."""
    text = _url_text(df)
    rows = df.select("status_id", text(F.get("urls", F.lit(0))).alias("_url"))
    return _url_rows(rows, job_name, job_id)


def url_columns(df: DataFrame, as_of: str | dt.datetime) -> DataFrame:
    """The link table's columns and its time of record."""
    names = ["tweet_id", "full_url", "job_name", *PART_NAMES]
    return df.select(*names, as_timestamp(as_of).alias("record_created_at"))


def account_columns(df: DataFrame, job_name: str, as_of: str | dt.datetime) -> DataFrame:
    """Profile columns under account names."""
    return df.select(
        "location",
        "name",
        as_timestamp(as_of).alias("record_created_at"),
        F.col("username").alias("screen_name"),
        F.col("following").alias("friends_count"),
        F.col("followers").alias("followers_count"),
        F.lit(job_name).alias("job_name"),
    )


def graph_rows(
    df: DataFrame, job_name: str, job_id: str | None = None, ingest_method: str | None = None
) -> DataFrame:
    """Flat posts to the batch table the graph upserts take."""
    typed = classify_graph_type(df)
    hashtags = F.lit(None).cast("string")
    if "hashtags" in df.columns:
        hashtags = normalize_hashtags(F.col("hashtags"))
    created = _optional(df, "user_created_at", "double")
    return typed.select(
        F.col("status_id").alias("tweet_id"),
        F.col("full_text").alias("text"),
        _optional(df, "created_at", "timestamp").alias("tweet_created_at"),
        _optional(df, "favorite_count", "bigint").alias("favorite_count"),
        _optional(df, "retweet_count", "bigint").alias("retweet_count"),
        "tweet_type",
        F.lit(job_id).cast("string").alias("job_id"),
        F.lit(job_name).alias("job_name"),
        hashtags.alias("hashtags"),
        _optional(df, "geo", "string").alias("geo"),
        F.lit(ingest_method).cast("string").alias("ingest_method"),
        _optional(df, "user_id", "bigint").alias("user_id"),
        _optional(df, "user_name", "string").alias("user_name"),
        _optional(df, "user_location", "string").alias("user_location"),
        _optional(df, "user_screen_name", "string").alias("user_screen_name"),
        _optional(df, "user_followers_count", "bigint").alias("user_followers_count"),
        _optional(df, "user_friends_count", "bigint").alias("user_friends_count"),
        F.timestamp_micros((created * F.lit(1e6)).cast("bigint")).alias("user_created_at"),
        _optional(df, "user_profile_image_url", "string").alias("user_profile_image_url"),
        _optional(df, "in_reply_to_status_id", "bigint").alias("reply_tweet_id"),
        _optional(df, "conversation_id", "bigint").alias("conversation_id"),
        _optional(df, "quoted_status_id", "bigint").alias("quoted_status_id"),
        _optional(df, "retweet_id", "bigint").alias("retweet_id"),
    )


def pick(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select with renames, ``{new: old}``."""
    return df.select(*[quoted(old).alias(new) for new, old in names.items()])
