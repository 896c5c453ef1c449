"""Phrase, topic, place and time predicates, and stride windows."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import NON_WORD_CHAR
from ..session import materialize
from .linking import word_boundary_link
from .scale import lookup_join, running_before

_WORD = re.compile(r"\w")


def _phrase_regex(phrase: str) -> str:
    """The phrase, not inside a longer word."""
    text = phrase.lower()
    left = f"(?:^|{NON_WORD_CHAR})" if _WORD.match(text[0]) else ""
    right = f"(?:$|{NON_WORD_CHAR})" if _WORD.match(text[-1]) else ""
    return left + re.escape(text) + right


def match_any_phrase(c: Column, phrases: Sequence[str]) -> Column:
    """True where any phrase occurs, whatever its case. Plain substring tests come first, so that
    the one regular expression for all phrases only sees texts that can match."""
    if not phrases:
        return F.lit(False)
    if not all(phrases):
        raise ValueError("an empty phrase matches every text; leave it out")
    lowered, possible = F.lower(c), F.lit(False)
    for p in phrases:
        possible = possible | lowered.contains(p.lower())
    return possible & lowered.rlike("|".join(_phrase_regex(p) for p in phrases))


def tag_topics(df: DataFrame, key: str, text: str, topics: DataFrame) -> DataFrame:
    """``(key, topics)`` for posts that hold a phrase of any topic.

    ``topics`` has columns topic and phrase. The list per post is bounded by the topics.
    """
    links = word_boundary_link(topics.select("phrase"), df, "phrase", key, text)
    by_phrase = materialize(topics.select(F.lower("phrase").alias("phrase"), "topic").distinct(), "phrases")
    return (
        lookup_join(links, by_phrase, "phrase", spread=[key])
        .groupBy(key)
        .agg(F.array_sort(F.collect_set("topic")).alias("topics"))
    )


def keyword_track(df: DataFrame, text: str, words: Sequence[str]) -> DataFrame:
    """Rows whose text contains one of the words; works on streams."""
    lowered = F.lower(F.col(text))
    hit = F.lit(False)
    for w in words:
        hit = hit | lowered.contains(w.lower())
    return df.where(hit)


def bounding_box(
    df: DataFrame, lon: str, lat: str, box: tuple[float, float, float, float]
) -> DataFrame:
    """``box`` is west, south, east, north; borders belong to it."""
    west, south, east, north = box
    return df.where(F.col(lon).between(west, east) & F.col(lat).between(south, north))


def user_timeline(df: DataFrame, users: DataFrame, ts: str, user: str = "user_id") -> DataFrame:
    """All posts of the listed users, by user and time."""
    return df.join(users.select(user).distinct(), user, "left_semi").orderBy(user, ts)


def suspended_profiles(
    users: DataFrame, posts: DataFrame, user: str = "username"
) -> DataFrame:
    """Listed users without any post, flagged; users with posts are flagged false."""
    seen = posts.select(user).distinct().withColumn("_seen", F.lit(True))
    return users.select(user).distinct().join(seen, user, "left").select(
        user, F.col("_seen").isNull().alias("suspended")
    )


def non_empty_mentions(df: DataFrame, col: str = "user_mentions") -> DataFrame:
    return df.where(F.size(F.col(col)) > 0)


def _micros(t: str | dt.datetime) -> Column:
    return F.unix_micros(F.lit(str(t)).cast("timestamp"))


def seconds(interval: str | int) -> int:
    """Seconds of ``600`` or ``"10 minutes"``."""
    if isinstance(interval, int):
        return interval
    amount, unit = interval.split()
    size = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    return int(amount) * size[unit.rstrip("s")]


def _span(t0_micros: Column, length: int) -> tuple[Column, Column]:
    start = t0_micros.cast("bigint")
    return (
        F.timestamp_micros(start).alias("t0"),
        F.timestamp_micros(start + F.lit(length * 1_000_000)).alias("t1"),
    )


def stride_windows(
    df: DataFrame, ts: str, since: str | dt.datetime, until: str | dt.datetime, stride: str | int
) -> DataFrame:
    """Rows with their window ``[t0, t1)``; windows start at ``since`` and follow each other while
    they start before ``until``. The last one may run past ``until``.

    Plain bounds on ``ts`` come first so that they reach the file scan.
    """
    step = seconds(stride)
    whole = f"interval {step} seconds"
    begin, end = (F.lit(str(t)).cast("timestamp") for t in (since, until))
    offset = F.unix_micros(F.col(ts)) - _micros(since)
    number = F.floor(offset / F.lit(step * 1_000_000))
    start = _micros(since) + number * F.lit(step * 1_000_000)
    return (
        df.where((F.col(ts) >= begin) & (F.col(ts) < end + F.expr(whole)))
        .select("*", *_span(start, step))
        .where(F.col("t0") < end)
    )


def hits_per_window(
    df: DataFrame, ts: str, stride: str | int, since: str | dt.datetime = "1970-01-01 00:00:00"
) -> DataFrame:
    """Rows per window; empty windows are absent."""
    step = seconds(stride) * 1_000_000
    number = F.floor((F.unix_micros(F.col(ts)) - _micros(since)) / F.lit(step))
    return (
        df.groupBy(number.alias("_w")).agg(F.count("*").alias("hits"))
        .select(*_span(_micros(since) + F.col("_w") * F.lit(step), seconds(stride)), "hits")
    )


def stride_windows_limited(
    df: DataFrame, ts: str, since: str | dt.datetime, until: str | dt.datetime,
    stride: str | int, limit: int,
) -> DataFrame:
    """Windows in order until ``limit`` hits are reached; the crossing window is kept whole.

    Kept windows are a prefix in time, so one bound found on the window counts filters the rows.
    """
    rows = stride_windows(df, ts, since, until, stride)
    counts = rows.groupBy("t0").agg(F.count("*").alias("hits"))
    step = seconds(stride)
    number = F.floor((F.unix_micros("t0") - _micros(since)) / F.lit(step * 1_000_000))
    # 4,096 windows to a block keeps both window levels small for any span of time.
    reached = running_before(
        counts.withColumn("_no", number), "_no", "hits", "before", F.floor(F.col("_no") / 4096)
    )
    last = reached.where(F.col("before") < limit).agg(F.max("t0").alias("t0")).scalar()
    return rows.where(F.col("t0") <= last)


def backfill_windows(
    df: DataFrame, ts: str, start: str | dt.datetime, outer: str | int, inner: str | int
) -> DataFrame:
    """Rows with outer window number and inner window ``[t0, t1)``.

    Outer window n starts at ``start + n * outer`` and is walked in inner strides; if ``inner``
    does not divide ``outer`` the last stride runs past the end, and its rows belong to both outer
    windows.
    """
    o, i = seconds(outer) * 1_000_000, seconds(inner) * 1_000_000
    reach = -(-o // i) * i
    offset = F.unix_micros(F.col(ts)) - _micros(start)
    newest = F.floor(offset / F.lit(o)).cast("bigint")
    oldest = F.greatest(F.floor((offset - F.lit(reach)) / F.lit(o)).cast("bigint") + 1, F.lit(0))
    inside = F.col("_offset") - F.col("outer_no") * F.lit(o)
    t0 = _micros(start) + F.col("outer_no") * F.lit(o) + F.floor(inside / F.lit(i)) * F.lit(i)
    return (
        df.where(F.col(ts) >= F.lit(str(start)).cast("timestamp"))
        .select("*", offset.alias("_offset"), F.explode(F.sequence(oldest, newest)).alias("outer_no"))
        .select("*", *_span(t0, seconds(inner)))
        .drop("_offset")
    )
