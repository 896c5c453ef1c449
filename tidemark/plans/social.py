"""Composed flows over posts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.cleaning import (
    coerce_columns, drop_columns, enforce_schema, fill_expected_columns, sort_columns,
)
from ..operators.entities import as_timestamp
from ..operators.graph import (
    edges_includes, edges_mentioned, resolve_relationships, stub_tweets, target_id, target_rel, upsert_accounts,
    upsert_mentioned_accounts, upsert_tweets, upsert_urls,
)
from ..operators.hydration import needs_hydration, tweet_hydration_status, unseen_users
from ..operators.search import match_any_phrase, stride_windows, stride_windows_limited
from ..operators.status import classify_graph_type, normalize_status
from ..schemas import STATUS_SCHEMA
from ..session import materialize
from ..sources.archive import HourlyArchive
from ..sources.buckets import BucketStore


def search_time_range(
    df: DataFrame, ts: str, text: str, terms: Sequence[str],
    since: str | dt.datetime, until: str | dt.datetime, stride: str | int = 600,
    limit: int | None = None, store: DataFrame | None = None, key: str = "id",
    order_cols: Sequence[str] = (),
) -> DataFrame:
    """Posts that match a phrase, tagged with their stride window; with a store, only one row per
    id and none that is stored in full. One lazy plan: scan, filter, window, anti join."""
    matches = match_any_phrase(F.col(text), terms) if terms else F.lit(True)
    if limit is None:
        # The bounds of time stand below the phrases: they are cheap and reach the scan.
        hits = stride_windows(df, ts, since, until, stride).where(matches)
    else:
        hits = stride_windows_limited(df.where(matches), ts, since, until, stride, limit)
    return hits if store is None else needs_hydration(hits, store, key, order_cols)


def search_to_archive(
    df: DataFrame, ts: str, text: str, terms: Sequence[str], since: str | dt.datetime, until: str | dt.datetime,
    archive: HourlyArchive, job_name: str, enriched: DataFrame, profiles: DataFrame, stride: str | int = 600,
    limit: int | None = None, store: DataFrame | None = None, key: str = "id", order_cols: Sequence[str] = (),
    user: str = "username",
) -> DataFrame:
    """A windowed search that keeps what it finds: posts go to the hourly archive by the hour of their window,
    and the profiles of users not in ``enriched`` are returned, each once.

    The archive knows the search by job and span, so the same search adds nothing a second time; profiles
    are those of the posts it found then.
    """
    span = f"{job_name}-{since}-{until}"
    if not archive.committed(span, 0):
        hits = search_time_range(df, ts, text, terms, since, until, stride, limit, store, key, order_cols)
        archive.add(hits.withColumn("ingest_hour", F.date_format("t0", "yyyy-MM-dd-HH")), span, 0, span)
    found = archive.read(df.schema, job_name=span)
    return unseen_users(found, enriched, profiles, user, key)


def to_archive(posts: DataFrame) -> DataFrame:
    """Incoming posts to the fixed archive columns."""
    ready = posts.transform(drop_columns).transform(fill_expected_columns)
    ready = ready.transform(sort_columns).transform(coerce_columns)
    archive, _ = enforce_schema(ready, STATUS_SCHEMA)
    return archive


def rehydrate(ids: DataFrame, store: DataFrame, posts: DataFrame, key: str = "id") -> DataFrame:
    """Requested ids that are not stored in full, fetched from a post table and flattened."""
    status = tweet_hydration_status(ids, store, key)
    missing = status.where(~F.col("hydrated").eqNullSafe("FULL")).select(key)
    return posts.join(missing, key, "left_semi").transform(to_archive).transform(normalize_status)


def _graph_changes(
    stores: Mapping[str, DataFrame], posts: DataFrame, mentions: DataFrame, urls: DataFrame,
    as_of: str | dt.datetime, order_cols: Sequence[str],
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The node tables after a batch, and the batch's edges (rel, src, dst).

    Only rows of the batch's own keys are looked up or changed, so ``stores`` may be parts of tables
    that hold all of those. Every step is stored before it is read again.
    """
    full = materialize(upsert_tweets(stores["tweets"], posts, as_of, order_cols), "tweets")
    tweets = materialize(stub_tweets(full, posts, as_of), "tweets")
    authors = materialize(upsert_accounts(stores["accounts"], posts, as_of, order_cols), "accounts")
    accounts = materialize(upsert_mentioned_accounts(authors, mentions, full, as_of), "accounts")
    links = upsert_urls(stores["urls"], urls, full, as_of)
    edges = resolve_relationships(posts, tweets, accounts).select(
        "rel", F.col("src_id").cast("string").alias("src"), F.col("dst_id").cast("string").alias("dst"))
    for made in (edges_mentioned(mentions, full), edges_includes(urls, full)):
        edges = edges.unionByName(made.select("rel", F.col("src_id").cast("string").alias("src"), F.col("dst_key").alias("dst")))
    return {"tweets": tweets, "accounts": accounts, "urls": links}, edges


def archive_to_graph(
    stores: Mapping[str, DataFrame], posts: DataFrame, mentions: DataFrame, urls: DataFrame,
    as_of: str | dt.datetime, order_cols: Sequence[str],
) -> dict[str, DataFrame]:
    """One batch written into an existing graph: node tables ``tweets``, ``accounts``, ``urls`` with all
    properties, and ``edges`` (rel, src, dst).

    ``posts`` are rows of ``graph_rows``; ``mentions`` and ``urls`` those of ``explode_mentions`` and
    ``explode_urls``. The same batch may be written again: nodes are matched by key, edges are
    distinct. The batch is computed once and a store is read once for its new version; ``archive_to_store``
    writes only the parts of a large graph that a batch touches.
    """
    rows = [materialize(df, label) for df, label in ((posts, "batch"), (mentions, "mentions"), (urls, "links"))]
    nodes, edges = _graph_changes(stores, *rows, as_of, order_cols)
    return {**nodes, "edges": stores["edges"].select("rel", "src", "dst").unionByName(edges).distinct()}


# Key columns of a graph's tables, as ``BucketStore`` takes them.
GRAPH_KEYS = {"tweets": ["id"], "accounts": ["id"], "urls": ["full_url"], "edges": ["src", "rel", "dst"]}


def archive_to_store(
    store: BucketStore, posts: DataFrame, mentions: DataFrame, urls: DataFrame,
    as_of: str | dt.datetime, order_cols: Sequence[str], batch: int | None = None,
) -> int:
    """``archive_to_graph`` into a ``BucketStore`` with tables of ``GRAPH_KEYS``; returns the version.

    Reads and rewrites the buckets of the batch's own posts, targets, accounts, links and edges, and
    publishes all four tables together: cost follows the batch, and readers never see half of one. A
    batch number that is written already changes nothing.
    """
    if store.written(batch):
        return store.version()
    base = store.version()
    rows = [materialize(df, label) for df, label in ((posts, "batch"), (mentions, "mentions"), (urls, "links"))]
    posts, mentions, urls = rows
    met = {
        "tweets": [posts.select("tweet_id"), posts.select(target_id()), mentions.select("tweet_id"), urls.select("tweet_id")],
        "accounts": [posts.select("user_id"), mentions.select("user_id")],
        "urls": [urls.select("full_url")],
    }
    touched = {n: set().union(*(store.touched(n, df, df.columns) for df in keys)) for n, keys in met.items()}
    nodes, edges = _graph_changes({n: store.read(n, base, b) for n, b in touched.items()}, *rows, as_of, order_cols)
    edges = materialize(edges, "edges")
    touched["edges"] = store.touched("edges", edges)
    nodes["edges"] = store.read("edges", base, touched["edges"]).unionByName(edges).distinct()
    return store.publish(base, {n: store.stage(n, df, touched[n]) for n, df in nodes.items()}, batch)


def _keys_of(posts: DataFrame, col: str, fields: Sequence[str]) -> Column:
    """Keys held by a list column, as texts: of plain texts or of structs with one of ``fields``."""
    none = F.array().cast("array<string>")
    if col not in posts.columns:
        return none
    keys = F.col(col)
    if posts.schema[col].dataType.elementType.typeName() == "struct":
        keys = F.transform(keys, lambda e: F.coalesce(*[e[f].cast("string") for f in fields]))
    return F.coalesce(keys, none)


def _candidates(posts: DataFrame) -> DataFrame:
    """Per post: author, type, target, and the keys of mentioned accounts and links."""
    absent = F.lit(None).cast("bigint")
    ids = {
        "tweet_id": "status_id", "reply_tweet_id": "in_reply_to_status_id",
        "quoted_status_id": "quoted_status_id", "retweet_id": "retweet_id", "user_id": "user_id",
    }
    typed = classify_graph_type(posts)
    return typed.select(
        "tweet_type",
        *[(F.col(old) if old in posts.columns else absent).alias(new) for new, old in ids.items()],
        _keys_of(posts, "user_mentions", ("id", "screen_name")).alias("mentioned"),
        _keys_of(posts, "urls", ("expanded_url",)).alias("links"),
    ).select(
        F.col("tweet_id").cast("string").alias("post"), F.col("user_id").cast("string").alias("author"),
        target_id().cast("string").alias("target"), target_rel().alias("target_rel"),
        "mentioned", "links",
    )


def _node(label: str, key: Column, hydrated: str | None) -> Column:
    return F.struct(
        F.lit(label).alias("label"), key.alias("node_key"),
        F.lit(hydrated).cast("string").alias("hydrated"),
    )


def _edge(rel: Column, src: Column, dst: Column) -> Column:
    return F.struct(rel.alias("rel"), src.alias("src"), dst.alias("dst"))


def build_social_graph(
    posts: DataFrame, as_of: str | dt.datetime
) -> tuple[DataFrame, DataFrame]:
    """Nodes ``(label, node_key, hydrated, record_created_at)`` and edges ``(rel, src, dst)``.

    ``posts`` are flat posts; ``urls`` and ``user_mentions`` are used where present. Every post
    yields its own nodes and edges in one pass, and one pre-aggregated grouping merges them: a
    popular account or link costs one row per task, and nothing is joined. Posts and authors are
    FULL, targets and mentioned accounts PARTIAL unless they are also posts or authors.
    """
    c = _candidates(posts)
    post, author, target = F.col("post"), F.col("author"), F.col("target")
    nodes = (
        c.select(F.explode(F.concat(
            F.array(
                _node("Tweet", post, "FULL"), _node("Account", author, "FULL"),
                _node("Tweet", target, "PARTIAL"),
            ),
            F.transform("mentioned", lambda m: _node("Account", m, "PARTIAL")),
            F.transform("links", lambda u: _node("Url", u, None)),
        )).alias("n")).select("n.*")
        .where(F.col("node_key").isNotNull())
        # FULL sorts before PARTIAL.
        .groupBy("label", "node_key").agg(F.min("hydrated").alias("hydrated"))
        .withColumn("record_created_at", as_timestamp(as_of))
    )
    edges = (
        c.select(F.explode(F.concat(
            F.array(
                _edge(F.lit("TWEETED"), author, post), _edge(F.col("target_rel"), post, target),
            ),
            F.transform("mentioned", lambda m: _edge(F.lit("MENTIONED"), post, m)),
            F.transform("links", lambda u: _edge(F.lit("INCLUDES"), post, u)),
        )).alias("e")).select("e.*")
        .where(F.col("src").isNotNull() & F.col("dst").isNotNull())
        .distinct()
    )
    return nodes, edges
