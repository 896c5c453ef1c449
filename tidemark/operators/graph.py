"""Node and edge tables with match-or-create semantics.

Every upsert is a function from the current node table and a batch to the next node table. The
batch is reduced to one row per key first; both sides then have unique keys, so no join here can
multiply rows. A small batch is broadcast by the optimizer on its real size, in which case the
store is scanned but never shuffled. The reduced batch is stored first, because both the known and
the new nodes need it and what leads up to it may be costly.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ACCOUNT_PROPS, NODE_KEYS, TWEET_PROPS, URL_PROPS
from ..session import materialize
from .cleaning import quoted
from .dedupe import dedupe_keep_first, dedupe_keep_last
from .entities import as_timestamp, pick
from .scale import salted_join

STAMPS = ["hydrated", "record_created_at", "record_updated_at"]

# Batch column behind each node property.
TWEET_COLUMNS = {
    "id": "tweet_id", "text": "text", "created_at": "tweet_created_at",
    "favorite_count": "favorite_count", "retweet_count": "retweet_count",
    "job_name": "job_name", "job_id": "job_id", "hashtags": "hashtags", "type": "tweet_type",
    "geo": "geo", "ingest_method": "ingest_method",
}
ACCOUNT_COLUMNS = {
    "id": "user_id", "name": "user_name", "screen_name": "user_screen_name",
    "followers_count": "user_followers_count", "friends_count": "user_friends_count",
    "location": "user_location", "user_profile_image_url": "user_profile_image_url",
    "created_at": "user_created_at", "job_name": "job_name", "job_id": "job_id",
}
URL_COLUMNS = {"full_url": "full_url", **{p: p for p in URL_PROPS}}


def _fresh(batch: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """Batch rows whose key is not stored. Only the stored keys that occur in the batch are
    compared, so a large store contributes one column."""
    met = store.select(key).join(batch.select(key), key, "left_semi")
    return batch.join(met, key, "left_anti")


def _upsert(
    store: DataFrame, batch: DataFrame, key: str, props: Sequence[str], as_of: str | dt.datetime,
    create_only: Sequence[str] = (),
) -> DataFrame:
    """Create with all properties, or overwrite all but ``create_only``; both become FULL."""
    now, batch = as_timestamp(as_of), materialize(batch, "upsert")
    news = batch.select(
        key, F.struct(*[F.col(p) for p in props if p in batch.columns]).alias("_new")
    )
    hit = F.col("_new").isNotNull()
    columns = []
    for c in store.columns:
        if c == key:
            columns.append(F.col(key))
        elif c == "hydrated":
            columns.append(F.when(hit, "FULL").otherwise(F.col(c)).alias(c))
        elif c == "record_updated_at":
            columns.append(F.when(hit, now).otherwise(F.col(c)).alias(c))
        elif c in create_only and c in batch.columns:
            # A stub met before its post has no creation time yet: fill it.
            columns.append(F.coalesce(F.col(c), F.col(f"_new.{c}")).alias(c))
        elif c in props and c in batch.columns:
            columns.append(F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    kept = store.join(news, key, "left").select(*columns)
    created = _created(_fresh(batch, store, key), store, "FULL", now)
    return kept.unionByName(created)


def _created(rows: DataFrame, store: DataFrame, hydrated: str | None, now: Column) -> DataFrame:
    """New nodes in the store's columns."""
    out = []
    for f in store.schema.fields:
        if f.name == "record_created_at":
            c = now
        elif f.name == "hydrated" and hydrated is not None:
            c = F.lit(hydrated)
        elif f.name in rows.columns and f.name != "record_updated_at":
            c = F.col(f.name)
        else:
            c = F.lit(None)
        out.append(c.cast(f.dataType).alias(f.name))
    return rows.select(*out)


def _create_missing(
    store: DataFrame, rows: DataFrame, key: str, hydrated: str | None, as_of: str | dt.datetime
) -> DataFrame:
    rows = materialize(rows, "create")
    return store.unionByName(_created(_fresh(rows, store, key), store, hydrated, as_timestamp(as_of)))


def upsert_tweets(
    store: DataFrame, batch: DataFrame, as_of: str | dt.datetime, order_cols: Sequence[str]
) -> DataFrame:
    """Posts of the batch become FULL; ``created_at`` of a known post is never overwritten.

    Of several rows of a post the last by ``order_cols`` counts.
    """
    rows = dedupe_keep_last(batch, ["tweet_id"], order_cols)
    columns = {new: old for new, old in TWEET_COLUMNS.items() if old in rows.columns}
    return _upsert(store, pick(rows, columns), "id", TWEET_PROPS, as_of, ["created_at"])


def upsert_accounts(
    store: DataFrame, batch: DataFrame, as_of: str | dt.datetime, order_cols: Sequence[str]
) -> DataFrame:
    """Authors of the batch become FULL, with the properties of their last row by ``order_cols``."""
    rows = batch.where(F.col("user_id").isNotNull())
    rows = dedupe_keep_last(pick(rows, {**ACCOUNT_COLUMNS, **{c: c for c in order_cols}}), ["id"], order_cols)
    return _upsert(store, rows, "id", ACCOUNT_PROPS, as_of)


# Which batch column holds the target of each post type, and the name of the edge to it.
TARGETS = {
    "REPLY": ("reply_tweet_id", "REPLIED"),
    "QUOTE_RETWEET": ("quoted_status_id", "QUOTED"),
    "RETWEET": ("retweet_id", "RETWEETED"),
}


def target_id() -> Column:
    """The post another post answers, quotes or shares, by its type; null if none."""
    target = F.lit(None).cast("bigint")
    for kind, (column, _) in TARGETS.items():
        target = F.when(F.col("tweet_type") == kind, F.col(column)).otherwise(target)
    return F.when(target > 0, target)


def target_rel() -> Column:
    rel = F.lit(None).cast("string")
    for kind, (_, name) in TARGETS.items():
        rel = F.when(F.col("tweet_type") == kind, name).otherwise(rel)
    return rel


def stub_tweets(store: DataFrame, batch: DataFrame, as_of: str | dt.datetime) -> DataFrame:
    """Targets that are not stored are created as PARTIAL; stored ones stay as they are."""
    targets = (
        batch.select(target_id().alias("id"), "job_name", "job_id")
        .where(F.col("id").isNotNull())
        # Name and id of one and the same job.
        .groupBy("id").agg(F.min(F.struct("job_name", "job_id")).alias("job"))
        .select("id", "job.job_name", "job.job_id")
    )
    return _create_missing(store, targets, "id", "PARTIAL", as_of)


def _of_known_posts(rows: DataFrame, posts: DataFrame) -> DataFrame:
    known = posts.select(F.col("id").alias("tweet_id"))
    return rows.join(known, "tweet_id", "left_semi")


def upsert_mentioned_accounts(
    accounts: DataFrame, mentions: DataFrame, posts: DataFrame, as_of: str | dt.datetime
) -> DataFrame:
    """Accounts mentioned by known posts are created as PARTIAL if they are new."""
    rows = _of_known_posts(mentions, posts).where(F.col("user_id").isNotNull()).select(
        F.col("user_id").alias("id"), F.col("user_name").alias("name"),
        F.col("user_screen_name").alias("screen_name"), "job_name", "job_id",
    )
    once = dedupe_keep_first(rows, ["id"], ())
    return _create_missing(accounts, once, "id", "PARTIAL", as_of)


def upsert_urls(
    store: DataFrame, urls: DataFrame, posts: DataFrame, as_of: str | dt.datetime,
    order_cols: Sequence[str] = ("tweet_id",),
) -> DataFrame:
    """Links of known posts, created once; known links keep their properties."""
    rows = _of_known_posts(urls, posts)
    once = dedupe_keep_first(rows, ["full_url"], order_cols)
    return _create_missing(store, pick(once, URL_COLUMNS), "full_url", None, as_of)


# --- edges -----------------------------------------------------------------------------------

def edges_tweeted(posts: DataFrame) -> DataFrame:
    """Account to post, once each."""
    return posts.where(F.col("user_id").isNotNull()).select(
        F.col("user_id").alias("src_id"), F.col("tweet_id").alias("dst_id"), F.lit("TWEETED").alias("rel")
    ).distinct()


def _typed_edges(posts: DataFrame) -> DataFrame:
    return posts.select(
        F.col("tweet_id").alias("src_id"), target_id().alias("dst_id"), target_rel().alias("rel")
    ).where(F.col("dst_id").isNotNull()).distinct()


def _to_known(edges: DataFrame, nodes: DataFrame, end: str) -> DataFrame:
    """Edges whose end is a stored node; a popular end is spread over many tasks."""
    other = "src_id" if end == "dst_id" else "dst_id"
    return salted_join(edges, nodes.select(F.col("id").alias(end)), end, "left_semi", [other])


def _edges_of(posts: DataFrame, store: DataFrame, kind: str) -> DataFrame:
    rows = posts.where(F.col("tweet_type") == kind)
    return _to_known(_typed_edges(rows), store, "dst_id").select("src_id", "dst_id", "rel")


def edges_replied(posts: DataFrame, store: DataFrame) -> DataFrame:
    return _edges_of(posts, store, "REPLY")


def edges_quoted(posts: DataFrame, store: DataFrame) -> DataFrame:
    return _edges_of(posts, store, "QUOTE_RETWEET")


def edges_retweeted(posts: DataFrame, store: DataFrame) -> DataFrame:
    return _edges_of(posts, store, "RETWEET")


def resolve_relationships(posts: DataFrame, tweets: DataFrame, accounts: DataFrame) -> DataFrame:
    """All edges of a batch between stored nodes: author to post, and post to its target.

    A post counts only if both it and its author are stored.
    """
    rows = posts.join(tweets.select(F.col("id").alias("tweet_id")), "tweet_id", "left_semi")
    rows = salted_join(
        rows, accounts.select(F.col("id").alias("user_id")), "user_id", "left_semi", ["tweet_id"]
    )
    typed = _to_known(_typed_edges(rows), tweets, "dst_id")
    return edges_tweeted(rows).unionByName(typed.select("src_id", "dst_id", "rel"))


def edges_mentioned(mentions: DataFrame, posts: DataFrame) -> DataFrame:
    """Known post to mentioned account; the account's screen name stands in for a missing id."""
    target = F.col("user_screen_name")
    if "user_id" in mentions.columns:
        target = F.coalesce(F.col("user_id").cast("string"), target)
    return _of_known_posts(mentions, posts).select(
        F.col("tweet_id").alias("src_id"), target.alias("dst_key"), F.lit("MENTIONED").alias("rel")
    ).distinct()


def edges_includes(urls: DataFrame, posts: DataFrame) -> DataFrame:
    """Known post to link."""
    return _of_known_posts(urls, posts).select(
        F.col("tweet_id").alias("src_id"), F.col("full_url").alias("dst_key"), F.lit("INCLUDES").alias("rel")
    ).distinct()


# --- free-form merges ------------------------------------------------------------------------

def enrich_nodes(
    store: DataFrame, batch: DataFrame, label: str, allow_new_columns: bool = False,
    order_cols: Sequence[str] = (),
) -> DataFrame:
    """Set the batch's columns on the nodes of a label, creating missing nodes; properties the
    batch does not have survive."""
    if not isinstance(label, str) or label not in NODE_KEYS:
        raise TypeError(f"label must be one of {', '.join(NODE_KEYS)}")
    if not isinstance(batch, DataFrame) or not isinstance(store, DataFrame):
        raise TypeError("store and batch must be DataFrames")
    key = NODE_KEYS[label]
    added = [f for f in batch.schema.fields if f.name not in store.columns]
    if added and not allow_new_columns:
        raise ValueError(f"unknown properties: {', '.join(f.name for f in added)}")
    for f in added:
        store = store.withColumn(f.name, F.lit(None).cast(f.dataType))
    rows = materialize(dedupe_keep_last(batch, [key], order_cols), "enrich")
    values = [c for c in batch.columns if c != key]
    news = rows.select(quoted(key), F.struct(*[quoted(c) for c in values]).alias("_new"))
    hit = F.col("_new").isNotNull()
    kept = store.join(news, key, "left").select(*[
        F.when(hit, F.col("_new").getField(c)).otherwise(quoted(c)).alias(c) if c in values
        else quoted(c)
        for c in store.columns
    ])
    fresh = _fresh(rows, store, key)
    return kept.unionByName(fresh.select(*[
        (quoted(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in store.schema.fields
    ]))


def merge_nodes(store: DataFrame, batch: DataFrame, as_of: str | dt.datetime) -> DataFrame:
    """Nodes matched on all their properties, nulls included: new ones are stamped as created,
    known ones as updated.

    Store and batch are aggregated together, so a node with many copies in the batch is reduced
    before the shuffle and one shuffle does both the match and the de-duplication.
    """
    now = as_timestamp(as_of)
    props = [c for c in store.columns if c not in ("record_created_at", "record_updated_at")]
    stored = store.withColumns({"_known": F.lit(1), "_sent": F.lit(0)})
    sent = batch.select(*[quoted(p) for p in props]).withColumns({
        "record_created_at": F.lit(None).cast("timestamp"),
        "record_updated_at": F.lit(None).cast("timestamp"),
        "_known": F.lit(0), "_sent": F.lit(1),
    })
    grouped = stored.unionByName(sent).groupBy(*[quoted(p) for p in props]).agg(
        F.max("record_created_at").alias("_created"), F.max("record_updated_at").alias("_updated"),
        F.max("_known").alias("_known"), F.max("_sent").alias("_sent"),
    )
    both = (F.col("_known") == 1) & (F.col("_sent") == 1)
    return grouped.select(
        *[quoted(p) for p in props],
        F.when(F.col("_known") == 1, F.col("_created")).otherwise(now).alias("record_created_at"),
        F.when(both, now).otherwise(F.col("_updated")).alias("record_updated_at"),
    )


def merge_edges(store: DataFrame, batch: DataFrame, edge_type: str) -> DataFrame:
    """Each ``(from_id, to_id, type)`` once."""
    rows = batch.select("from_id", "to_id", F.lit(edge_type).alias("rel"))
    return store.select("from_id", "to_id", "rel").unionByName(rows).distinct()


def _named_ends(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    for end, out in (("src", "from_id"), ("dst", "to_id")):
        other = "dst" if end == "src" else "src"
        lookup = nodes.select(
            F.col("label").alias(f"{end}_label"), F.col("name").alias(end), F.col("id").alias(out)
        )
        edges = salted_join(edges, lookup, [f"{end}_label", end], "left", [other])
    return edges


def resolve_edge_ids(
    edges: DataFrame, nodes: DataFrame, on_missing: str = "error"
) -> DataFrame:
    """Edge ends ``(src_label, src, dst_label, dst)`` to node ids ``(from_id, to_id)``.

    Ends are keyed by label and name. An unknown name fails the job, or is left out with
    ``on_missing="drop"``; ``unresolved_edges`` lists such edges.
    """
    found = _named_ends(edges, nodes)
    if on_missing == "drop":
        found = found.where(F.col("from_id").isNotNull() & F.col("to_id").isNotNull())
        ids = [F.col("from_id"), F.col("to_id")]
    else:
        ids = [
            F.when(F.col(i).isNotNull(), F.col(i)).otherwise(
                F.raise_error(F.concat(F.lit("no node named "), F.coalesce(F.col(end), F.lit("null"))))
            ).cast(found.schema[i].dataType).alias(i)
            for i, end in (("from_id", "src"), ("to_id", "dst"))
        ]
    rest = [c for c in edges.columns if c not in ("src", "dst", "src_label", "dst_label")]
    return found.select(*ids, *rest)


def unresolved_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    return _named_ends(edges, nodes).where(
        F.col("from_id").isNull() | F.col("to_id").isNull()
    ).select(*edges.columns)


def empty_store(like: Mapping[str, str], spark) -> DataFrame:
    """A node table without rows, from ``{column: type}``."""
    ddl = ", ".join(f"`{n}` {t}" for n, t in like.items())
    return spark.createDataFrame([], ddl)
