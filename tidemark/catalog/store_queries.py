"""Upserts and merges into stores in buckets, and ids for names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as op
from .. import plans, sources
from .graph_queries import (
    MERGE_EDGES_SQL, MERGE_NODES_SQL, UPSERT_SQL, edge_rows, node_store, tweet_batch, tweet_columns, tweet_store,
)
from .registry import query
from .views import AS_OF, Views

BUCKETS = 16


def _stored(v: Views, table: str, rows: DataFrame, keys: list[str]) -> sources.BucketStore:
    """A store whose first version holds ``rows``."""
    store = sources.BucketStore(v.spark, v.new_path("store"), {table: (sources.schema_ddl(rows.schema), keys)}, BUCKETS)
    store.publish(0, {table: store.stage(table, rows, range(BUCKETS))}, 0)
    return store


@query("store_upsert_tweets", UPSERT_SQL)
def _(v: Views) -> DataFrame:
    """The upsert of posts into a stored table, sent twice; only buckets of the batch's ids are written."""
    store, batch = _stored(v, "tweets", tweet_store(v), ["id"]), tweet_batch(v)
    for _ in range(2):
        store.update("tweets", batch, lambda part: op.upsert_tweets(part, batch, AS_OF, ["seq"]), 1, ["tweet_id"])
    return tweet_columns(store.read("tweets"))


@query("store_merge_nodes", MERGE_NODES_SQL)
def _(v: Views) -> DataFrame:
    store = _stored(v, "parts", node_store(v), ["p_brand", "p_type"])
    plans.merge_nodes_stored(store, "parts", v.table("part").where(F.col("p_size") > 3), AS_OF, 1)
    return store.read("parts").select(
        "p_brand", "p_type", *[F.unix_micros(f"record_{w}_at").alias(f"record_{w}_us") for w in ("created", "updated")])


@query("store_merge_edges", MERGE_EDGES_SQL)
def _(v: Views) -> DataFrame:
    first, batch = edge_rows(v)
    store = _stored(v, "edges", first, ["from_id", "to_id", "rel"])
    plans.merge_edges_stored(store, "edges", batch, "SUPPLIED_BY", 1)
    return store.read("edges")


_NAMES = """
    n AS (
        SELECT 'Brand' AS label, p_brand AS name, p_size FROM part UNION ALL SELECT 'Type', p_type, p_size FROM part
        UNION ALL SELECT 'Part', p_name, p_size FROM part),
    a AS (SELECT label, name, row_number() OVER (ORDER BY label, name) AS id FROM (SELECT DISTINCT label, name FROM n WHERE p_size <= 20)),
    ids AS (
        SELECT * FROM a UNION ALL
        SELECT label, name, (SELECT max(id) FROM a) + row_number() OVER (ORDER BY label, name)
        FROM (SELECT label, name FROM n WHERE p_size >= 15 EXCEPT SELECT label, name FROM a))"""


def _names(v: Views) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("label"), F.col(c).alias("name")) for n, c in (("Brand", "p_brand"), ("Type", "p_type"), ("Part", "p_name"))])
    return v.table("part").select("p_size", F.explode(pairs).alias("n")).select("p_size", "n.*")


@query("register_names", f"WITH {_NAMES} SELECT label, name, id FROM ids")
def _(v: Views) -> DataFrame:
    """Names of two batches that overlap, and the second batch again: ids stay as they were given."""
    store, names = sources.BucketStore(v.spark, v.new_path("names"), plans.NAMED_GRAPH, BUCKETS), _names(v)
    for number, rows in enumerate((names.where("p_size <= 20"), names.where("p_size >= 15"), names.where("p_size >= 15"))):
        plans.register_names(store, rows, min(number, 1))
    return store.read("names")


@query("merge_named_graph", f"""
    WITH {_NAMES},
    e AS (SELECT 'HAS_BRAND' AS rel, 'Brand' AS label, p_name AS src, p_brand AS dst FROM part WHERE p_size <= 20 OR p_size >= 15
          UNION SELECT 'HAS_TYPE', 'Type', p_name, p_type FROM part WHERE p_size <= 20 OR p_size >= 15)
    SELECT f.id AS from_id, t.id AS to_id, rel FROM e JOIN ids f ON f.label = 'Part' AND f.name = src
    JOIN ids t ON t.label = e.label AND t.name = dst""")
def _(v: Views) -> DataFrame:
    """Nodes and edges by name, batch by batch, into edges between ids."""
    store, part = sources.BucketStore(v.spark, v.new_path("graph"), plans.NAMED_GRAPH, BUCKETS), v.table("part")
    names = _names(v)

    def edges(rows: DataFrame) -> DataFrame:
        ends = F.array(*[F.struct(F.lit(r).alias("rel"), F.lit(n).alias("dst_label"), F.col(c).alias("dst"))
                         for r, n, c in (("HAS_BRAND", "Brand", "p_brand"), ("HAS_TYPE", "Type", "p_type"))])
        return rows.select(F.lit("Part").alias("src_label"), F.col("p_name").alias("src"), F.explode(ends).alias("e")).select(
            "e.rel", "src_label", "src", "e.dst_label", "e.dst")

    for number, some in enumerate(("p_size <= 20", "p_size >= 15")):
        plans.merge_named_graph(store, names.where(some), edges(part.where(some)), number)
    return store.read("edges")
