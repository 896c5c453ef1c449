"""Node ids and drug graphs in stores that grow batch by batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import merge_edges, merge_nodes, resolve_edge_ids
from ..operators.scale import number_rows
from ..session import materialize
from ..sources.buckets import BucketStore

# Tables of a store of named nodes and edges between their ids, as ``BucketStore`` takes them.
NAMED_GRAPH = {
    "names": ("label string, name string, id bigint", ["label", "name"]),
    "edges": ("from_id bigint, to_id bigint, rel string", ["from_id", "to_id", "rel"]),
}


def assign_ids(known: DataFrame, names: DataFrame, first: int) -> DataFrame:
    """(label, name, id) of the names that are not ``known``: first, first + 1, ... in order of label and name.

    Numbers come from sorted slices and one offset for each, so no task sees all names. Null labels
    or names have no node.
    """
    keys = ["label", "name"]
    asked = names.select(*keys).where(F.col("label").isNotNull() & F.col("name").isNotNull()).distinct()
    news = number_rows(asked.join(known.select(*keys), keys, "left_anti"), keys, "row_no")
    return news.select(*keys, (F.col("row_no") + F.lit(first)).cast("bigint").alias("id"))


def register_names(store: BucketStore, names: DataFrame, batch: int | None = None) -> int:
    """Give every new name of a batch an id in ``store``; names that have one keep it for ever.

    Reads the buckets of the batch's names only: the next free id is kept with each version. Ids are
    dense, and unique because a version is published once; a writer that comes second starts again.
    """
    if store.written(batch):
        return store.version()
    base = store.version()
    names = materialize(names.select("label", "name").distinct(), "names")
    touched = store.touched("names", names)
    known = store.read("names", base, touched)
    first = store.manifest(base)["counters"].get("next_id", 1)
    news = materialize(assign_ids(known, names, first), "new-names")
    count = news.count()
    changed = store.touched("names", news)
    rows = store.read("names", base, changed).unionByName(news)
    return store.publish(base, {"names": store.stage("names", rows, changed)}, batch, {"next_id": first + count})


def merge_named_graph(store: BucketStore, nodes: DataFrame, edges: DataFrame, batch: int | None = None) -> int:
    """Nodes (label, name) and edges (rel, src_label, src, dst_label, dst) of a batch into a ``NAMED_GRAPH`` store.

    Names get their ids first; edges are then merged by the ids of their ends. The edges' version
    carries the batch number: a batch that failed between the two is written again, and finds its
    names with the ids they have.
    """
    if store.written(batch):
        return store.version()
    register_names(store, nodes)
    edges = materialize(edges, "named-edges")
    ends = edges.select(F.col("src_label").alias("label"), F.col("src").alias("name")).unionByName(
        edges.select(F.col("dst_label").alias("label"), F.col("dst").alias("name"))).distinct()
    found = materialize(resolve_edge_ids(edges, store.lookup("names", ends)), "edges")
    return store.update(
        "edges", found, lambda part: part.unionByName(found.select("from_id", "to_id", "rel")).distinct(), batch)


def merge_nodes_stored(store: BucketStore, table: str, batch: DataFrame, as_of: str | dt.datetime, number: int | None = None) -> int:
    """``merge_nodes`` on a stored table whose key is all its properties: only the batch's buckets are grouped."""
    return store.update(table, batch, lambda part: merge_nodes(part, batch, as_of), number)


def merge_edges_stored(store: BucketStore, table: str, batch: DataFrame, edge_type: str, number: int | None = None) -> int:
    """``merge_edges`` on a stored table keyed by both ids and the type."""
    return store.update(
        table, batch, lambda part: merge_edges(part, batch, edge_type), number, ["from_id", "to_id", F.lit(edge_type)])
