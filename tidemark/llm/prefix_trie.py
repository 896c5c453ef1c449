"""Prefix trie of conversations, gathered with z-fast tries and merged by prefix.

A node is a sequence of turns some conversation starts with; its members are the conversations that
start with it. Every prefix has a key: a digest of the key before it and the turn's digest.

Each task reads its conversations once and inserts them, batch after batch, into a z-fast trie. It
holds compacted nodes only: a node ends where conversations part or end, and stands for all prefixes
between its parent's end (``low``, left out) and its own (``high``). A hash table finds a node by the
key of one prefix, at its handle: the depth in (low, high] that most powers of two divide. Where a
conversation leaves the trie is found by fat binary search: of the depths still possible the one
that most powers of two divide is looked up; a hit moves the lower end to the node's end, a miss the
upper end below that depth. That takes a number of lookups logarithmic in the number of turns. The
exit node is split where the conversation parts from it, and takes the rest as a new leaf. When
``TRIE_NODES`` compacted nodes are held, and at the end, members are summed up from the leaves, the
edges are expanded to one row for each prefix, and the trie is emptied. Rows of one prefix from
several tries are added up in Spark, so neither a first turn nor a conversation that holds most rows
needs to be in one task, and the result does not depend on how conversations are dealt out.

Equal conversations are one class, inserted once with the number of its members. Sums over a subtree
need no walk up the tree: the least member of a node is the least member of every node below it on
its own path, so each prefix text is counted for one owner. A class adds, at each of its prefixes,
the length of its texts from there on for each member, without the texts that its least member owns;
and one leaf if nothing goes on after its last turn.

Defined results: turns are ordered by turn (null first), turns of equal number by the digest of role
and text, repeated rows stay repeated turns; null role or text is empty; rows without conv_id belong
to no conversation and are left out; other columns are not read. Conversations are rows of their own
size: all turns' digests of one are held by a task. No rows give no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scale import number_rows, salted_join
from .shared import materialize

# Compacted nodes a task holds before it gives its rows and starts again.
TRIE_NODES = 200_000
# Ids written as one text before they are hashed.
LIST_IDS = 1_000
ROOT = hashlib.blake2b(b"root", digest_size=16).digest()


def fattest(low: int, high: int) -> int:
    """The number in (low, high] that most powers of two divide."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class Node:
    """A compacted node: prefixes of ``path`` at depths low + 1 to high (depth 0 for the root)."""

    __slots__ = ("low", "high", "path", "children", "ends", "least")

    def __init__(self, low: int, high: int, path: list[bytes]):
        self.low, self.high, self.path = low, high, path
        self.children: dict[bytes, Node] = {}
        self.ends, self.least = 0, None


class ZFastTrie:
    """Compacted trie over paths of prefix keys: ``path[d]`` is the key of the first d turns."""

    def __init__(self):
        self.root = Node(0, 0, [ROOT])
        self.handles: dict[bytes, Node] = {}

    def _name(self, node: Node, forget: bool = False) -> None:
        """Enter a node in the table at its handle, or take it out."""
        key = node.path[fattest(node.low, node.high)]
        if forget:
            del self.handles[key]
        else:
            self.handles[key] = node

    def exit_node(self, path: list[bytes]) -> tuple[Node, Node | None, int]:
        """(deepest node whose end is on the path, node below it that the path enters, depth at which the path parts)."""
        low, high, at = 0, len(path) - 1, self.root
        while low < high:
            depth = fattest(low, high)
            hit = self.handles.get(path[depth])
            if hit is None:
                high = depth - 1
            elif hit.high < len(path) and hit.path[hit.high] == path[hit.high]:
                at, low = hit, hit.high
            else:
                # The path leaves inside this node's edge, so the last end on the path is above.
                high = depth - 1
        if at.high == len(path) - 1:
            return at, None, at.high
        below = at.children.get(path[at.high + 1])
        if below is None:
            return at, None, at.high
        # Keys of an edge agree up to the parting depth: binary search for it.
        a, b = at.high + 1, min(below.high, len(path) - 1)
        while a < b:
            middle = (a + b + 1) // 2
            if below.path[middle] == path[middle]:
                a = middle
            else:
                b = middle - 1
        return at, below, a

    def insert(self, path: list[bytes], members: int, least: int) -> None:
        """Add a path that ``members`` conversations take to its end, ``least`` the smallest of them."""
        at, below, parts = self.exit_node(path)
        if below is not None:
            # Split the edge; the upper part is a new node, the lower part keeps its children.
            self._name(below, forget=True)
            upper = Node(at.high, parts, below.path)
            at.children[path[at.high + 1]] = upper
            below.low = parts
            upper.children[below.path[parts + 1]] = below
            self._name(below)
            self._name(upper)
            at = upper
        if at.high < len(path) - 1:
            leaf = Node(at.high, len(path) - 1, path)
            at.children[path[at.high + 1]] = leaf
            self._name(leaf)
            at = leaf
        at.ends += members
        at.least = least if at.least is None else min(at.least, least)

    def nodes(self) -> list[Node]:
        """All nodes, parents before their children."""
        order = [self.root]
        for node in order:
            order.extend(node.children.values())
        return order

    def expand(self) -> Iterator[tuple[bytes, bytes | None, int, int, int]]:
        """(key, parent key, depth, members, least member) of every prefix."""
        order = self.nodes()
        counts: dict[int, tuple[int, int | None]] = {}
        for node in reversed(order):
            members, least = node.ends, node.least
            for child in node.children.values():
                n, smallest = counts.pop(id(child))
                members += n
                least = smallest if least is None else min(least, smallest)
            counts[id(node)] = (members, least)
            if least is None:
                continue
            for depth in range(node.low + 1 if node.high else 0, node.high + 1):
                yield node.path[depth], node.path[depth - 1] if depth else None, depth, members, least


_NODE_FIELDS = "key binary, parent binary, depth long, n_convs long, conv_id long"


def _gathered(batches: Iterator[pa.RecordBatch], trie_nodes: int) -> Iterator[pa.RecordBatch]:
    """Partial nodes of all paths of a task."""
    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = [f.split()[0] for f in _NODE_FIELDS.split(", ")]

    def rows_of(trie: ZFastTrie) -> Iterator[pa.RecordBatch]:
        rows = trie.expand()
        while held := list(islice(rows, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    trie = ZFastTrie()
    for batch in batches:
        for least, members, keys in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            trie.insert(keys, members, least)
        if len(trie.handles) >= trie_nodes:
            yield from rows_of(trie)
            trie = ZFastTrie()
    yield from rows_of(trie)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys and text sizes of all prefixes of each conversation, from the digests and sizes of its turns."""
    for batch in batches:
        out = [list(accumulate(digests, lambda key, d: hashlib.blake2b(key + d, digest_size=16).digest(), initial=ROOT))
               for digests in batch.column(1).to_pylist()]
        sums = [list(accumulate(sizes, initial=0)) for sizes in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([k[-1] for k in out], pa.binary()), pa.array(out, pa.list_(pa.binary())), pa.array(sums, pa.list_(pa.int64()))],
            names=["conv_id", "end", "keys", "sums"])


def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) of every conversation: its turns in order, each as (digest, size of the text in code points)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The length keeps role and text apart.
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    marked = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(
            F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"), digest.alias("digest"),
            F.length(text).cast("long").alias("size")).alias("t"))
    listed = marked.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


def conversation_paths(lists: DataFrame) -> DataFrame:
    """(conv_id, end, keys, sums): the key of every prefix of a conversation, the last one, and the size of its texts."""
    flat = lists.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.size").alias("sizes"))
    return flat.mapInArrow(_keyed, "conv_id long, end binary, keys array<binary>, sums array<long>")


def _ends(paths: DataFrame) -> DataFrame:
    """(key, ends_sha256) of every node that conversations end at: of their ids in order, joined by commas.

    Ids get their number in the order of all, runs of ``LIST_IDS`` become one text each, and a node's texts
    are hashed one after the other: a node of any number of members is read by one task as few short texts.
    """
    placed = number_rows(paths.select("end", "conv_id"), ["end", "conv_id"])
    texts = placed.groupBy("end", F.floor(F.col("row_no") / LIST_IDS).alias("part")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            out = []
            for end, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if end != key:
                    if key is not None:
                        out.append((key, digest.hexdigest()))
                    key, digest = end, hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([d for _, d in out], pa.string())], names=["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())], names=["key", "ends_sha256"])

    dealt = texts.repartition("end").sortWithinPartitions("end", "part").select("end", "ids")
    return dealt.mapInArrow(hashed, "key binary, ends_sha256 string")


def prefix_trie(lists: DataFrame, trie_nodes: int = TRIE_NODES) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, key) of every node.

    ``lists`` has one row for each conversation, as ``turn_lists`` gives them. A node is named by conv_id, its
    smallest member, and depth. ``saved_tokens`` is what members need not compute again: over the subtree,
    each node's last text once for each member but one.
    """
    paths = materialize(conversation_paths(lists), "paths")
    classes = materialize(paths.groupBy("end").agg(F.count("*").alias("members"), F.min("conv_id").alias("conv_id")), "classes")
    chosen = materialize(classes.join(paths.drop("end"), "conv_id").select("conv_id", "members", "keys", "sums"), "chosen")
    partial = chosen.select("conv_id", "members", "keys").mapInArrow(lambda batches: _gathered(batches, trie_nodes), _NODE_FIELDS)
    nodes = materialize(partial.groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id")), "nodes")

    children = materialize(nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children")), "children")
    # First depth a conversation owns: where it is the smallest member.
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("first_owned"))
    leaf = classes.select("end", "conv_id").join(children.select(F.col("key").alias("end")), "end", "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    added = chosen.join(owned, "conv_id", "left").join(leaf, "conv_id", "left")
    turns = F.size("keys") - 1
    spots = added.select(
        "members", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("first_owned", turns + F.lit(1)).alias("first_owned"),
        turns.alias("turns"), "keys", "sums")
    spots = spots.select("members", "leaf", "first_owned", "turns", "sums", F.posexplode("keys").alias("depth", "key"))
    # Size of the texts at depths from this one up to a depth; sums[d] covers depths 1 to d.
    upto = lambda depth: F.get("sums", depth.cast("int")) - F.get("sums", F.greatest(F.col("depth") - 1, F.lit(0)))
    shared_upto = F.least(F.col("first_owned") - 1, F.col("turns"))
    saved = (F.col("members") - 1) * upto(F.col("turns")) + F.when(shared_upto >= F.greatest("depth", F.lit(1)), upto(shared_upto)).otherwise(0)
    sums = spots.groupBy("key").agg(F.sum("leaf").alias("n_leaves"), F.sum(saved).alias("saved_tokens"))

    parents = materialize(nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parents")
    named = salted_join(nodes, parents, "parent", "left", spread=["key"])
    full = named.join(children, "key", "left").join(sums, "key").join(_ends(paths), "key", "left")
    none = hashlib.sha256(b"").hexdigest()
    return full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"), F.col("saved_tokens").cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"), "key")


def rebuilt(lists: DataFrame, block: int = 100, turns: int = 6) -> DataFrame:
    """Conversations whose first h turns come from the first conversation of their block of ids, then their own
    after their first h; h = crc32(conv_id) % ``turns``. A block serves at most 2 * ``block`` conversations."""
    h = (F.crc32(F.col("conv_id").cast("string")) % turns).cast("int")
    first = F.col("conv_id") - F.col("conv_id") % block
    givers = lists.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("first"), F.slice("turns", 1, turns - 1).alias("given"))
    met = lists.select("conv_id", "turns", h.alias("h"), first.alias("first")).join(givers, "first", "left")
    none = F.slice("turns", 1, 0)
    head = F.when(F.col("given").isNotNull(), F.slice("given", F.lit(1), F.col("h"))).otherwise(none)
    tail = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return met.select("conv_id", F.concat(head, tail).alias("turns"))
