"""Near-duplicates by SimHash fingerprints, linked by a binary trie self-join.

A fingerprint has a bit for each of the 64 bits of the shingles' hashes: set if it is set in over
half of them. Documents whose fingerprints differ in at most ``budget`` bits are linked; linked
documents form components, named by their smallest doc_id.

Equal fingerprints become one row first, so groups of copies of any size cost one fingerprint.
The different fingerprints are joined with themselves by walking pairs of nodes of a binary trie
together, from the root down: the differing bits so far are counted and a pair of nodes is dropped
as soon as they exceed the budget. To deal the walk out to tasks, the 64 bits are cut into
``budget + 2`` blocks; two fingerprints within the budget agree on at least two whole blocks, so
one trie is walked for every choice of two blocks, starting at the nodes where those two are equal.
Each start node (trie, bits of the two blocks) is one group of rows; groups of more than
``GROUP_ROWS`` rows are split into shards and every pair of shards is walked, so no task gets an
unbounded group and no pair is lost.

A walk returns links that connect what it found connected (a spanning star for each task and
group), not all pairs: at most one row for each fingerprint and trie. Pairs of nodes whose
fingerprints are already connected are not walked further, which keeps dense groups of near copies
cheap and changes no component.

``keep_one`` decides by the exact similarity of shingle sets. The trie walk over the prints of the sets comes
first: what it links is compared by the sets, and the pairs that are similar are links. At a Jaccard
similarity of 0.8 the prints differ in about 10 bits, too many for a walk without comparing all pairs; so what
is not connected by then is found by a prefix-filter join. All sets are put in one order of shingles, rare ones first. Two sets of similarity t share a shingle among
their first n - ceil(t n) + 1, and sets that share one may still be too different in size, or have too
few shingles after it, or too few in common among the first: only the other pairs are compared, by the
sets themselves. No pair is lost,
whatever the order is; a good order keeps passages that many texts share out of the prefixes. The order
comes from frequencies added up in bins, so it takes one pass and a table of fixed size.

Defined results: a null text, or one without words, has fingerprint zero and is linked like any
other. Repeated rows are rows of the same component. A null doc_id is never the smallest; a
component of null ids only has a null id. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scale import salted_join
from .shared import collect_garbage, components, forget, fresh, materialize

SHINGLE, BUDGET, SEED = 4, 4, 42
# For one document of each group: words of a shingle, and similarity.
KEEP_SHINGLE, KEEP_JACCARD = 5, 0.8
# Bins of shingles whose frequencies order them, and comparisons of single pairs before all others.
SKETCH_BITS, ROUNDS = 18, 2
PART_PAIRS = 200
# Tables of shingles or nodes up to this size are broadcast, larger ones are joined by a shuffle: they grow with the texts, and the driver holds them.
BROADCAST_BYTES = 8 << 20
GROUP_ROWS = 20_000
# Pairs of nodes with at most so many pairs of fingerprints are compared outright.
LEAF, STEP = 64, 1 << 21


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of the words of a text, A-Z lower-cased; 0 if it has none."""
    from xxhash import xxh64_intdigest

    # bytes.lower and bytes.split know ASCII only: A-Z and the blanks 0x20, 0x09-0x0D.
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, SEED)
    ends = list(accumulate(map(len, words), lambda a, b: a + 1 + b))
    starts = [0, *(e + 1 for e in ends)]
    return _majority([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:], strict=False)])


def word_print(text: str) -> int:
    """SimHash of the different words of a text, A-Z lower-cased; 0 if it has none."""
    from xxhash import xxh64_intdigest

    words = set(text.encode().lower().split())
    return _majority([xxh64_intdigest(w, SEED) for w in words]) if words else 0


def _majority(values: Sequence[int] | np.ndarray) -> int:
    """The bits that are set in over half of the values."""
    hashes, total = np.array(values, "<u8"), np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, text: str = "text", shingle: int = SHINGLE, words: bool = False) -> DataFrame:
    """``df`` without the text, with ``print`` (over shingles, or over words) and ``check`` (over shingles), signed longs."""
    outputs = ("print", "check")
    kept = [c for c in df.columns if c.lower() not in (*outputs, text.lower())]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(n, T.LongType(), False) for n in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(len(kept))]
            check = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            found = np.array([word_print(t) for t in texts], np.uint64).view(np.int64) if words else check
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(found), pa.array(check)], names=[*kept, *outputs])

    return df.select(*kept, df[text].alias(fresh(df, "text_in"))).mapInArrow(run, schema)


def blocks_of(budget: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of budget + 2 blocks of nearly equal width."""
    n = budget + 2
    cuts = [64 * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


class Walk:
    """Trie self-join of the groups of one chunk of rows sorted by (group, fingerprint).

    ``side`` tells the two shards of a split group apart: -1 all pairs of the group count, 0 and 1
    only pairs of unlike sides.
    """

    def __init__(
        self, prints: np.ndarray, checks: np.ndarray, group: np.ndarray, side: np.ndarray, budget: int, check_budget: int,
    ):
        self.prints, self.checks, self.side = prints, checks, side
        self.budget, self.check_budget = budget, check_budget
        self.label = np.arange(len(prints))
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        self.bounds = np.append(first, len(prints))

    def _settle(self, u: np.ndarray, v: np.ndarray) -> None:
        """Make the labels of linked rows equal (to the smallest)."""
        label = self.label
        while True:
            a, b = label[u], label[v]
            differ = a != b
            if not differ.any():
                return
            u, v, a, b = u[differ], v[differ], a[differ], b[differ]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                jumped = label[label]
                if (jumped == label).all():
                    break
                label[:] = jumped

    def _open(self, pairs: np.ndarray) -> np.ndarray:
        """Pairs of nodes that hold rows not yet connected."""
        change = np.concatenate([[0], np.cumsum(self.label[1:] != self.label[:-1])])
        a, b, c, d = pairs[:, 0], pairs[:, 1], pairs[:, 2], pairs[:, 3]
        joined = (change[b - 1] == change[a]) & (change[d - 1] == change[c]) & (self.label[a] == self.label[c])
        return pairs[~joined]

    def _compare(self, pairs: np.ndarray) -> None:
        """All fingerprints of one node with all of the other."""
        sizes = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        total = np.cumsum(sizes)
        at = 0
        while at < len(pairs):
            upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + STEP, "right")))
            part, n = pairs[at:upto], sizes[at:upto]
            row = np.repeat(np.arange(len(part)), n)
            k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            width = (part[:, 3] - part[:, 2])[row]
            u, v = part[row, 0] + k // width, part[row, 2] + k % width
            near = np.bitwise_count(self.prints[u] ^ self.prints[v]) <= self.budget
            if self.check_budget < 64:
                near[near] = np.bitwise_count(self.checks[u[near]] ^ self.checks[v[near]]) <= self.check_budget
            near &= (u != v) & ((self.side[u] < 0) | (self.side[u] != self.side[v]))
            self._settle(u[near], v[near])
            at = upto

    def run(self) -> np.ndarray:
        """The label of every row: the first row it is connected with."""
        lo, hi = self.bounds[:-1], self.bounds[1:]
        start = np.stack([lo, hi, lo, hi, np.zeros(len(lo), np.int64)], axis=1)[hi - lo > 1]
        stack = [(63, start)]
        while stack:
            bit, pairs = stack.pop()
            pairs = self._open(pairs) if len(pairs) else pairs
            if not len(pairs):
                continue
            small = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2]) <= LEAF
            if bit < 0:
                small[:] = True
            self._compare(pairs[small])
            pairs = pairs[~small]
            if len(pairs) > STEP // 8:
                stack.extend((bit, pairs[k:k + STEP // 8]) for k in range(0, len(pairs), STEP // 8))
                continue
            if not len(pairs):
                continue
            # Ones before each row at this bit: inside a node zeros come first.
            ones = np.concatenate([[0], np.cumsum((self.prints >> np.uint64(bit)) & np.uint64(1))]).astype(np.int64)
            a, b, c, d, e = pairs.T
            m, n = b - (ones[b] - ones[a]), d - (ones[d] - ones[c])
            mirror = a == c
            children = [
                np.stack([a, m, c, n, e], axis=1), np.stack([m, b, n, d, e], axis=1), np.stack([a, m, n, d, e + 1], axis=1),
                # A node paired with itself meets its other half once only.
                np.stack([m, b, c, n, e + 1], axis=1)[~mirror]]
            following = np.concatenate(children)
            following = following[(following[:, 0] < following[:, 1]) & (following[:, 2] < following[:, 3])
                                  & (following[:, 4] <= self.budget)]
            stack.append((bit - 1, following))
        return self.label


def _walked(batches: Iterator[pa.RecordBatch], budget: int, check_budget: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of whole groups; rows come sorted by group (the first four columns)."""
    held: list[np.ndarray] = []
    size = 0

    def walk(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        prints = rows[:, 4].copy().view(np.uint64)
        change = (rows[1:, :4] != rows[:-1, :4]).any(axis=1)
        group = np.concatenate([[0], np.cumsum(change)])
        order = np.lexsort((prints, group))
        checks, node = rows[order, 5].copy().view(np.uint64), rows[order, 6]
        label = Walk(prints[order], checks, group[order], rows[order, 7], budget, check_budget).run()
        linked = np.flatnonzero(label != np.arange(len(label)))
        yield pa.RecordBatch.from_arrays([pa.array(node[linked]), pa.array(node[label[linked]])], names=["a", "b"])

    for batch in batches:
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
        if not len(rows):
            continue
        held.append(rows)
        size += len(rows)
        if size < 200_000:
            continue
        rows = np.concatenate(held)
        same = (rows[:, :4] == rows[-1, :4]).all(axis=1)
        cut = len(rows) - int(same.sum())  # the last group may go on
        if cut:
            yield from walk(rows[:cut])
        held, size = [rows[cut:]], len(rows) - cut
    if size:
        yield from walk(np.concatenate(held))


def link_fingerprints(
    prints: DataFrame, budget: int = BUDGET, check_budget: int = 64, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Links (a, b) between ``prints.node`` that connect what is within the budgets of ``print`` and ``check``."""
    blocks = blocks_of(budget)
    keys = []
    for k, chosen in enumerate(combinations(range(len(blocks)), 2)):
        mask = sum(((1 << blocks[c][1]) - 1) << blocks[c][0] for c in chosen)
        mask -= (1 << 64) if mask >= 1 << 63 else 0
        keys.append(F.struct(F.lit(k).alias("trie"), F.col("print").bitwiseAND(F.lit(mask)).alias("start")))
    row = ("print", "check", "node")
    started = prints.select(*row, F.explode(F.array(*keys)).alias("k")).select("k.trie", "k.start", *row)
    # Start nodes of many fingerprints are walked shard by shard.
    large = materialize(
        started.groupBy("trie", "start").agg(F.count("*").alias("n")).where(F.col("n") > group_rows)
        .select("trie", "start", F.ceil(F.col("n") / group_rows).cast("int").alias("shards")), "large-groups")
    rows = started.join(large, ["trie", "start"], "left")
    own = F.pmod(F.xxhash64("node"), F.col("shards")).cast("int")
    whole = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(-1).alias("side")))
    sharded = F.transform(F.sequence(F.lit(0), F.col("shards") - 1), lambda k: F.struct(
        F.least(k, own).alias("i"), F.greatest(k, own).alias("j"), F.when(k == own, -1).when(own < k, 0).otherwise(1).alias("side")))
    dealt = rows.select(
        "trie", "start", *row, F.explode(F.when(F.col("shards").isNull(), whole).otherwise(sharded)).alias("p"))
    group = ("trie", "start", "i", "j")
    return (
        dealt.select("trie", "start", "p.i", "p.j", *row, "p.side")
        .repartition(*group).sortWithinPartitions(*group)
        .mapInArrow(lambda batches: _walked(batches, budget, check_budget), "a long, b long")
    )


def group_near_copies(
    docs: DataFrame, text: str = "text", shingle: int = SHINGLE, budget: int = BUDGET, words: bool = False, check_budget: int = 64,
) -> DataFrame:
    """(doc_id, print, component_id) for every row of ``docs``."""
    marked = materialize(fingerprints(docs.select("doc_id", F.col(text).alias("text")), "text", shingle, words), "fingerprints")
    different = materialize(
        marked.groupBy("print", "check").agg(F.min("doc_id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id()), "different")
    linked = components(link_fingerprints(different, budget, check_budget), "a", "b").withColumnRenamed("node", "member")
    placed = materialize(
        different.join(linked, F.col("node") == F.col("member"), "left")
        .select("print", "check", "least", F.coalesce("component", "node").alias("component")), "placed")
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = materialize(placed.join(names, "component").select("print", "check", "component_id"), "named")
    return marked.join(by_print, ["print", "check"]).select("doc_id", "print", "component_id")


def shingle_set(text: str, shingle: int = KEEP_SHINGLE) -> np.ndarray:
    """Sorted hashes of the different runs of ``shingle`` words, A-Z lower-cased; of all words if there are fewer."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter((xxh64_intdigest(x, SEED) for x in words), np.uint64, len(words))
    n, out = max(1, len(w) - shingle + 1), np.zeros(max(1, len(w) - shingle + 1), np.uint64)
    for k in range(min(shingle, len(w))):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + w[k:k + n]
    return np.unique((out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93))


def _node(shingles: np.ndarray) -> int:
    """One number for a set of shingles, as a signed long."""
    from xxhash import xxh64_intdigest

    return int(np.uint64(xxh64_intdigest(shingles.tobytes(), SEED)).view(np.int64))


def frequencies(docs: DataFrame, shingle: int) -> np.ndarray:
    """How many rows hold a shingle, added up over ``2 ** SKETCH_BITS`` bins of shingles; all rows are counted.

    Each task adds its rows up, slices of the bins are added across tasks, and the driver gets one number for each bin.
    """
    bins, part = 1 << SKETCH_BITS, 1 << 12

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(bins, np.int64)
        for batch in batches:
            for t in batch.column(0):
                found = shingle_set(t.as_py() or "", shingle)
                np.add.at(total, (found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(bins // part), pa.int32()), pa.array([x.tobytes() for x in total.reshape(-1, part)], pa.binary())], names=["slice", "counts"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["slice", "counts"])

    schema = "slice int, counts binary"
    slices = docs.select("text").mapInArrow(counted, schema).repartition("slice").mapInArrow(added, schema).collect()
    out = np.zeros(bins, np.int64)
    for r in slices:
        out[r["slice"] * part:(r["slice"] + 1) * part] += np.frombuffer(r["counts"], np.int64)
    return out


def prefix_length(size: int, jaccard: float) -> int:
    """So many of the first shingles of a set, in any order all sets share, hold one that any similar set has among its own first."""
    return size - _least_common(size, jaccard) + 1


def _least_common(size: int, jaccard: float) -> int:
    """Smallest whole number of shingles that is ``jaccard`` of ``size`` or more."""
    return int(np.ceil(size * jaccard - 1e-9))


def prefixes(docs: DataFrame, shingle: int, jaccard: float, counts: np.ndarray) -> DataFrame:
    """(doc_id, text_key, node, size, tokens, print) of every row; rows of the same shingles have the same node.

    ``tokens`` are the first shingles of the set, those of the rarest bins first, then by number; ``print`` is
    the SimHash of the set, zero if it is empty.
    """
    schema = T.StructType([docs.schema["doc_id"], T.StructField("text_key", T.LongType()), T.StructField("node", T.LongType()),
                           T.StructField("size", T.IntegerType()), T.StructField("tokens", T.ArrayType(T.LongType())), T.StructField("print", T.LongType())])
    weights = docs.sparkSession.sparkContext.broadcast(counts)

    def first(x: np.ndarray) -> np.ndarray:
        if not len(x):
            return x.view(np.int64)
        order = np.argsort(weights.value[(x >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
        return x[order[:prefix_length(len(x), jaccard)]].view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py() or "", shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:2], pa.array([_node(x) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int32()),
                pa.array([first(x) for x in sets], pa.list_(pa.int64())),
                pa.array(np.array([_majority(x) for x in sets], np.uint64).view(np.int64))], names=schema.names)

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py() or "", shingle) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([
                pa.array([_node(x) for x in sets], pa.int64()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))],
                names=["node", "shingles"])

    return docs.select("text").mapInArrow(run, "node long, shingles array<long>")


def _with_set(rows: DataFrame, pairs: DataFrame, sets: DataFrame, key: str, other: str, name: str) -> DataFrame:
    """``rows`` of ``pairs`` with the set of ``key``; a node of many pairs is dealt out in parts of about ``PART_PAIRS``."""
    n = F.coalesce("parts", F.lit(1))
    parts = materialize(pairs.groupBy(key).agg(F.ceil(F.count("*") / PART_PAIRS).cast("int").alias("parts")).where("parts > 1"), "parts")
    left = rows.join(parts, key, "left").select(*rows.columns, F.pmod(F.xxhash64(other), n).cast("int").alias("part"))
    right = sets.select(F.col("node").alias(key), F.col("shingles").alias(name)).join(parts, key, "left").select(
        key, name, F.explode(F.sequence(F.lit(0), n - 1)).alias("part"))
    return left.join(right, [key, "part"]).drop("part")


def _exact(pairs: DataFrame, sets: DataFrame, jaccard: float) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of ``jaccard`` or more."""
    both = _with_set(_with_set(pairs, pairs, sets, "a", "b", "x"), pairs, sets, "b", "a", "y")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common / (F.size("x") + F.size("y") - common) >= jaccard).select("a", "b")


def _need(size: Column, other_size: Column, jaccard: float) -> Column:
    """How many shingles sets of these sizes must share."""
    return F.ceil((size + other_size) * F.lit(jaccard / (1 + jaccard)) - 1e-9)


def _may_be_similar(size: Column, place: Column, other_size: Column, other_place: Column, jaccard: float) -> Column:
    """Whether sets that share a shingle at these places of their order can be similar: what follows it must hold enough more."""
    return (F.least(size, other_size) >= F.greatest(size, other_size) * F.lit(jaccard) - 1e-9) & (
        F.least(size - place, other_size - other_place) >= _need(size, other_size, jaccard))


def shared_places(nodes: DataFrame, jaccard: float) -> DataFrame:
    """(token, node, size, place) of the first shingles that nodes share and that may link them.

    ``nodes`` has (node, size, tokens). Of a token's nodes those stay that could be similar to a set of the
    smallest size among them: in a large family most members have too many shingles of their own before the first shared one.
    """
    places = nodes.select(F.posexplode("tokens").alias("place", "token"), "node", "size")
    shared = materialize(places.groupBy("token").agg(F.count("*").alias("_n"), F.min("size").alias("least")).where("_n > 1"), "shared")
    collect_garbage(nodes.sparkSession)
    other = F.greatest(F.col("least"), F.ceil(F.col("size") * F.lit(jaccard) - 1e-9))
    fits = _by_token(places, shared.drop("_n"), "inner", shared).where(F.col("size") - F.col("place") >= _need(F.col("size"), other, jaccard))
    found = materialize(fits.select("token", "node", "size", "place"), "places")
    forget(shared)
    return found


def _by_token(rows: DataFrame, keyed: DataFrame, how: str, counts: DataFrame) -> DataFrame:
    """``salted_join`` by token; ``counts`` has the number of a token's rows in ``_n``."""
    return salted_join(rows, keyed, "token", how, ["node"], BROADCAST_BYTES, counts.select("token", "_n"))


def _open(rows: DataFrame, linked: DataFrame | None) -> DataFrame:
    """``rows`` with the component of each node, of tokens whose nodes are in more than one."""
    own = rows.select("token", "node", "size", "place")
    if linked is None:
        placed = own.withColumn("component", F.col("node"))
    else:
        placed = own.join(linked, F.col("node") == F.col("member"), "left").select(*own.columns, F.coalesce("component", "node").alias("component"))
    several = materialize(placed.groupBy("token").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("_n")).where("lo <> hi").select("token", "_n"), "several")
    found = materialize(_by_token(placed, several.select("token"), "left_semi", several), "open")
    forget(several)
    return found


def _likely(pairs: DataFrame, nodes: DataFrame, jaccard: float) -> DataFrame:
    """The pairs (a, b) whose first shingles have enough in common.

    A set of n has at most n - need shingles that the other lacks, so of its first p at least p - (n - need)
    are common; the first common ones, as many as both sides hold, are among the first of both.
    """
    both = _with_set(_with_set(pairs, pairs, nodes, "a", "b", "x"), pairs, nodes, "b", "a", "y")
    need = _need(F.col("a_size"), F.col("b_size"), jaccard)
    least = F.least(F.size("x") - (F.col("a_size") - need), F.size("y") - (F.col("b_size") - need))
    return both.where(F.size(F.array_intersect("x", "y")) >= F.greatest(least, F.lit(1))).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return materialize(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "ends")


def walked_pairs(nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], jaccard: float, budget: int = BUDGET) -> DataFrame:
    """The pairs (a, b) that the trie walk over the prints of ``nodes`` links and whose sets are similar."""
    walked = link_fingerprints(nodes.select("print", F.col("print").alias("check"), "node"), budget)
    pairs = materialize(walked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "walked")
    ends = _ends(pairs)
    sets = materialize(sets_of(ends), "sets")
    found = materialize(_exact(pairs, sets, jaccard), "links")
    forget(sets, pairs, ends)
    collect_garbage(nodes.sparkSession)
    return found


def link_sets(
    rows: DataFrame, nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], jaccard: float, rounds: int = ROUNDS,
    known: DataFrame | None = None,
) -> DataFrame:
    """(member, component) of all nodes linked by exact Jaccard >= ``jaccard``.

    ``rows`` are those of ``shared_places``, ``nodes`` has (node, shingles) with the first shingles only,
    ``sets_of`` gives (node, shingles) with all of them for a table of nodes, and ``known`` are links (a, b)
    found before. In each round a node is compared with one other, the first by a random order among those it
    shares a token with; groups of near copies so become components for one pair a node. Then all pairs that
    share a token at places that allow it and are still in different components are compared, so that no link
    between components is lost.
    """
    named = [F.col(c).alias(f"l_{c}") for c in ("node", "size", "place", "component")]
    fits = _may_be_similar(F.col("size"), F.col("place"), F.col("l_size"), F.col("l_place"), jaccard) & (F.col("component") != F.col("l_component"))
    edges, linked, left = None, None, rows
    if known is not None and not known.isEmpty():
        edges, linked = known, materialize(components(known, "a", "b").withColumnRenamed("node", "member"), "linked")
    for k in range(rounds + 1):
        left = _open(left, linked)
        if k < rounds:
            turn = F.xxhash64("node", F.lit(k))
            lead = materialize(left.groupBy("token").agg(
                F.min_by(F.struct("node", "size", "place", "component"), F.struct(turn, "node")).alias("l"), F.count("*").alias("_n")).select(
                "token", "_n", *[F.col(f"l.{c}").alias(f"l_{c}") for c in ("node", "size", "place", "component")]), "lead")
            met = _by_token(left, lead.drop("_n"), "inner", lead).where(fits)
            met = met.groupBy("node", "size").agg(
                F.min_by(F.struct("l_node", "l_size"), F.struct(F.xxhash64("l_node", F.lit(k)), "l_node")).alias("l")).select(
                "node", "size", "l.l_node", "l.l_size")
        else:
            # Everything outside a token's largest component meets all others.
            largest = materialize(left.groupBy("token", "component").agg(F.count("*").alias("n")).groupBy("token").agg(
                F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("_n")), "largest")
            rest = _by_token(left, largest.drop("_n"), "inner", largest).where("component <> main").select("token", *named)
            met = left.join(materialize(rest, "rest"), "token").where(fits)
        one, other = F.struct(F.col("node").alias("n"), F.col("size").alias("s")), F.struct(F.col("l_node").alias("n"), F.col("l_size").alias("s"))
        pairs = materialize(met.select(F.least(one, other).alias("x"), F.greatest(one, other).alias("y")).select(
            F.col("x.n").alias("a"), F.col("y.n").alias("b"), F.col("x.s").alias("a_size"), F.col("y.s").alias("b_size")).distinct(), "pairs")
        # Only the first shingles of the nodes of these pairs travel to them.
        pairs = materialize(_likely(pairs, salted_join(nodes, _ends(pairs), "node", "left_semi", broadcast_bytes=BROADCAST_BYTES), jaccard), "likely")
        sets = materialize(sets_of(_ends(pairs)), "sets")
        found = materialize(_exact(pairs, sets, jaccard), "links")
        forget(sets, pairs)
        collect_garbage(nodes.sparkSession)
        if edges is not None and found.isEmpty():
            continue
        edges = found if edges is None else materialize(edges.unionByName(found).distinct(), "edges")
        linked = materialize(components(edges, "a", "b").withColumnRenamed("node", "member"), "linked")
    return linked


def _placed(docs: DataFrame, shingle: int, jaccard: float) -> DataFrame:
    """(doc_id, text_key, component) for every row of ``docs``; text_key is the hash of the text."""
    made = materialize(prefixes(docs, shingle, jaccard, frequencies(docs, shingle)), "prefixes")
    nodes = materialize(made.groupBy("node").agg(F.first("size").alias("size"), F.first("tokens").alias("tokens"), F.first("print").alias("print")), "nodes")
    # The shingles stay with the nodes alone.
    whole, made = made, materialize(made.select("doc_id", "text_key", "node"), "keys")
    forget(whole)
    collect_garbage(docs.sparkSession)
    rows = shared_places(nodes, jaccard)

    def sets_of(ends: DataFrame) -> DataFrame:
        """The sets of some nodes, from one text of each."""
        source = materialize(made.join(ends, "node", "left_semi").groupBy("node").agg(
            F.min(F.struct("doc_id", "text_key")).alias("r")).select(F.col("r.doc_id").alias("of_id"), F.col("r.text_key").alias("of_key")), "source")
        same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.xxhash64("text") == F.col("of_key"))
        texts = docs.select("doc_id", "text").join(source, same, "left_semi")
        return shingle_sets(texts.dropDuplicates(["doc_id", "text"]), shingle)

    known = walked_pairs(nodes, sets_of, jaccard)
    linked = link_sets(rows, nodes.select("node", F.col("tokens").alias("shingles")), sets_of, jaccard, known=known)
    return made.join(linked, F.col("node") == F.col("member"), "left").select(
        "doc_id", "text_key", F.coalesce("component", "node").alias("component"))


def keep_one(docs: DataFrame, shingle: int = KEEP_SHINGLE, jaccard: float = KEEP_JACCARD) -> DataFrame:
    """``docs`` with one row of each component, columns as they were.

    Texts are linked if the Jaccard similarity of their sets of ``shingle`` words is ``jaccard`` or
    more, computed from the sets: first the pairs the trie walk proposes, then those of the prefix-filter join. Every
    such pair is found, or its ends are connected by others.

    Rows are told apart by doc_id and text, so a repeated or null doc_id says nothing about other
    texts. The row of the smallest doc_id stays (null last), then that of the smallest text key;
    of rows equal in both, one.
    """
    placed = materialize(_placed(docs, shingle, jaccard), "groups")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    of_id, of_key = fresh(docs, "stay_id"), fresh(docs, "stay_key")
    stay = placed.groupBy("component").agg(F.min(row).alias("r"), F.count("*").alias("n")).select(
        F.col("r.doc_id").alias(of_id), F.col("r.text_key").alias(of_key), "n")
    same = F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.xxhash64("text") == F.col(of_key))
    alone = docs.join(stay.where("n = 1").drop("n"), same, "left_semi")
    several = docs.join(stay.where("n > 1").drop("n"), same, "left_semi")
    key = fresh(docs, "text_key")
    return alone.unionByName(several.withColumn(key, F.xxhash64("text")).dropDuplicates(["doc_id", key]).drop(key))
