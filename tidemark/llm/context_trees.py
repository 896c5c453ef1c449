"""Language identification by prediction by partial matching over bytes.

For every language a byte context tree of variable order (0 to ``order``) is counted over all
training texts. A symbol's probability in a context is count / (n + q), where n is how often the
context was seen and q how many different bytes followed it; a byte not seen there escapes with
q / (n + q) to the next shorter context, and below order 0 all 256 bytes are alike. Contexts never
seen cost nothing to leave. The statistics are frozen before scoring, so a text's code length is
exact and does not depend on other texts. The language with the shortest code wins; ``score`` is
its share of the posterior over code lengths for each byte, between 0 and 1.

Texts are preceded by ``order`` zero bytes, so that their first bytes have a context too. The
training counts are made of (order + 1)-byte windows only; counts of shorter contexts are sums.

Size: counts cover all training text and nothing is left out of them. If there are at most
``max_windows`` different windows, the trees are built from as many rows a level and sent to the tasks
once. Otherwise the counts stay a table: the windows of the texts get their code lengths by joins, level
by level, and are summed for each text. Both ways give the same code lengths.

Scoring walks all texts of a batch at once: an array of nodes for the windows starting at each
byte, extended by one byte a step; no loop over bytes.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text
if there is nothing to learn from. Equal code lengths go to the first language in order. Extra
columns are kept; columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scale import salted_join
from .shared import fresh, materialize

# About 0.2 kB a window in each task; with more, scoring goes by joins.
ORDER, MAX_WINDOWS = 3, 600_000
# Texts are scored in pieces of about this many bytes, to bound the memory of a step.
CHUNK = 1 << 20


def _bytes_of(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts, each after ``order`` zero bytes, and where each begins."""
    pad = bytes(order)
    raw = [pad + t.encode() for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)])
    return np.frombuffer(b"".join(raw), np.uint8), starts


def _windows(data: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """Each window of order + 1 bytes that ends in a text byte, as one integer."""
    kind = np.uint32 if order <= 3 else np.uint64
    n = len(data) - order
    if n <= 0:
        return np.zeros(0, kind)
    codes = np.zeros(n, kind)
    for k in range(order + 1):
        codes = (codes << kind(8)) | data[k:k + n].astype(kind)
    # Windows that would reach into the next text's padding end in that padding.
    inside = np.ones(n, bool)
    for s in starts[1:-1]:
        inside[max(0, s - order):s] = False
    return codes[inside]


class _Counts:
    """Sorted window codes with counts, merged batch by batch."""

    def __init__(self):
        self.codes, self.n, self.waiting, self.size = None, None, [], 0

    def add(self, codes: np.ndarray) -> None:
        if len(codes):
            self.waiting.append(np.unique(codes, return_counts=True))
            self.size += len(self.waiting[-1][0])
            if self.size > 1_000_000:
                self.merge()

    def merge(self) -> None:
        parts = self.waiting + ([(self.codes, self.n)] if self.codes is not None else [])
        if not parts:
            return
        codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        self.n = np.bincount(where, np.concatenate([p[1] for p in parts]).astype(np.float64)).astype(np.int64)
        self.codes, self.waiting, self.size = codes, [], 0


def _batched(column: pa.Array, most: int) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) in runs of about ``most`` bytes; one long text is a run of its own."""
    run, first, size = [], 0, 0
    for k, text in enumerate(column):
        word = text.as_py() or ""
        if run and size + len(word) > most:
            yield first, run
            run, first, size = [], k, 0
        run.append(word)
        size += len(word)
    if run:
        yield first, run


def count_windows(train: DataFrame, order: int = ORDER, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, code, n): how often each window occurs in the texts of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, _Counts] = {}
        names = ["lang", "code", "n"]

        def emit() -> Iterator[pa.RecordBatch]:
            for name, c in counts.items():
                c.merge()
                if c.codes is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(c.codes), pa.string()), pa.array(c.codes.astype(np.int64)), pa.array(c.n)],
                        names=names)
            counts.clear()

        for batch in batches:
            langs = batch.column(1).dictionary_encode()
            for k, name in enumerate(langs.dictionary.to_pylist()):
                own = batch.column(0).filter(pc.equal(langs.indices, k))
                for _, texts in _batched(own, CHUNK):
                    data, starts = _bytes_of(texts, order)
                    counts.setdefault(name, _Counts()).add(_windows(data, starts, order))
            # Many languages or very varied texts: hand on what was counted instead of holding it.
            if sum(c.size + (0 if c.codes is None else len(c.codes)) for c in counts.values()) > 4_000_000:
                yield from emit()
        yield from emit()

    rows = train.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, lang)
    counted = rows.mapInArrow(run, "lang string, code long, n long")
    return counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))


@dataclass
class Trees:
    """Frozen statistics. A node of level k is a known window of k bytes; node 0 of every level means
    unknown, node 1 of level 0 is the empty window.

    ``children[k]``: from 256 * node of level k - 1 + byte to the node of level k.
    ``bits[k]``: code length of a node's last byte after the bytes before it, per language.
    ``escape[k]``: the price to leave a node as a context, per language; none for node 0.
    """

    langs: list[str]
    order: int
    children: list[np.ndarray]
    bits: list[np.ndarray]
    escape: list[np.ndarray]

    def nodes(self, data: np.ndarray) -> list[np.ndarray]:
        """For each level the node of the window starting at each byte, as far as it fits."""
        found = [np.ones(len(data), np.int32)]
        for k in range(1, len(self.children)):
            n = max(0, len(data) - k + 1)
            found.append(self.children[k][found[-1][:n] * 256 + data[k - 1:k - 1 + n]])
        return found

    def cost(self, nodes: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
        """Code length, per language, of each byte at ``ends``, by the longest context the levels have."""
        m = len(nodes) - 1
        total = np.zeros((len(ends), len(self.langs)), np.float32)
        rows = None
        for k in range(m, 0, -1):
            begin = ends - (k - 1)
            node = nodes[k][begin]
            if rows is None:
                total += self.bits[k][node]
            else:
                total[rows] += self.bits[k][node]
            missing = np.flatnonzero(node == 0)
            if not len(missing):
                return total
            ends = ends[missing]
            rows = missing if rows is None else rows[missing]
            total[rows] += self.escape[k - 1][nodes[k - 1][begin[missing]]]
        total[rows if rows is not None else slice(None)] += 8.0
        return total


def grow(langs: list[str], tables: list[tuple[np.ndarray, np.ndarray]]) -> Trees:
    """Trees from (sorted codes, counts by language) of the windows of 1, 2, ... bytes."""
    width = len(langs)
    trees = Trees(langs, len(tables) - 1, [np.zeros(0, np.int32)], [np.zeros((2, width), np.float32)], [])
    parents = np.zeros(1, np.int64)  # codes of the nodes of the level before
    for k, (codes, counts) in enumerate(tables, start=1):
        at = np.searchsorted(parents, codes >> 8)
        at[at == len(parents)] = 0
        fits = parents[at] == codes >> 8 if len(parents) else np.zeros(len(codes), bool)
        codes, counts, parent = codes[fits], counts[fits], at[fits] + 1
        n, q = np.zeros((len(parents) + 1, width)), np.zeros((len(parents) + 1, width))
        np.add.at(n, parent, counts)
        np.add.at(q, parent, counts > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            leave = np.where(n > 0, -np.log2(q / (n + q)), 0.0)
            own = -np.log2(counts / (n + q)[parent])
        trees.escape.append(leave.astype(np.float32))
        # A byte that one language never saw here costs what its shorter contexts say.
        tail = np.stack([codes >> (8 * j) & 255 for j in range(k - 2, -1, -1)], axis=1) if k > 1 else None
        if tail is None or not len(codes):
            lower = np.full((len(codes), width), 8.0)
        else:
            flat = trees.nodes(tail.reshape(-1))
            lower = trees.cost(flat, np.arange(len(codes)) * (k - 1) + k - 2)
        own = np.where(counts > 0, own, leave[parent] + lower)
        child = np.zeros((len(parents) + 1) * 256, np.int32)
        child[parent * 256 + (codes & 255)] = np.arange(1, len(codes) + 1)
        trees.children.append(child)
        trees.bits.append(np.vstack([np.zeros((1, width)), own]).astype(np.float32))
        parents = codes
    return trees


@dataclass
class Tables:
    """Frozen statistics that are too many for a task: ``counts`` is the stored table (lang, code, n)."""

    langs: list[str]
    order: int
    counts: DataFrame


def _last(code: Column, k: int) -> Column:
    """The last ``k`` bytes of a window."""
    return code.bitwiseAND(F.lit((1 << (8 * k)) - 1)) if k < 8 else code


def freeze(counts: DataFrame, order: int = ORDER, max_windows: int = MAX_WINDOWS) -> Trees | Tables:
    """The trees of all languages if there are at most ``max_windows`` different windows, else the tables."""
    counts = materialize(counts, "windows")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if counts.select("code").distinct().count() > max_windows:
        return Tables(langs, order, counts)
    tables = []
    for k in range(1, order + 2):
        level = counts.select("lang", _last(F.col("code"), k).alias("code"), "n")
        by_lang = [F.coalesce(F.sum(F.when(F.col("lang") == name, F.col("n"))), F.lit(0)).alias(f"n{j}") for j, name in enumerate(langs)]
        # Not more rows than there are different windows.
        found = level.groupBy("code").agg(F.count("*").alias("rows"), *by_lang).toArrow()
        codes = found.column("code").to_numpy()
        order_of = np.argsort(codes, kind="stable")
        table = np.stack([found.column(f"n{j}").to_numpy().astype(np.float64) for j in range(len(langs))], axis=1) if langs else np.zeros((0, 0))
        tables.append((codes[order_of], table[order_of]))
    # A context need not have been seen as a window itself (padding never ends one): it gets no counts.
    for k in range(order, 0, -1):
        codes, table = tables[k - 1]
        more = np.setdiff1d(tables[k][0] >> 8, codes)
        both, order_of = np.concatenate([codes, more]), np.argsort(np.concatenate([codes, more]), kind="stable")
        tables[k - 1] = both[order_of], np.vstack([table, np.zeros((len(more), len(langs)))])[order_of]
    return grow(langs, tables)


def learn(train: DataFrame, order: int = ORDER, max_windows: int = MAX_WINDOWS, text: str = "text", lang: str = "lang") -> Trees | Tables:
    return freeze(count_windows(train, order, text, lang), order, max_windows)


def window_costs(tables: Tables, codes: DataFrame) -> DataFrame:
    """(code, costs) of the different windows ``codes``: the code length of the last byte after the others, by language.

    Level by level, from windows of one byte: counts, sums of the context, and the cost without the first byte
    meet by equal joins of tables that have one row for each window and language.
    """
    lower = None
    for k in range(1, tables.order + 2):
        cut = lambda c: _last(F.col(c), k)  # noqa: B023, E731 - used in this turn only
        level = materialize(tables.counts.groupBy("lang", cut("code").alias("code")).agg(F.sum("n").alias("n")), "level")
        contexts = level.groupBy("lang", F.shiftright("code", 8).alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("different"))
        asked = codes.select(cut("code").alias("code")).distinct().select(
            "code", F.explode(F.array(*map(F.lit, tables.langs))).alias("lang"), F.shiftright("code", 8).alias("context"),
            _last(F.col("code"), k - 1).alias("shorter"))
        met = asked.join(level, ["lang", "code"], "left").join(contexts, ["lang", "context"], "left")
        met = met.withColumn("lower", F.lit(8.0)) if lower is None else met.join(lower, ["lang", "shorter"])
        own = -F.log2(F.col("n") / (F.col("total") + F.col("different")))
        leave = F.coalesce(-F.log2(F.col("different") / (F.col("total") + F.col("different"))), F.lit(0.0))
        cost = materialize(met.select("lang", "code", F.coalesce(own, leave + F.col("lower")).alias("cost")), "costs")
        lower = cost.select("lang", F.col("code").alias("shorter"), F.col("cost").alias("lower"))
    by_lang = [F.sum(F.when(F.col("lang") == name, F.col("cost"))) for name in tables.langs]
    return cost.groupBy("code").agg(F.array(*by_lang).alias("costs"))


def _identify_by_join(df: DataFrame, tables: Tables, shown: Column) -> DataFrame:
    """(text_key, lang_pred, score, bits_per_byte) of the different texts ``shown``, by joins alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data, starts = _bytes_of([text.as_py()], tables_order)
                codes, n = np.unique(_windows(data, starts, tables_order), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(n.astype(np.int64))], names=["text_key", "code", "n"])

    tables_order = tables.order
    texts = df.select(text_key(shown).alias("text_key"), shown.alias("text")).where(F.length("text") > 0)
    rows = texts.mapInArrow(run, "text_key string, code long, n long")
    # Copies of a text give the same rows; one of each is kept.
    found = materialize(rows.groupBy("text_key", "code").agg(F.first("n").alias("n")), "text-windows")
    costs = materialize(window_costs(tables, found.select("code")), "window-costs")
    met = salted_join(found, costs, "code", spread=["text_key"])
    bits = [F.sum(F.col("n") * F.col("costs")[k]) for k in range(len(tables.langs))]
    rates = met.groupBy("text_key").agg(F.array(*bits).alias("bits"), F.sum("n").alias("bytes")).select(
        "text_key", F.transform("bits", lambda b: b / F.col("bytes")).alias("rates"))
    best = F.array_min("rates")
    return rates.select(
        "text_key", F.get(F.array(*map(F.lit, tables.langs)), (F.array_position("rates", best) - 1).cast("int")).alias("lang_pred"),
        (1 / F.aggregate("rates", F.lit(0.0), lambda s, r: s + F.pow(F.lit(2.0), 8 * (best - r)))).alias("score"),
        best.alias("bits_per_byte"))


def text_key(text: Column) -> Column:
    """A name for a text: two checksums and the length."""
    return F.concat_ws("-", F.xxhash64(text).cast("string"), F.crc32(text).cast("string"), F.octet_length(text).cast("string"))


def code_lengths(trees: Trees, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each text under each language, and the number of bytes of each."""
    data, starts = _bytes_of(texts, trees.order)
    is_text = np.ones(len(data), bool)
    for s in starts[:-1]:
        is_text[s:s + trees.order] = False
    ends = np.flatnonzero(is_text)
    cost = trees.cost(trees.nodes(data), ends)
    sizes = np.diff(starts) - trees.order
    bits = np.zeros((len(texts), len(trees.langs)))
    full = np.flatnonzero(sizes)
    if len(full):
        cuts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        bits[full] = np.add.reduceat(cost.astype(np.float64), cuts[full], axis=0)
    return bits, sizes


def identify(df: DataFrame, trees: Trees | Tables, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` and ``bits_per_byte`` (of the language predicted)."""
    outputs = ("lang_pred", "score", "bits_per_byte")
    kept = [c for c in df.columns if c.lower() not in outputs]
    # Texts without a letter are not looked at.
    shown = F.when(df[text].rlike(r"\p{L}"), df[text])
    if isinstance(trees, Tables):
        key = fresh(df, "text_key")
        told = _identify_by_join(df, trees, shown).withColumnRenamed("text_key", key)
        asked = df.select(*kept, F.coalesce(text_key(shown), F.lit("none")).alias(key))
        return salted_join(asked, materialize(told, "told"), key, "left", spread=kept[:1]).select(
            *kept, F.coalesce("lang_pred", F.lit("und")).alias("lang_pred"), F.coalesce("score", F.lit(0.0)).alias("score"), "bits_per_byte")
    schema = T.StructType([df.schema[c] for c in kept] + [
        T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False),
        T.StructField("bits_per_byte", T.DoubleType())])
    model = df.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = model.value
        for batch in batches:
            langs, scores, rates = ["und"] * len(batch), [0.0] * len(batch), [None] * len(batch)
            for first, texts in _batched(batch.column(len(kept)), CHUNK) if t.langs else ():
                bits, sizes = code_lengths(t, texts)
                for k in np.flatnonzero(sizes):
                    rate = bits[k] / sizes[k]
                    best = int(np.argmin(bits[k]))
                    langs[first + k], rates[first + k] = t.langs[best], float(rate[best])
                    scores[first + k] = float(1 / np.exp2(8 * (rate[best] - rate)).sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(rates, pa.float64())], names=[*kept, *outputs])

    return df.select(*kept, shown.alias(fresh(df, "text_in"))).mapInArrow(run, schema)
