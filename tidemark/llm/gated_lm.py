"""Gated recurrent language model: trained and applied on every document, whole.

Tokens are lower-case words (A-Z lowered, cut at blanks) and one end token for each document. The
``model_words`` most frequent training words and the end token are symbols of the network; every
other word is represented by a tail symbol that its spelling determines. The network is a gated
recurrent unit over embeddings. Its output is class-factored: symbols of similar frequency share a
class, each tail symbol is a class of its own, and P(symbol) = P(class | state) * P(symbol | class,
state). A word behind a tail symbol gets (c + 1) / (N + V + 1) on top, c its count, N and V the counts
and different words behind that symbol, in training texts.

Training is truncated backpropagation in numpy over windows of ``window`` tokens; the state goes on
from window to window until the document ends. Documents run side by side in lanes. Training is
spread by parameter averaging: in each of ``rounds`` rounds every task trains a copy on its own
documents of that round (each training document is in one round) and the copies are averaged,
weighted by their tokens, first in tasks and then over at most ``REDUCERS`` rows on the driver.

Counts cover all training texts and stay in a table that grows with them. Tasks are sent the
``frequent`` most frequent words only (a bound); the counts of all other words are joined to the
words of each document by a shuffle. Such words each hold less than one part in ``frequent`` of the
tokens, so no key of that join is hot.

Scores are log10 of a probability with the same rule for unseen words as the base score, which is
the add-one unigram model. Defined results: a null or empty text is the end token alone. Repeated
rows are counted and scored each. A null key is not trained on. Without training documents the
network is uniform over the end token and the tail symbols.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fresh, materialize

MODEL_WORDS, FREQUENT, TAILS, CLASSES = 1_024, 65_536, 32, 24
EMBEDDING, HIDDEN = 16, 16
LANES, WINDOW, ROUNDS, RATE = 384, 16, 3, 0.01
REDUCERS = 8
# Tokens of documents that run side by side, and words a counting task holds.
CHUNK_TOKENS, COUNT_WORDS = 1 << 21, 400_000
END = 0
LOG10 = float(np.log(10.0))


def words_of(text: str | None) -> list[bytes]:
    # bytes.lower and bytes.split know ASCII only: A-Z and the blanks 0x20, 0x09-0x0D.
    return (text or "").encode().lower().split()


def tail_of(word: bytes) -> int:
    """The tail symbol of a word, from how it begins and ends."""
    last, word = word[-1], (word if len(word) > 1 else word * 2)
    kind = 0 if last in b".," else 1 if 97 <= last <= 122 else 2 if last > 127 else 3
    return zlib.crc32(word[:2]) % (TAILS // 4) * 4 + kind


class _Tails(dict):
    """Tail symbols by a word's first two bytes and last byte, all that they depend on."""

    def __missing__(self, ends: bytes) -> int:
        self[ends] = k = tail_of(ends)
        return k


_tails = _Tails()


# ---------------------------------------------------------------- counts


def count_words(train: DataFrame, text: str = "text") -> DataFrame:
    """(word, c) over all training texts, without the end token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def emit() -> pa.RecordBatch:
            words = pa.array(list(counts), pa.binary()).cast(pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
            counts.clear()
            return out

        for batch in batches:
            for t in batch.column(0):
                counts.update(words_of(t.as_py()))
                if len(counts) > COUNT_WORDS:
                    yield emit()
        yield emit()

    return train.select(text).mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Numbers of the most frequent words, symbols of the network, and what tails stand for."""

    words: list[bytes]  # the frequent words, most frequent first; the first ``n_model`` are symbols
    counts: np.ndarray
    n_model: int
    n_tokens: int
    n_different: int
    n_documents: int
    tail_tokens: np.ndarray
    tail_words: np.ndarray

    def __post_init__(self):
        n, model = len(self.words), self.n_model
        tails = [1 + model + tail_of(w) for w in self.words[model:]]
        # By word number; tail symbols of other words follow.
        self.symbol = np.concatenate([np.arange(1, model + 1), tails, 1 + model + np.arange(TAILS)]).astype(np.int32)
        self.log_count = np.concatenate([np.log10(self.counts + 1.0), np.zeros(TAILS)])
        self.n_symbols = 1 + model + TAILS
        self.tail_log = np.log10(self.tail_tokens + self.tail_words + 1.0)
        self.frequent = n

    def numbers_of(self, words: list[bytes], index: dict[bytes, int]) -> np.ndarray:
        """Numbers of words; words that are not frequent get the number of their tail symbol."""
        k = np.fromiter(map(index.get, words, repeat(-1)), np.int32, len(words))
        rare = np.flatnonzero(k < 0)
        if len(rare):
            found = [words[i] for i in rare.tolist()]
            k[rare] = [_tails[w[:2] + w[-1:]] for w in found]
            k[rare] += self.frequent
        return k

    def symbol_counts(self) -> np.ndarray:
        return np.concatenate([[self.n_documents], self.counts[:self.n_model], self.tail_tokens]).astype(np.float64)


def least_count(counts: DataFrame, most: int) -> int:
    """The smallest count that at most ``most`` words reach; the driver gets a few numbers only.

    Powers of two first, then the counts between two of them in steps, so that no list of counts or words is sorted.
    """
    low, high = 1, 1 << 62
    while low < high:
        step = max(1, (high - low) // 64)
        part = F.length(F.bin("c")) - 1 if high == 1 << 62 else F.floor((F.col("c") - low) / step)
        inside = counts.where((F.col("c") >= low) & (F.col("c") < high)).groupBy(part.cast("long").alias("part")).agg(F.count("*").alias("n"))
        above = counts.where(F.col("c") >= high).count()
        bounds = {r["part"]: r["n"] for r in inside.collect()}
        start = (lambda p: 1 << p) if high == 1 << 62 else (lambda p: low + p * step)
        reached = None
        for p in sorted(bounds, reverse=True):
            if above + bounds[p] > most:
                reached = p
                break
            above += bounds[p]
        if reached is None:
            return low
        low, high = start(reached), min(high, start(reached + 1))
        if high - low == 1:
            return high
    return low


def vocabulary(counts: DataFrame, n_documents: int, model_words: int = MODEL_WORDS, frequent: int = FREQUENT) -> Vocabulary:
    """``counts`` must be a stored table. Frequent words are all words down to the smallest count at which no more than ``frequent`` are left."""
    least = least_count(counts, frequent)
    top = sorted(counts.where(F.col("c") >= least).collect(), key=lambda r: (-r["c"], r["word"]))
    words = [r["word"].encode() for r in top]
    model = min(model_words, len(words))
    symbols = set(words[:model])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, different = np.zeros(TAILS, np.int64), np.zeros(TAILS, np.int64)
        for batch in batches:
            for word, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = word.encode()
                if raw not in symbols:
                    k = tail_of(raw)
                    tokens[k] += c
                    different[k] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(TAILS, dtype=np.int32)), pa.array(tokens), pa.array(different)], names=["tail", "n", "v"])

    tails = counts.mapInArrow(run, "tail int, n long, v long").groupBy("tail").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    tokens, different = np.zeros(TAILS, np.int64), np.zeros(TAILS, np.int64)
    for r in tails:
        tokens[r["tail"]], different[r["tail"]] = r["n"], r["v"]
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    return Vocabulary(
        words, np.array([r["c"] for r in top], np.int64), model, total["n"] + n_documents, total["v"] + (n_documents > 0),
        n_documents, tokens, different)


# ---------------------------------------------------------------- network


@dataclass
class Layout:
    """Which class a symbol is in, and which columns of the output belong to a class.

    Columns hold the symbols of the frequency classes, class by class; tail symbols have no column.
    """

    class_of: np.ndarray
    column_of: np.ndarray
    starts: np.ndarray
    n_classes: int


def layout(counts: np.ndarray, tails: int = TAILS, classes: int = CLASSES) -> Layout:
    """Frequency classes of about equal sums of square roots of counts."""
    n = len(counts) - tails
    order = np.argsort(-counts[:n], kind="stable")
    mass = np.sqrt(counts[:n][order] + 1)
    group = np.minimum((np.cumsum(mass) - mass) / mass.sum() * classes, classes - 1).astype(np.int64)
    _, group = np.unique(group, return_inverse=True)
    k = int(group[-1]) + 1
    class_of, column_of = np.zeros(len(counts), np.int64), np.full(len(counts), -1, np.int64)
    class_of[order], column_of[order] = group, np.arange(n)
    class_of[n:] = k + np.arange(tails)
    return Layout(class_of, column_of, np.searchsorted(group, np.arange(k + 1)), k + tails)


NAMES = ("emb", "wx", "wh", "b", "wc", "bc", "ww", "bw")


def start_parameters(counts: np.ndarray, lay: Layout, embedding: int = EMBEDDING, hidden: int = HIDDEN) -> dict[str, np.ndarray]:
    """Small random weights; output biases give the unigram distribution of ``counts``."""
    draw = np.random.default_rng(0)
    small = lambda *shape: (draw.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
    smooth = counts + 0.5
    by_class = np.bincount(lay.class_of, smooth, lay.n_classes)
    columns = np.flatnonzero(lay.column_of >= 0)
    bw = np.zeros(len(columns), np.float32)
    bw[lay.column_of[columns]] = np.log(smooth[columns] / by_class[lay.class_of[columns]])
    return {
        "emb": draw.normal(size=(len(counts), embedding)).astype(np.float32) * np.float32(0.3),
        "wx": small(embedding, 3 * hidden), "wh": small(hidden, 3 * hidden), "b": np.zeros(3 * hidden, np.float32),
        "wc": small(hidden, lay.n_classes) * np.float32(0.1), "bc": np.log(by_class / by_class.sum()).astype(np.float32),
        "ww": small(hidden, len(columns)) * np.float32(0.1), "bw": bw}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Network:
    def __init__(self, p: dict[str, np.ndarray], lay: Layout):
        self.p, self.lay, self.hidden = p, lay, p["wh"].shape[0]

    def forward(self, given: np.ndarray, h: np.ndarray, start: np.ndarray, gates: np.ndarray | None = None, keep: bool = False):
        """States after each of the [steps, lanes] ``given`` symbols; ``start`` clears the state before a step."""
        p, n = self.p, self.hidden
        steps, lanes = given.shape
        pre = gates[given] if gates is not None else p["emb"][given] @ p["wx"] + p["b"]
        out = np.empty((steps, lanes, n), np.float32)
        saved, begins = [], start.any(axis=1)
        with np.errstate(over="ignore"):
            for t in range(steps):
                if begins[t]:
                    h = h * ~start[t][:, None]
                u = h @ p["wh"]
                zr = _sigmoid(pre[t, :, :2 * n] + u[:, :2 * n])
                z, r = zr[:, :n], zr[:, n:]
                c = np.tanh(pre[t, :, 2 * n:] + r * u[:, 2 * n:])
                before, h = h, c + z * (h - c)
                out[t] = h
                if keep:
                    saved.append((before, z, r, c, u[:, 2 * n:]))
        return out, h, saved

    def output(self, states: np.ndarray, wanted: np.ndarray, grad: dict[str, np.ndarray] | None = None):
        """Natural log probability of each wanted symbol; with ``grad``, also the states' gradients of its negative sum."""
        p, lay = self.p, self.lay
        cls = lay.class_of[wanted]
        rows = np.arange(len(wanted))
        logits = states @ p["wc"] + p["bc"]
        logits -= logits.max(axis=1, keepdims=True)
        picked = logits[rows, cls]
        np.exp(logits, out=logits)
        total = logits.sum(axis=1)
        logp = picked - np.log(total)
        back = None
        if grad is not None:
            logits /= total[:, None]
            logits[rows, cls] -= 1
            grad["wc"] += states.T @ logits
            grad["bc"] += logits.sum(axis=0)
            back = logits @ p["wc"].T
        order = np.argsort(cls, kind="stable")
        cuts = np.searchsorted(cls[order], np.arange(len(lay.starts)))
        for k in range(len(lay.starts) - 1):
            own = order[cuts[k]:cuts[k + 1]]
            a, b = lay.starts[k], lay.starts[k + 1]
            if not len(own) or b - a == 1:
                continue
            s, at, inside = states[own], lay.column_of[wanted[own]] - a, np.arange(len(own))
            l = s @ p["ww"][:, a:b] + p["bw"][a:b]
            l -= l.max(axis=1, keepdims=True)
            picked = l[inside, at]
            np.exp(l, out=l)
            total = l.sum(axis=1)
            logp[own] += picked - np.log(total)
            if grad is not None:
                l /= total[:, None]
                l[inside, at] -= 1
                grad["ww"][:, a:b] += s.T @ l
                grad["bw"][a:b] += l.sum(axis=0)
                back[own] += l @ p["ww"][:, a:b].T
        return logp, back

    def gradients(self, given: np.ndarray, wanted: np.ndarray, h: np.ndarray, start: np.ndarray):
        """(sum of log probabilities, gradients of its negative, state at the end) of one window."""
        p, n = self.p, self.hidden
        steps, lanes = given.shape
        states, last, saved = self.forward(given, h, start, keep=True)
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        logp, back = self.output(states.reshape(-1, n), wanted.reshape(-1), grad)
        back = back.reshape(steps, lanes, n)
        d_pre = np.empty((steps, lanes, 3 * n), np.float32)
        dh = np.zeros((lanes, n), np.float32)
        wh_t = p["wh"].T
        for t in range(steps - 1, -1, -1):
            before, z, r, c, u = saved[t]
            dh = dh + back[t]
            dc = dh * (1 - z) * (1 - c * c)
            d = d_pre[t]
            d[:, :n] = dh * (before - c) * z * (1 - z)
            d[:, n:2 * n] = dc * u * r * (1 - r)
            d[:, 2 * n:] = dc
            du = d.copy()
            du[:, 2 * n:] *= r
            grad["wh"] += before.T @ du
            dh = dh * z + du @ wh_t
            if start[t].any():
                dh *= ~start[t][:, None]
        flat, symbols = d_pre.reshape(-1, 3 * n), given.reshape(-1)
        inputs = p["emb"][symbols]
        grad["wx"] += inputs.T @ flat
        grad["b"] += flat.sum(axis=0)
        d_emb = flat @ p["wx"].T
        order = np.argsort(symbols, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(symbols[order]) > 0]))
        grad["emb"][symbols[order][first]] += np.add.reduceat(d_emb[order], first, axis=0)
        return float(logp.sum()), grad, last


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.rate, self.t = rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def step(self, p: dict[str, np.ndarray], grad: dict[str, np.ndarray], tokens: int) -> None:
        self.t += 1
        scale = 1 / max(1, tokens)
        norm = scale * float(np.sqrt(sum(float((g * g).sum()) for g in grad.values())))
        scale *= min(1.0, 1.0 / max(norm, 1e-9))
        rate = self.rate * np.sqrt(1 - 0.99 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in grad.items():
            g *= scale
            self.m[k] += (g - self.m[k]) * np.float32(0.1)
            self.v[k] += (g * g - self.v[k]) * np.float32(0.01)
            p[k] -= np.float32(rate) * self.m[k] / (np.sqrt(self.v[k]) + np.float32(1e-6))


@dataclass
class Lanes:
    """Documents side by side: [steps, lanes] of symbols given and wanted, longest lane first."""

    given: np.ndarray
    wanted: np.ndarray
    start: np.ndarray
    owner: np.ndarray  # the document of each step
    active: np.ndarray  # lanes with a token at each step


def lanes_of(documents: list[np.ndarray], most: int = LANES) -> Lanes:
    """``documents`` are symbols without the end. Long documents are dealt first, each to the shortest lane."""
    n = max(1, min(most, len(documents)))
    heap, dealt = [(0, k) for k in range(n)], [[] for _ in range(n)]
    for d in sorted(range(len(documents)), key=lambda k: -len(documents[k])):
        size, k = heap[0]
        dealt[k].append(d)
        heapq.heapreplace(heap, (size + len(documents[d]) + 1, k))
    sizes = [sum(len(documents[d]) + 1 for d in lane) for lane in dealt]
    by_size = sorted(range(n), key=lambda k: -sizes[k])
    steps = max(sizes, default=0)
    wanted, owner = np.zeros((n, steps), np.int32), np.zeros((n, steps), np.int32)
    given, start = np.zeros((n, steps), np.int32), np.zeros((n, steps), bool)
    for row, k in enumerate(by_size):
        at = 0
        for d in dealt[k]:
            x = documents[d]
            wanted[row, at:at + len(x)] = x
            wanted[row, at + len(x)] = END
            given[row, at] = END
            given[row, at + 1:at + 1 + len(x)] = x
            start[row, at] = True
            owner[row, at:at + len(x) + 1] = d
            at += len(x) + 1
    lengths = np.array([sizes[k] for k in by_size])
    active = (lengths[:, None] > np.arange(steps)[None, :]).sum(axis=0)
    return Lanes(*(np.ascontiguousarray(a.T) for a in (given, wanted, start, owner)), active)


def windows(lanes: Lanes, window: int) -> Iterator[tuple[int, int, int]]:
    """(first step, end, lanes) of windows in which the same lanes are active."""
    t, steps = 0, len(lanes.active)
    while t < steps:
        n = int(lanes.active[t])
        end = min(t + window, steps)
        end = t + int(np.searchsorted(-lanes.active[t:end], -n, "right"))
        yield t, end, n
        t = end


def train_documents(net: Network, adam: Adam, documents: list[np.ndarray], window: int = WINDOW, most: int = LANES) -> int:
    lanes = lanes_of(documents, most)
    h, done = np.zeros((lanes.given.shape[1], net.hidden), np.float32), 0
    for a, b, n in windows(lanes, window):
        _, grad, h = net.gradients(lanes.given[a:b, :n], lanes.wanted[a:b, :n], h[:n], lanes.start[a:b, :n])
        adam.step(net.p, grad, (b - a) * n)
        done += (b - a) * n
    return done


def score_documents(net: Network, documents: list[np.ndarray], window: int = 2 * WINDOW, most: int = LANES) -> np.ndarray:
    """Natural log probability of each document's symbols, the end included."""
    lanes, total = lanes_of(documents, most), np.zeros(len(documents))
    gates = net.p["emb"] @ net.p["wx"] + net.p["b"]
    h = np.zeros((lanes.given.shape[1], net.hidden), np.float32)
    for a, b, n in windows(lanes, window):
        states, h, _ = net.forward(lanes.given[a:b, :n], h[:n], lanes.start[a:b, :n], gates)
        logp, _ = net.output(states.reshape(-1, net.hidden), lanes.wanted[a:b, :n].reshape(-1))
        total += np.bincount(lanes.owner[a:b, :n].reshape(-1), logp.astype(np.float64), len(documents))
    return total


# ---------------------------------------------------------------- on Spark


def _pack(p: dict[str, np.ndarray]) -> bytes:
    return b"".join(p[k].astype(np.float32).tobytes() for k in NAMES)


def _unpack(raw: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in NAMES:
        out[k] = raw[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _documents(batch: pa.RecordBatch, column: int) -> list[np.ndarray]:
    lists = batch.column(column)
    flat, cuts = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def encode(docs: DataFrame, voc: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` without the text, as a stored table with one pass over the texts in it.

    Adds ``row_key``, ``symbols`` (without the end), ``n_tokens``, what is known without the shuffle of
    rare words (``n_known``, ``log_base``, ``log_tail``) and ``rare_words``, the words whose counts the
    tasks do not hold.
    """
    added = ("row_key", "symbols", "n_tokens", "n_known", "log_base", "log_tail", "rare_words")
    kept = [c for c in docs.columns if c.lower() not in (*added, text.lower())]
    told = docs.sparkSession.sparkContext.broadcast(voc)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = told.value
        index = {w: k for k, w in enumerate(v.words)}
        end_log, first_tail = np.log10(v.n_documents + 1.0), 1 + v.n_model
        for batch in batches:
            symbols, sizes, known, base, tail, rare = [], [], [], [], [], []
            for t in batch.column(len(kept)):
                words = words_of(t.as_py())
                k = v.numbers_of(words, index)
                x, logs, unheld = v.symbol[k], v.log_count[k], np.flatnonzero(k >= v.frequent)
                tails = x >= first_tail
                symbols.append(x)
                sizes.append(len(k) + 1)
                known.append(len(k) - len(unheld) + (v.n_documents > 0))
                base.append(logs.sum() + end_log)
                tail.append(logs[tails].sum() - v.tail_log[x[tails] - first_tail].sum())
                rare.append([words[i] for i in unheld])
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in symbols])]).astype(np.int32)
            flat = np.concatenate(symbols).astype(np.int32) if symbols else np.zeros(0, np.int32)
            rare_offsets = np.concatenate([[0], np.cumsum([len(r) for r in rare])]).astype(np.int32)
            rare_flat = pa.array([w for r in rare for w in r], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:len(kept)], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                pa.array(sizes, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(tail, pa.float64()),
                pa.ListArray.from_arrays(pa.array(rare_offsets), rare_flat)], names=[*kept, *added[1:]])

    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in kept)
    coded = docs.select(*kept, docs[text].alias(fresh(docs, "text_in"))).mapInArrow(
        run, fields + "symbols array<int>, n_tokens long, n_known long, log_base double, log_tail double, rare_words array<string>")
    return materialize(coded.withColumn("row_key", F.monotonically_increasing_id()), "coded")


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, weight = None, 0.0
    for batch in batches:
        for w, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            x = np.frombuffer(raw, np.float32).astype(np.float64) * w
            total, weight = (x if total is None else total + x), weight + w
    if weight:
        yield pa.RecordBatch.from_arrays(
            [pa.array([0], pa.int32()), pa.array([weight], pa.float64()), pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary())],
            names=["bucket", "weight", "parameters"])


def train(lessons: DataFrame, voc: Vocabulary, rounds: int = ROUNDS, rate: float = RATE) -> Network:
    """Parameter averaging over all rows of ``lessons`` (as ``encode`` stores them), each in one round."""
    sc = lessons.sparkSession.sparkContext
    counts = voc.symbol_counts()
    lay = layout(counts)
    p = start_parameters(counts, lay)
    schema = "bucket int, weight double, parameters binary"
    for r in range(rounds):
        now, step = sc.broadcast((p, lay)), rate / (1 + r)

        def run(batches: Iterator[pa.RecordBatch], now=now, step=step) -> Iterator[pa.RecordBatch]:
            given, lay_ = now.value
            net = Network({k: x.copy() for k, x in given.items()}, lay_)
            adam, done, held, size = Adam(net.p, step), 0, [], 0
            for batch in batches:
                for x in _documents(batch, 0):
                    held.append(x)
                    size += len(x) + 1
                    if size >= CHUNK_TOKENS:
                        done += train_documents(net, adam, held)
                        held, size = [], 0
            if held:
                done += train_documents(net, adam, held)
            if done:
                bucket = TaskContext.get().partitionId() % REDUCERS
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()), pa.array([float(done)]), pa.array([_pack(net.p)], pa.binary())],
                    names=["bucket", "weight", "parameters"])

        part = lessons.where(F.pmod(F.xxhash64("row_key"), F.lit(rounds)) == r).select("symbols")
        copies = part.mapInArrow(run, schema).repartition(REDUCERS, "bucket").mapInArrow(_average, schema).collect()
        if copies:
            w = np.array([c["weight"] for c in copies])
            x = np.stack([np.frombuffer(c["parameters"], np.float32) for c in copies])
            p = _unpack((x * (w / w.sum())[:, None]).sum(axis=0), p)
    return Network(p, lay)


def score(coded: DataFrame, net: Network, voc: Vocabulary, counts: DataFrame) -> DataFrame:
    """What ``encode`` stored, with n_known, base_score and score in place of its working columns.

    The counts of rare words are joined to the words, summed by row, and added to what the rows have.
    """
    outputs = ("n_tokens", "n_known", "base_score", "score")
    kept = [c for c in coded.columns if c not in ("row_key", "symbols", "log_base", "log_tail", "rare_words") and c.lower() not in outputs]
    told = coded.sparkSession.sparkContext.broadcast((net.p, net.lay))
    passed = [*kept, "row_key", "n_tokens", "n_known", "log_base", "log_tail"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(*told.value)
        held, documents, size = [], [], 0

        def finish() -> Iterator[pa.RecordBatch]:
            logp, at = score_documents(own, documents) / LOG10, 0
            for batch in held:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(passed)], pa.array(logp[at:at + len(batch)])], names=[*passed, "logp"])
                at += len(batch)

        for batch in batches:
            held.append(batch)
            documents.extend(_documents(batch, len(passed)))
            size += len(batch.column(len(passed)).values)
            if size >= CHUNK_TOKENS:
                yield from finish()
                held, documents, size = [], [], 0
        if held:
            yield from finish()

    fields = ", ".join(f"`{c}` {coded.schema[c].dataType.simpleString()}" for c in passed)
    scored = coded.select(*passed, "symbols").mapInArrow(run, fields + ", logp double")
    rare = coded.select("row_key", F.explode("rare_words").alias("word")).join(counts, "word").groupBy("row_key").agg(
        F.count("*").alias("rare_known"), F.sum(F.log10(F.col("c") + 1)).alias("rare_log"))
    unit, more = float(np.log10(voc.n_tokens + voc.n_different + 1.0)), F.coalesce("rare_log", F.lit(0.0))
    return scored.join(rare, "row_key", "left").select(
        *kept, "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (F.col("log_base") + more - F.col("n_tokens") * unit).alias("base_score"),
        (F.col("logp") + F.col("log_tail") + more).alias("score"))


def learn_and_score(docs: DataFrame, learn: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the rows where the boolean column ``learn`` holds and the key is not null; score all.

    Adds n_tokens, n_known, base_score, score and train_tokens.
    """
    lesson = F.col(learn) & F.col(key).isNotNull()
    lessons = docs.where(lesson)
    counts = materialize(count_words(lessons, text), "word-counts")
    voc = vocabulary(counts, lessons.count())
    coded = encode(docs, voc, text)
    net = train(coded.where(lesson), voc)
    return score(coded, net, voc, counts).withColumn("train_tokens", F.lit(voc.n_tokens).cast("long"))
