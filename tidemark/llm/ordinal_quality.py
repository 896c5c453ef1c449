"""Quality by ordinal regression on graded ratings (cumulative link model).

One weight vector over hashed text features is shared by all grades; ordered thresholds cut its
score into grades: P(grade > k) = sigmoid(score - threshold_k). The model gives the expected grade
and the tail probability P(grade >= cut), by which documents are selected.

Features are present or absent: every different lower-case word, its first four, five and six
characters (related forms share them), and steps of four measures of style (share of capital
letters, of signs, of repeated words, of words equal to the one before). Names are hashed to
``2 ** BITS`` places.

Weights are fitted by follow-the-regularised-leader steps with an L1 term, which keeps rare noise
at zero, on a bounded sample of ratings (``max_rows``, those of smallest hash of key, a parameter). Only feature numbers of those rows come to the driver. Scoring covers every row and
reads whole texts; words' weights are kept in a bounded cache.

Defined results: a null or empty text has no features, so its grade follows from the thresholds
alone. Rows without a grade are not learned from. Without any rated row every document gets the
highest grade with certainty. Repeated rows are learned from and scored each. Extra columns are
kept; columns named like an output are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import fresh

BITS = 18
MAX_ROWS = 20_000
CACHE = 100_000
PREFIXES = (4, 5, 6)
STEPS = (0.02, 0.05, 0.1, 0.2, 0.4, 0.6)
CUT, LEAST_TAIL = 2, 0.3

_WORD = re.compile(r"[^\W_]+")
# Signs: printable ASCII but letters, digits, blanks, full stop and comma.
_SIGN = np.array([33 <= b < 127 and not chr(b).isalnum() and chr(b) not in ".," for b in range(256)])


def _place(name: str) -> int:
    return zlib.crc32(name.encode()) & ((1 << BITS) - 1)


def word_features(word: str) -> list[int]:
    return [_place("w" + word), *(_place("p" + word[:k]) for k in PREFIXES if len(word) > k)]


def style_features(text: str, words: list[str]) -> list[int]:
    raw = np.frombuffer(text.encode(), np.uint8)
    n, size = max(1, len(words)), max(1, len(raw))
    shares = (
        ("capital", np.count_nonzero((raw >= 65) & (raw <= 90)) / size),
        ("sign", np.count_nonzero(_SIGN[raw]) / size),
        ("repeat", 1 - len(set(words)) / n if words else 0.0),
        ("twice", sum(map(eq, words, words[1:])) / n),
    )
    return [_place(f"s{name}{k}") for name, share in shares for k, step in enumerate(STEPS) if share > step]


def features(text: str) -> np.ndarray:
    """Sorted feature numbers of a text."""
    words = _WORD.findall(text.lower())
    found = set(style_features(text, words))
    for word in set(words):
        found.update(word_features(word))
    return np.array(sorted(found), np.int32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... by column."""
        return _sigmoid(np.asarray(score)[:, None] - self.thresholds[None, :])


def fit_rows(
    rows: list[np.ndarray], grades: np.ndarray, n_grades: int, rounds: int = 5, rate: float = 0.2, l1: float = 2.0,
    l2: float = 1.0, lowest_weight: float = 2.0,
) -> Ordinal:
    """Maximum likelihood of the cumulative link model; errors on the lowest grade weigh more."""
    size = 1 << BITS
    lean, seen = np.zeros(size), np.zeros(size)
    cuts, cuts_seen = np.linspace(-3.0, -1.5, n_grades - 1), np.zeros(n_grades - 1)
    if not len(rows):
        return Ordinal(np.zeros(size, np.float32), np.full(n_grades - 1, -40.0))

    def weights(z, n):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((1 + np.sqrt(n)) / rate + l2))

    draw = np.random.default_rng(0)
    for _ in range(rounds):
        for i in draw.permutation(len(rows)):
            x, j = rows[i], grades[i]
            z, n = lean[x], seen[x]
            w = weights(z, n)
            score = w.sum()
            below = _sigmoid(cuts[j - 1] - score) if j > 0 else 0.0
            upto = _sigmoid(cuts[j] - score) if j < n_grades - 1 else 1.0
            pull = (1 - below - upto) * (lowest_weight if j == 0 else 1.0)
            lean[x] += pull - (np.sqrt(n + pull * pull) - np.sqrt(n)) / rate * w
            seen[x] += pull * pull
            p = max(upto - below, 1e-9)
            step = np.zeros(n_grades - 1)
            if j < n_grades - 1:
                step[j] -= upto * (1 - upto) / p
            if j > 0:
                step[j - 1] += below * (1 - below) / p
            cuts_seen += step * step
            cuts = np.maximum.accumulate(cuts - 0.1 * step / np.sqrt(cuts_seen + 1) + 0.0)
            cuts += np.arange(n_grades - 1) * 1e-9
    return Ordinal(weights(lean, seen).astype(np.float32), cuts)


def fit(
    docs: DataFrame, graded: DataFrame, n_grades: int, key: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS,
) -> Ordinal:
    """A model of the documents that ``graded`` (key, grade from 0 to ``n_grades`` - 1) rates."""
    usable = graded.where(F.col("grade").between(0, n_grades - 1) & F.col(key).isNotNull()).select(
        F.col(key).alias("rated_key"), F.col("grade").cast("int").alias("rated_grade"))
    # At most ``max_rows`` ratings, so they may go to every task; no text is shuffled.
    sample = F.broadcast(usable.orderBy(F.xxhash64("rated_key"), "rated_key", "rated_grade").limit(max_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int32())), batch.column(2)], names=["h", "places", "grade"])

    rated = docs.select(F.col(key).alias("own_key"), F.col(text).alias("text")).join(sample, F.col("own_key") == F.col("rated_key"))
    chosen = rated.select(F.xxhash64("rated_key").alias("h"), "text", "rated_grade")
    got = chosen.mapInArrow(run, "h long, places array<int>, grade int").toArrow()
    rows = [r.values.to_numpy(zero_copy_only=False) for r in got.column("places").combine_chunks()] if len(got) else []
    grades = got.column("grade").to_numpy()
    # The same order whatever the partitions were.
    rank = sorted(range(len(rows)), key=lambda i: (got.column("h")[i].as_py(), int(grades[i]), rows[i].tobytes()))[:max_rows]
    model = fit_rows([rows[i] for i in rank], grades[rank], n_grades)
    # The driver gives the ratings' memory back before the next stage.
    del got, rows
    pa.default_memory_pool().release_unused()
    return model


class _Weights(dict):
    """The features of a word whose weight is not zero."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE:
            self.clear()
        self[word] = found = tuple(k for k in word_features(word) if self.weights[k])
        return found


def score_texts(model: Ordinal, texts: list[str], known: _Weights | None = None) -> np.ndarray:
    known = _Weights(model.weights) if known is None else known
    scores = np.zeros(len(texts))
    for i, text in enumerate(texts):
        words = _WORD.findall(text.lower())
        found = set(style_features(text, words))
        found.update(*map(known.__getitem__, set(words)))
        if found:
            scores[i] = model.weights[sorted(found)].astype(np.float64).sum()
    return scores


def grade_documents(df: DataFrame, model: Ordinal, text: str = "text", cut: int = CUT) -> DataFrame:
    """``df`` with ``expected_grade`` and ``tail`` = P(grade >= ``cut``)."""
    outputs = ("expected_grade", "tail")
    kept = [c for c in df.columns if c.lower() not in outputs]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(n, T.DoubleType(), False) for n in outputs])
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        known = _Weights(m.weights)
        for batch in batches:
            tails = m.tails(score_texts(m, [t or "" for t in batch.column(len(kept)).to_pylist()], known))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(tails.sum(axis=1)), pa.array(tails[:, cut - 1])], names=[*kept, *outputs])

    return df.select(*kept, df[text].alias(fresh(df, "text_in"))).mapInArrow(run, schema)


def ratings(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from quality and toxicity labels: 0 toxic, 1 poor, 2 good."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade")).where(F.col("grade").isNotNull())
