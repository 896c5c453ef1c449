"""Periodic runs of words, found word by word along the diagonals of equal words.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) whose
length is ``max(LEAST_LENGTH, LEAST_PERIODS * q)`` or more and that no neighbouring word extends.

One text is read once, word by word. Comparing a text with itself, equal words at distance q lie on
diagonal q; a run of period q is a stretch of that diagonal. For each word, its earlier occurrences
say which diagonals go on: the match length of a diagonal that has one grows, any other diagonal
ends, and one that was long enough gives its run at once. Only diagonals under way are held.

Diagonals are entered sparsely. A run of period q keeps its diagonal for 3q words or more, so for
2^k <= q < 2^(k+1) at least three words with a number divisible by 2^k lie on it: diagonal q is
entered only at such words, and only if it also held 2^k and 2 * 2^k words before. So word i asks for
earlier occurrences nearer than twice the largest power of two that divides i: n log n lookups at
most for n words, also if all are the same. A diagonal is entered with its whole match length so far.

A multiple of the period of a run under way that reaches back to the compared word is not entered:
all of its stretch lies in that run, ends with it, and has the smaller period (two periods of a
stretch as long as both together have their greatest common divisor as a period). By the same
argument stretches with several qualifying periods share both ends; the smallest period counts.

Each text is one row and one step of one task, with memory of a few numbers a word. Defined results:
a null text, or one without words, has no words and no runs. A null doc_id plants no repetition
(``planted``). Repeated rows give repeated results. Columns of the input other than doc_id and text
are not returned. No rows give no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# A run has so many words, and so many periods, at least. Entering diagonals at every power of two
# relies on three periods of equal words, that is on LEAST_PERIODS >= 4.
LEAST_LENGTH, LEAST_PERIODS = 6, 4

_RESULT = T.StructType([
    T.StructField("n_runs", T.LongType(), False), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("period", T.LongType()), T.StructField("exponent_milli", T.LongType()),
    T.StructField("runs", T.ArrayType(T.ArrayType(T.LongType(), False), False), False),
    T.StructField("collapsed", T.StringType(), False)])


def words_of(text: str | None) -> list[bytes]:
    """Maximal stretches of anything but the ASCII blanks 0x20 and 0x09-0x0D."""
    return (text or "").encode().split()


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a text with the repetition that its doc_id calls for, if any."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


def find_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    n = len(words)
    numbers: dict = {}
    w = [numbers.setdefault(x, len(numbers)) for x in words]
    seen: list[list[int]] = [[] for _ in numbers]
    # Diagonals under way, smallest lag first: [lag, match length].
    active: list[list[int]] = []
    found: list[tuple[int, int, int]] = []

    def emit(lag: int, matched: int, end: int, starts: set[int]) -> None:
        start = end - matched - lag
        if matched + lag >= max(LEAST_LENGTH, LEAST_PERIODS * lag) and start not in starts:
            starts.add(start)
            found.append((start, matched + lag, lag))

    for i, word in enumerate(w):
        earlier = seen[word]
        if active:
            ended = None
            for diagonal in active:
                if w[i - diagonal[0]] == word:
                    diagonal[1] += 1
                elif ended is None:
                    ended = [diagonal]
                else:
                    ended.append(diagonal)
            if ended is not None:
                active = [d for d in active if d not in ended]
                starts: set[int] = set()
                for lag, matched in ended:
                    emit(lag, matched, i, starts)
        if earlier and i:
            reach = (i & -i) << 1
            # Nearest first, so that smaller lags are entered before their multiples.
            for at in range(len(earlier) - 1, -1, -1):
                j = earlier[at]
                lag = i - j
                if lag >= reach:
                    break
                step = 1 << (lag.bit_length() - 1)
                back = i - 2 * step
                if back < lag or w[back] != w[back - lag] or w[i - step] != w[i - step - lag]:
                    continue
                if any(lag == d or (lag % d == 0 and j >= i - m - d + 1) for d, m in active):
                    continue
                first = i
                while first > lag and w[first - 1] == w[first - 1 - lag]:
                    first -= 1
                active.append([lag, i - first + 1])
                active.sort()
        earlier.append(i)
    starts = set()
    for lag, matched in active:
        emit(lag, matched, n, starts)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside what runs repeat: of each run its first period stays, unless another run drops it."""
    if not runs:
        return words
    change = [0] * (len(words) + 1)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept, depth = [], 0
    for word, step in zip(words, change, strict=False):
        depth += step
        if not depth:
            kept.append(word)
    return kept


def _with_runs(docs: DataFrame, schema: T.StructType, plant: bool, columns) -> DataFrame:
    """One row for each text, with ``columns(words, runs)`` after doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_of(text.as_py())
                words = planted(doc_id, words) if plant else words
                out.append(columns(words, find_runs(words)))
            made = [pa.array(list(c), f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)] if out else [
                pa.array([], f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=schema.names)

    kinds = {"long": pa.int64(), "string": pa.string(), "array": pa.list_(pa.list_(pa.int64()))}
    arrow = [pa.field(f.name, kinds[f.dataType.typeName()]) for f in schema.fields[1:]]
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _longest(runs: list[tuple[int, int, int]]) -> tuple[int | None, ...]:
    """(start, length, period, thousandths of the exponent) of the longest run; the first of equal ones."""
    if not runs:
        return None, None, None, None
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]))
    return start, length, period, 1000 * length // period


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs, collapsed) of every row of ``docs``.

    ``runs`` lists (start, length, period) by start, then period; start to exponent_milli are those of the
    longest run. ``collapsed`` is the text without what runs repeat, its words joined by one blank.
    """
    schema = T.StructType([docs.schema["doc_id"], *_RESULT.fields])

    def columns(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
        return len(runs), *_longest(runs), [list(r) for r in runs], b" ".join(collapse(words, runs)).decode()

    return _with_runs(docs, schema, False, columns)


def run_digests(docs: DataFrame) -> DataFrame:
    """As ``periodic_runs`` over texts with planted repetitions, with SHA-256 digests in place of runs and text.

    Texts of this size would only leave the Python task to be hashed; the digests are made there.
    """
    digests = [T.StructField("runs_sha256", T.StringType(), False), T.StructField("collapsed_sha256", T.StringType(), False)]
    schema = T.StructType([docs.schema["doc_id"], *_RESULT.fields[:5], *digests])

    def columns(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        return (len(runs), *_longest(runs), hashlib.sha256(listed.encode()).hexdigest(),
                hashlib.sha256(b" ".join(collapse(words, runs))).hexdigest())

    return _with_runs(docs, schema, True, columns)
