"""Whole-word links between a term list and free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import NON_WORD_CHAR, WORD_CHAR
from ..session import materialize
from .scale import lookup_join

_RUN = rf"{WORD_CHAR}+|{NON_WORD_CHAR}+"
# Windows of up to so many runs are put together run by run, longer ones from a slice.
UNROLLED = 8


def _runs(c: Column) -> Column:
    """The text cut at every change between word and non-word characters."""
    return F.regexp_extract_all(c, F.lit(_RUN), F.lit(0))


def _inner_runs(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Runs of each text from its first to its last word: words at even places, what stands between at odd ones.

    No whole-word match touches blanks and punctuation at either end, because a boundary needs a word
    character on one side.
    """
    runs, edge = F.col("_all"), f"^{NON_WORD_CHAR}"
    first = F.when(F.get(runs, F.lit(0)).rlike(edge), 1).otherwise(0)
    last = F.when(F.try_element_at(runs, F.lit(-1)).rlike(edge), 1).otherwise(0)
    inner = F.slice(runs, first + 1, F.greatest(F.size(runs) - first - last, F.lit(0)))
    return texts.select(key, _runs(F.lower(F.col(text))).alias("_all")).select(key, inner.alias("_runs"))


def _windows(runs: Column, n: int, first: int) -> Column:
    """The text of all ``n`` neighbouring runs that begin at every second place from ``first``."""
    if n <= UNROLLED:
        joined = lambda i: F.concat(*[F.get(runs, i + k) for k in range(n)])
    else:
        joined = lambda i: F.array_join(F.slice(runs, i + 1, F.lit(n)), "")
    last = F.size(runs) - F.lit(n)
    places = F.sequence(F.lit(first), last, F.lit(2))
    return F.when(last >= first, F.transform(places, joined)).otherwise(F.array().cast("array<string>"))


def _dealt(texts: DataFrame) -> DataFrame:
    """Texts that lie in fewer files than there are cores are dealt to all of them first."""
    cores = texts.sparkSession.sparkContext.defaultParallelism
    return texts.repartition(cores) if len(texts.inputFiles()) < cores else texts


def word_boundary_link(
    terms: DataFrame, texts: DataFrame, term: str, key: str, text: str
) -> DataFrame:
    """Distinct ``(term, key)`` where the lower-cased term occurs between word boundaries.

    A whole-word match means that the term's runs of word and non-word characters appear next to each
    other among the runs of the text. So a term of n runs is equal to a window of n runs: for every
    length that occurs among the terms, a text gives its windows of that length, beginning with a word
    or not as the terms do, and all of them meet the terms in one equi-join on the term itself. Each
    text is read once, nothing is compared pairwise or looked up again, and the join decides exactly,
    for terms of any length. ``key`` identifies a text.
    """
    t = materialize(
        terms.select(F.lower(F.col(term)).alias(term)).where(F.length(term) > 0).distinct(), "terms")
    # One row for each length of a term, with words or punctuation first.
    shape = t.select(
        F.size(_runs(F.col(term))).alias("n"), F.col(term).rlike(f"^{WORD_CHAR}").alias("word")
    ).distinct().collect()
    if not shape:
        return t.select(term).join(texts.select(key).where(F.lit(False)), F.lit(False))
    texts = _dealt(texts.select(key, text))
    if {(r.n, r.word) for r in shape} == {(1, True)}:
        # Single words: the gaps between the words of a text are of no use.
        pieces = texts.select(key, F.explode(F.array_distinct(F.split(F.lower(F.col(text)), f"{NON_WORD_CHAR}+"))).alias(term))
    else:
        runs = F.col("_runs")
        windows = [_windows(runs, r.n, 0 if r.word else 1) for r in sorted(shape)]
        # Windows of different lengths or beginnings are different texts.
        every = F.concat(*[F.array_distinct(w) for w in windows])
        pieces = _inner_runs(texts, key, text).select(key, F.explode(every).alias(term))
    return lookup_join(pieces, t, term, spread=[key]).select(term, key)
