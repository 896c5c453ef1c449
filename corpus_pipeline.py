"""From raw documents to token ids, in five stages over ``documents``.

quality classifier -> language identification -> one of each group of near copies -> benchmark
decontamination -> pieces. Every stage reads what the stage before kept, decides on it, and returns
the columns of ``documents``; the last one returns the ids. Filters keep rows whole and unchanged.

A document is rejected when its probability of a good grade is below ``LEAST_TAIL`` (stage 1), when
its language cannot be told or no language fits it at ``LEAST_SCORE`` (stage 2), when a document
with a smaller doc_id is in its group of near copies (stage 3), or when it holds a benchmark item
(stage 4). Null and empty texts have no language and leave in stage 2. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import context_trees, ordinal_quality, piece_offsets, simhash_trie, template_leaks
from tidemark.llm.shared import materialize, prepare, table

# Share of the posterior that the predicted language must have.
LEAST_SCORE = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = ordinal_quality.fit(docs, ordinal_quality.ratings(table(spark, sf_dir, "labels")), n_grades=3)
    graded = ordinal_quality.grade_documents(docs, model)
    return graded.where(F.col("tail") >= ordinal_quality.LEAST_TAIL).select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = context_trees.identify(docs, context_trees.learn(docs))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash_trie.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return template_leaks.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_tokens, ids_sha256, decoded_sha256), decoded from the ids again."""
    prepare(spark)
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = piece_offsets.encode(docs.select("doc_id", "lang", "source", "text"), model, decoded="decoded")
    return encoded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"), "ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("language", language), ("near_copies", near_copies), ("benchmark", benchmark), ("pieces", pieces),
]
# SQL cannot express the fit of the classifier; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
SQL: dict[str, str] = {}
