"""The operators of this folder as queries over the given tables, with reference SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from . import chat_layout, context_trees, cover_tree, curve_shards, gated_lm, oracle, ordinal_quality, piece_offsets, prefix_trie, simhash_trie, template_leaks, token_frames, url_alias, word_runs
from .shared import materialize, prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    """Register ``fn`` under its name, with the package's session settings applied."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


URL_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)


N_SHARDS = 24


@query
def op2_url_aliases(spark, sf_dir):
    judged = url_alias.judge_urls(table(spark, sf_dir, "pages"), url_alias.rules_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op4_chat_layouts(spark, sf_dir):
    probe = spark.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
        "conv_id long, turn long, role string, text string")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    turns = chat_layout.canonical_turns(given, F.to_variant_object(F.struct("role", "text", "turn")))
    rows = turns.select("conv_id", "turn", F.explode("turns").alias("t")).select("conv_id", "turn", "t.role", "t.text")
    read = chat_layout.read_conversations(chat_layout.format_conversations(rows))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@query
def op10_template_leaks(spark, sf_dir):
    found = template_leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(
        F.max("n_windows").alias("n_windows"), F.max("n_consistent").alias("n_consistent"))


@query
def op6_piece_offsets(spark, sf_dir):
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_offsets.encode(docs, model, decoded="decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        # Spans follow each other, so the last end is the number of bytes they cover.
        F.element_at("ends", -1).cast("long").alias("covered_bytes"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@query
def op9_token_frames(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = work_dir(spark, "token-files")
    index = token_frames.write_documents(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_frames.read_documents(index, ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def _held_out(modulus: int, remainder: int):
    """Whether crc32 of doc_id as text leaves the remainder; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


@query
def op3_context_trees(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", _held_out(3, 1))
    trees = context_trees.learn(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    found = context_trees.identify(docs.select("doc_id", "held_out", "text"), trees)
    return found.select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


@query
def op8_ordinal_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = ordinal_quality.fit(docs, ordinal_quality.ratings(labels), n_grades=3)
    graded = ordinal_quality.grade_documents(docs.select("doc_id", "text"), model)
    return graded.select(
        "doc_id", "expected_grade", "tail", (F.col("tail") >= ordinal_quality.LEAST_TAIL).alias("selected"))


@query
def op5_simhash_trie(spark, sf_dir):
    groups = simhash_trie.group_near_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_cover_tree(spark, sf_dir):
    return cover_tree.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op1_gated_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", _held_out(7, 2))
    scored = gated_lm.learn_and_score(docs.withColumn("lesson", ~F.col("held_out")), "lesson")
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_hilbert_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return curve_shards.shard_documents(docs, N_SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "place")


@query
def op12_word_runs(spark, sf_dir):
    return word_runs.run_digests(table(spark, sf_dir, "documents"))


@query
def op13_fast_trie(spark, sf_dir):
    lists = materialize(prefix_trie.turn_lists(table(spark, sf_dir, "conversations")), "turn-lists")
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(lists)).drop("key")


SQL["op2_url_aliases"] = oracle.url_sql(URL_RULES)
SQL["op4_chat_layouts"] = oracle.chat_sql()
SQL["op7_cover_tree"] = oracle.near_vectors_sql(cover_tree.COSINE)
SQL["op10_template_leaks"] = oracle.leaks_sql(template_leaks.WINDOW, template_leaks.MIN_WINDOWS)
SQL["op11_hilbert_shards"] = oracle.shards_sql(N_SHARDS)
SQL["op13_fast_trie"] = oracle.prefix_trie_sql()
