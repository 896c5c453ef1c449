"""Vocabulary and trials to a graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import last_wins_map, union_by_name_fill
from ..operators.linking import word_boundary_link
from ..operators.scale import lookup_join
from ..operators.trials import drug_synonym_edges, flatten_trials, split_synonyms, study_url_edges
from ..session import materialize


def all_studies(trials: DataFrame, intl: DataFrame | None, order_col: str = "trial_id") -> DataFrame:
    """National trials first, then the international list; one row per trial id, blanks filled.

    ``intl`` has normalized headers.
    """
    flat = flatten_trials(trials)
    if intl is None:
        intl = flat.where(F.lit(False))
    return union_by_name_fill(flat, intl, "trial_id", order_col)


def build_drug_graph(
    vocab: DataFrame, trials: DataFrame, intl: DataFrame | None = None,
    order_col: str = "row_no", name: str = "Common name", synonyms: str = "Synonyms",
) -> tuple[DataFrame, DataFrame]:
    """Nodes ``(label, name)`` and edges ``(rel, src_label, src, dst_label, dst)``.

    A term that is both a drug and a synonym is linked from both nodes. For repeated drug names
    the last vocabulary row, by ``order_col``, counts.
    """
    words = last_wins_map(
        split_synonyms(vocab.select(name, synonyms, order_col), name, synonyms), "name", order_col
    ).drop(order_col)
    # Every branch below reads both tables again; flattening them once is cheaper.
    studies = materialize(all_studies(trials, intl), "studies")
    words = materialize(words, "vocabulary")

    known_as = drug_synonym_edges(words)
    drugs = words.select(F.lit("Drug").alias("label"), "name")
    synonym_nodes = known_as.select(F.lit("Synonym").alias("label"), F.col("synonym").alias("name"))
    study_nodes = studies.select(F.lit("Study").alias("label"), F.col("trial_id").alias("name"))
    url_nodes = studies.select(F.lit("Url").alias("label"), F.col("study_url").alias("name"))
    nodes = drugs.unionAll(synonym_nodes).unionAll(study_nodes).unionAll(url_nodes).distinct()

    def edge(df: DataFrame, rel: str, src_label, src: str, dst_label: str, dst: str) -> DataFrame:
        return df.select(
            F.lit(rel).alias("rel"), src_label.alias("src_label"), F.col(src).alias("src"),
            F.lit(dst_label).alias("dst_label"), F.col(dst).alias("dst"),
        )

    # Each link carries the label of its term, so the label travels with the look-up table.
    labelled = materialize(drugs.unionAll(synonym_nodes).distinct().groupBy("name").agg(
        F.array_sort(F.collect_set("label")).alias("labels")
    ), "labelled")
    links = word_boundary_link(labelled, studies, "name", "trial_id", "intervention")
    typed = lookup_join(links, labelled, "name", spread=["trial_id"]).select(
        F.explode("labels").alias("term_label"), "name", "trial_id"
    )
    edges = (
        edge(known_as, "KNOWN_AS", F.lit("Drug"), "drug", "Synonym", "synonym")
        .unionAll(edge(typed, "APPEARED_IN", F.col("term_label"), "name", "Study", "trial_id"))
        .unionAll(edge(study_url_edges(studies), "POINTS_AT", F.lit("Url"), "study_url", "Study", "trial_id"))
        .distinct()
    )
    return nodes, edges
