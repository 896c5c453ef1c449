"""Vocabulary and trial records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import lower_trim, study_url_from_id
from .cleaning import quoted

# Fixed value: shorter synonyms are ignored.
MIN_SYNONYM_LENGTH = 3


def split_synonyms(df: DataFrame, name: str, synonyms: str) -> DataFrame:
    """Canonical name and its list of synonyms from ``a|b|c`` text; a missing text stays null.

    The name itself and synonyms shorter than three characters are left out.
    """
    canonical = lower_trim(quoted(name))
    parts = F.transform(F.split(quoted(synonyms), r"\|"), lower_trim)
    kept = F.filter(
        parts, lambda s: (s != canonical) & (F.length(s) >= MIN_SYNONYM_LENGTH)
    )
    others = [quoted(c) for c in df.columns if c not in (name, synonyms)]
    return df.select(canonical.alias("name"), kept.alias("synonyms"), *others)


def drug_synonym_edges(vocab: DataFrame) -> DataFrame:
    """``(drug, synonym)`` pairs of a table ``(name, synonyms)``."""
    return vocab.select(F.col("name").alias("drug"), F.explode("synonyms").alias("synonym"))


def study_url_edges(studies: DataFrame) -> DataFrame:
    return studies.select("study_url", "trial_id")


def _or_blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def flatten_trials(pages: DataFrame) -> DataFrame:
    """One row per study of nested result pages; anything missing is ``''``."""
    study = F.col("study")
    ids, design = study["IdentificationModule"], study["DesignModule"]
    first_arm = F.get(study["ArmsInterventionsModule"]["ArmGroupList"]["ArmGroup"], F.lit(0))
    first_name = F.get(
        first_arm["ArmGroupInterventionList"]["ArmGroupInterventionName"], F.lit(0)
    )
    return pages.select(
        F.explode("FullStudiesResponse.FullStudies").alias("full")
    ).select(F.col("full.Study.ProtocolSection").alias("study")).select(
        ids["NCTId"].alias("trial_id"),
        study_url_from_id(ids["NCTId"]).alias("study_url"),
        _or_blank(first_name).alias("intervention"),
        _or_blank(design["StudyType"]).alias("study_type"),
        _or_blank(design["EnrollmentInfo"]["EnrollmentCount"]).alias("target_size"),
        _or_blank(F.coalesce(ids["OfficialTitle"], ids["BriefTitle"])).alias("public_title"),
    )


def page_ranges(counts: DataFrame, n_col: str, size: int = 100) -> DataFrame:
    """First and last result number of each page of ``n`` results, the last page included."""
    starts = F.when(
        F.col(n_col) >= 1,
        F.sequence(F.lit(1).cast("bigint"), F.col(n_col).cast("bigint"), F.lit(size).cast("bigint")),
    )
    return counts.select("*", F.explode(starts).alias("page_from")).withColumn(
        "page_to", F.col("page_from") + F.lit(size - 1)
    )
