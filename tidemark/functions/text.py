"""Text columns: mentions, links, hashtags, names."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word character in the sense of a Unicode-aware ``\w``; written out because the meaning of
# ``\w`` and ``\b`` differs between regex engines.
WORD_CHAR = r"[\p{L}\p{N}_]"
NON_WORD_CHAR = r"[^\p{L}\p{N}_]"

MENTION_PATTERN = r"@[\p{L}\p{N}_]+"

# Top-level domains that make a bare host name count as a link: the public list in ``tlds.txt``.
# Country codes need no list: every last label of two letters counts.
GENERIC_TLDS = tuple(
    t for t in (Path(__file__).parent / "tlds.txt").read_text(encoding="utf-8").splitlines() if t and not t.startswith("#"))
_TAIL = r"[^\s<>\"'()\[\]{}]"
_ASCII_URL_PATTERN = (
    rf"(?i)(?:https?://|www\.){_TAIL}+"
    rf"|(?:[a-z0-9._%+-]+@)?(?:[a-z0-9-]+\.)+(?:xn--[a-z0-9-]+|[a-z]{{2,}})(?:[/?#:]{_TAIL}*)?"
)
URL_PATTERN = (
    _ASCII_URL_PATTERN
    # Last labels outside ASCII.
    + rf"|(?:[\p{{L}}\p{{N}}._%+-]+@)?(?:[\p{{L}}\p{{M}}\p{{N}}-]+\.)+(?:(?![\x00-\x7f])[\p{{L}}\p{{M}}]){{2,}}(?:[/?#:]{_TAIL}*)?"
)

URL_BREAKS = r"[\s<>\"'()\[\]{}]+"
URL_TRAILING = r"[.,;:!?]+$"

_BLANKS = " \t\n\r\f\x0b"


def _accept(u: Column, tlds: Sequence[str]) -> Column:
    """Links with a scheme or ``www.``, and hosts whose last label is a country code or listed."""
    label = F.lower(F.regexp_extract(u, r"^(?:[\p{L}\p{M}\p{N}-]+\.)+([\p{L}\p{M}\p{N}-]+)(?:[/?#:]|$)", 1))
    return u.rlike(r"(?i)^(?:https?://|www\.)") | label.rlike("^[a-z]{2}$") | label.isin(list(tlds))


def extract_mentions(c: Column) -> Column:
    """All ``@name`` tokens, in order."""
    return F.regexp_extract_all(c, F.lit(MENTION_PATTERN), F.lit(0))


def extract_urls(c: Column, tlds: Sequence[str] = GENERIC_TLDS) -> Column:
    """Links in free text, in order; addresses with ``@`` are mail and left out.

    A bare host counts by its last label: any two letters, or one of ``tlds``.

    A link never spans blanks, quotes or brackets, so only the pieces between them that hold ``://``, or
    a dot before their last sign, meet the long expression; and only those outside ASCII its last part.
    """
    pieces = F.filter(
        F.split(c, URL_BREAKS),
        lambda t: ((F.instr(t, ".") > 0) & (F.instr(t, ".") < F.length(t))) | t.contains("://")
    )
    wide = lambda t: F.octet_length(t) > F.length(t)
    found = F.flatten(F.transform(pieces, lambda t: F.when(
        wide(t), F.regexp_extract_all(t, F.lit(URL_PATTERN), F.lit(0))
    ).otherwise(F.regexp_extract_all(t, F.lit(_ASCII_URL_PATTERN), F.lit(0)))))
    trimmed = F.transform(found, lambda u: F.regexp_replace(u, URL_TRAILING, ""))
    return F.filter(trimmed, lambda u: _accept(u, tlds))


def normalize_hashtags(c: Column) -> Column:
    """``[{text}, ...]`` to a comma string; empty or missing gives null."""
    return F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda h: h["text"]), ","))


def wrap_hashtags(c: Column) -> Column:
    """``[text, ...]`` to ``[{text}, ...]``."""
    return F.transform(c, lambda t: F.struct(t.alias("text")))


def clean_file_name(c: Column) -> Column:
    """Keep letters, digits, ``-`` and ``_`` only."""
    return F.regexp_replace(c, r"[^A-Za-z0-9_-]", "")


def default_job_name(prefix: str, c: Column) -> Column:
    """``<prefix>_<first 20 characters>``; a list becomes ``<prefix>_<n>_<a_b_c>``."""
    return F.concat(F.lit(prefix + "_"), F.substring(c, 1, 20))


def default_list_job_name(prefix: str, c: Column) -> Column:
    return F.concat(
        F.lit(prefix + "_"), F.size(c).cast("string"), F.lit("_"), F.array_join(c, "_")
    )


def lower_trim(c: Column) -> Column:
    """Lower case without blanks of any kind at either end."""
    return F.btrim(F.lower(c), F.lit(_BLANKS))


def study_url_from_id(c: Column) -> Column:
    # Fixed value: public registry page of a trial.
    return F.concat(F.lit("https://clinicaltrials.gov/show/"), c)
