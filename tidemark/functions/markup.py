"""Small HTML snippets for graph viewers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _anchor(href: Column, body: Column) -> Column:
    return F.concat(F.lit('<a href="'), href, F.lit('" target="_blank">'), body, F.lit("</a>"))


def link_urls(c: Column) -> Column:
    """Every blank-separated token becomes an anchor."""
    return F.array_join(F.transform(F.split(c, " "), lambda t: _anchor(t, t)), " ")


def embed_img(c: Column) -> Column:
    """Linked image for a non-empty address, otherwise ``''``."""
    image = F.concat(F.lit('<img src="'), c, F.lit('"/>'))
    return F.when((F.length(c) > 0) & (c != "nan"), _anchor(c, image)).otherwise(F.lit(""))


def menu_anchor(action: Column, text: Column) -> Column:
    return _anchor(action, text)
