"""Split a URL with the expression of RFC 3986, appendix B; nothing here raises on bad input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

RFC3986 = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?"

PART_NAMES = [
    "schema", "netloc", "path", "params", "query", "fragment",
    "username", "password", "hostname", "port",
]


def _split(url: Column) -> Column:
    """Scheme, authority, path, query and fragment as a list; one pass of the long expression."""
    return F.split(F.regexp_replace(url, RFC3986, "$2\u0001$4\u0001$5\u0001$7\u0001$9"), "\u0001")


def _with_parts(url: Column, build: Callable[[dict[str, Column]], Column]) -> Column:
    """``build`` over all parts, missing ones empty.

    The list of one split is bound to a lambda's argument, so the optimizer cannot copy the split
    into every part. The scheme and the host are lower case, an IPv6 host has no brackets.
    """

    def parts(cut: Column) -> Column:
        def piece(i: int) -> Column:
            return F.coalesce(F.get(cut, F.lit(i)), F.lit(""))

        authority = piece(1)
        userinfo = F.regexp_extract(authority, r"^(.*)@", 1)
        address = F.regexp_replace(authority, r"^.*@", "")
        host = F.regexp_extract(address, r"^(\[[^\]]*\]|[^:]*)", 1)
        return build({
            "schema": F.lower(piece(0)),
            "netloc": authority,
            "path": piece(2),
            "params": F.lit(""),
            "query": piece(3),
            "fragment": piece(4),
            "username": F.regexp_extract(userinfo, r"^([^:]*)", 1),
            "password": F.regexp_extract(userinfo, r"^[^:]*:(.*)$", 1),
            "hostname": F.lower(F.translate(host, "[]", "")),
            "port": F.regexp_extract(address, r":([0-9]+)$", 1),
        })

    return F.get(F.transform(F.array(_split(url)), parts), F.lit(0))


def parse_url_parts(c: Column) -> Column:
    """Struct of the ten parts, absent ones null (``params`` is always empty); null URL gives null."""

    def build(p: dict[str, Column]) -> Column:
        fields = []
        for name in PART_NAMES:
            value = p[name] if name == "params" else F.nullif(p[name], F.lit(""))
            fields.append((value.try_cast("int") if name == "port" else value).alias(name))
        return F.struct(*fields)

    return F.when(c.isNotNull(), _with_parts(c, build))


def parse_url_blank(c: Column) -> Column:
    """The same split with every missing part ``''``, ``;params`` cut off the last path segment,
    and blank job columns."""

    def build(p: dict[str, Column]) -> Column:
        path = p["path"]
        p = {**p, "params": F.regexp_extract(path, r";([^/]*)$", 1), "path": F.regexp_replace(path, r";[^/]*$", "")}
        blank = [F.lit("").alias(n) for n in ("tweet_id", "job_id", "job_name")]
        return F.struct(*blank, c.alias("url"), *[p[n].alias(n) for n in PART_NAMES])

    return F.when(c.isNotNull(), _with_parts(c, build))
