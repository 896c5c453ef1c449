"""URL filter that carries block decisions over redirects and canonical links.

A rule is (host, path, verdict). It fits its host and all subdomains of it, for urls whose path
starts with the rule's path; the longest fitting rule decides (longest host, then longest path,
then allow before block).

Urls that redirect to each other or name each other as canonical are aliases: they form the
connected components of the link graph. A url without a rule takes over what its aliases were
given: allow if any alias is explicitly allowed, else block if any alias is blocked, else allow.

Nodes are urls without fragment and default port, scheme and host in lower case, ``/`` as the empty
path. Links come from
``<link rel=canonical href=...>`` and ``<meta http-equiv=refresh content="0;url=...">`` of the
pages themselves and, optionally, from a table of observed redirects. Relative targets of every
form are resolved against the page's url, and dot segments go from all targets; other schemes are no links.

Defined results: a null url or one without ``://`` has empty host and path, fits no rule, has no
alias and is allowed. A null html has no links. Repeated rows are judged alike, row by row; extra
columns of ``pages`` are kept. No pages give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import components, fresh, materialize

# Rules are broadcast up to this size (a rule list above it is joined by shuffle).
BROADCAST_RULES = 100_000

AUTHORITY = r"^.*?://([^/?#]*)"
PATH = r"^.*?://[^/?#]*([^?#]*)"
DEFAULT_PORT = "(?s)^(http://.*):80$|^(https://.*):443$"
TAG = r"(?is)<(?:link|meta)\s[^>]*>"
CANONICAL = r"""(?is)\srel\s*=\s*["']?canonical["'\s/>]"""
REFRESH = r"""(?is)\shttp-equiv\s*=\s*["']?refresh["'\s/>]"""
HREF = r"""(?is)\shref\s*=\s*["']?([^"'\s>]+)"""
REFRESH_URL = r"""(?is)\scontent\s*=\s*["']?\s*[0-9.]*\s*[;,]\s*url\s*=\s*["']?([^"'\s>]+)"""


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else ''."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "(?s)" + AUTHORITY, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else ''."""
    return F.coalesce(F.regexp_extract(url, "(?s)" + PATH, 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The url as a node; null if it has no ``://``.

    No fragment, scheme and host in lower case, no default port, and ``/`` for a missing path.
    """
    head = ascii_lower(F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1))
    head = F.regexp_replace(head, DEFAULT_PORT, "$1$2")
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    rest = F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(F.contains(url, F.lit("://")), F.concat(head, rest))


def _without_dots(target: Column) -> Column:
    """A target that begins with ``/`` without ``.`` and ``..`` in its path."""
    path = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    rest = F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    # A last dot segment names a folder.
    parts = F.split(F.regexp_replace(path, r"(/\.\.?)$", "$1/"), "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda a, x: F.when(x == ".", a).when(
        x == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(1)))).otherwise(F.concat(a, F.array(x))))
    return F.concat(F.array_join(kept, "/"), rest)


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Links (a, b) between nodes that the pages declare about themselves."""
    tags = pages.where(F.col(html).rlike(r"(?i)canonical|http-equiv")).select(
        F.col(url).alias("u"), F.explode(F.regexp_extract_all(html, F.lit(TAG), F.lit(0))).alias("tag"))
    target = F.when(F.col("tag").rlike(CANONICAL), F.regexp_extract("tag", HREF, 1)).when(
        F.col("tag").rlike(REFRESH), F.regexp_extract("tag", REFRESH_URL, 1))
    links = tags.select("u", F.replace(target, F.lit("&amp;"), F.lit("&")).alias("t")).where(F.col("t") != "")
    root = F.regexp_extract("u", r"(?s)^(.*?://[^/?#]*)", 1)
    path, t = path_of(F.col("u")), F.col("t")
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"(?s)^(.*/)", 1))
    whole = lambda x: F.concat(F.regexp_extract(x, r"(?s)^(.*?://[^/?#]*)", 1), _without_dots(
        F.regexp_extract(x, r"(?s)^.*?://[^/?#]*(.*)$", 1)))
    full = F.when(t.rlike("(?i)^https?://"), whole(t)).when(
        t.startswith("//"), whole(F.concat(F.regexp_extract("u", r"^(.*?:)//", 1), t))
    ).when(t.startswith("/"), F.concat(root, _without_dots(t))).when(
        t.startswith("?"), F.concat(root, path, t)
    ).when(~t.startswith("#") & ~t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(root, _without_dots(F.concat(folder, t))))
    return links.select(node_of(F.col("u")).alias("a"), node_of(full).alias("b")).where(
        F.col("a").isNotNull() & F.col("b").isNotNull())


def match_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of every distinct address that a rule fits.

    Every host is tried with all its suffixes, so that rules are met by an equi-join.
    """
    known = rules.select(
        ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"),
        F.col("verdict").alias("r_verdict"))
    if known.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        known = F.broadcast(known)
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    tried = addresses.distinct().select("host", "path", F.explode(suffixes).alias("r_host"))
    order = F.struct(F.length("r_host"), F.length("r_path"), F.when(F.col("r_verdict") == "allow", 1).otherwise(0),
                     "r_host", "r_path")
    return (
        tried.join(known, "r_host").where(F.startswith("path", "r_path"))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")),
                      order).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, url: str = "url", html: str = "html",
) -> DataFrame:
    """``pages`` with host, path, rule, verdict and alias_verdict.

    ``redirects`` has the string columns ``source`` and ``target``. alias_verdict is what the
    aliases say (null if none of them has a rule).
    """
    links = page_links(pages, url, html)
    if redirects is not None:
        links = links.unionByName(redirects.select(
            node_of(F.col("source")).alias("a"), node_of(F.col("target")).alias("b")))
    members = materialize(components(links, "a", "b"), "aliases")
    addresses = members.select(host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    own = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    ruled = materialize(match_rules(own.unionByName(addresses), rules), "ruled")
    spoken = (
        members.withColumn("host", host_of(F.col("node"))).withColumn("path", path_of(F.col("node")))
        .join(ruled, ["host", "path"])
        # 'allow' sorts before 'block': the smallest verdict of the aliases decides.
        .groupBy("component").agg(F.min("verdict").alias("said"))
    )
    k = {n: fresh(pages, n) for n in ("k_host", "k_path", "k_self", "k_node", "k_said", "x_host", "x_path", "x_rule", "x_verdict")}
    by_node = members.join(spoken, "component").select(F.col("node").alias(k["k_node"]), F.col("said").alias(k["k_said"]))
    # Urls without an address have no node of their own and meet no alias: each gets a key that spreads them.
    own_node = F.coalesce(node_of(F.col(url)), F.concat(F.lit(" "), F.monotonically_increasing_id().cast("string")))
    placed = pages.withColumns({
        k["k_host"]: host_of(F.col(url)), k["k_path"]: path_of(F.col(url)), k["k_self"]: own_node})
    best = ruled.select(F.col("host").alias(k["x_host"]), F.col("path").alias(k["x_path"]),
                        F.col("rule").alias(k["x_rule"]), F.col("verdict").alias(k["x_verdict"]))
    out = (
        placed.join(best, (placed[k["k_host"]] == best[k["x_host"]]) & (placed[k["k_path"]] == best[k["x_path"]]), "left")
        .join(by_node, F.col(k["k_self"]) == F.col(k["k_node"]), "left")
    )
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", "alias_verdict")]
    return out.select(
        *(placed[c] for c in kept), placed[k["k_host"]].alias("host"), placed[k["k_path"]].alias("path"),
        F.col(k["x_rule"]).alias("rule"),
        F.coalesce(k["x_verdict"], k["k_said"], F.lit("allow")).alias("verdict"), F.col(k["k_said"]).alias("alias_verdict"))


def rules_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")
