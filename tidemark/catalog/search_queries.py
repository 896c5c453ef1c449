"""Search predicates, windows and stores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as op
from .. import plans, sources
from .registry import query
from .views import NON_WORD, Views, filled, whole, with_views

PHRASES = ["the", "that", "avec", "de les", "Und", "privacy policy"]
WORDS = ["license", "mail", "Ther"]

_SINCE, _UNTIL = "2023-11-14 22:20:00", "2023-11-15 06:05:00"
_TERMS = ["the", "What is", "you", "answer"]
_FOUND = " OR ".join(f"regexp_matches(lower(full_text), '(^|{NON_WORD}){t.lower()}($|{NON_WORD})')" for t in _TERMS)
# Posts of the span that hold a phrase, with their ten-minute window in seconds.
_HITS = with_views("timed_posts", f"""
    , hits AS (
        SELECT id, full_text, CAST(epoch(TIMESTAMP '{_SINCE}') AS BIGINT) + (s - CAST(epoch(TIMESTAMP '{_SINCE}') AS BIGINT)) // 600 * 600 AS t0
        FROM timed_posts WHERE s >= CAST(epoch(TIMESTAMP '{_SINCE}') AS BIGINT) AND ({_FOUND})),
    inside AS (SELECT * FROM hits WHERE t0 < CAST(epoch(TIMESTAMP '{_UNTIL}') AS BIGINT))""")


def _stored_posts(v: Views) -> DataFrame:
    return v.timed_posts().select("id", F.when(F.col("id") % 3 == 0, "FULL").otherwise("PARTIAL").alias("hydrated"))


def _found(rows: DataFrame) -> DataFrame:
    return rows.select("id", F.md5("full_text").alias("text_md5"), F.unix_seconds("t0").alias("t0_s"), F.unix_seconds("t1").alias("t1_s"))


@query("search_time_range", _HITS + """
    SELECT id, md5(full_text) AS text_md5, CAST(t0 AS BIGINT) AS t0_s, CAST(t0 + 600 AS BIGINT) AS t1_s FROM inside WHERE id % 3 <> 0""")
def search(v: Views) -> DataFrame:
    """Posts of a time span that hold a phrase, by ten-minute window, not yet stored in full."""
    return _found(plans.search_time_range(
        v.timed_posts(), "ts", "full_text", _TERMS, _SINCE, _UNTIL, "10 minutes", store=_stored_posts(v), order_cols=["ts"]))


_LIMITED = """
    , counts AS (SELECT t0, sum(count(*)) OVER (ORDER BY t0) - count(*) AS before FROM inside GROUP BY t0),
    kept AS (SELECT inside.* FROM inside JOIN counts USING (t0) WHERE before < 60)"""


@query("search_time_range_limited", _HITS + _LIMITED + """
    SELECT id, md5(full_text) AS text_md5, CAST(t0 AS BIGINT) AS t0_s, CAST(t0 + 600 AS BIGINT) AS t1_s FROM kept""")
def _(v: Views) -> DataFrame:
    """The first windows that hold 60 posts together."""
    return _found(plans.search_time_range(
        v.timed_posts(), "ts", "full_text", _TERMS, _SINCE, _UNTIL, "10 minutes", limit=60))


@query("search_to_archive", _HITS + """
    , u AS (SELECT id % 1000 AS user_id FROM inside WHERE id % 3 <> 0)
    SELECT 'post' AS kind, strftime(make_timestamp(CAST(t0 * 1000000 AS BIGINT)), '%Y-%m-%d-%H') AS ingest_hour, id FROM inside WHERE id % 3 <> 0
    UNION ALL SELECT DISTINCT 'profile', NULL, user_id FROM u WHERE user_id % 2 = 1""")
def _(v: Views) -> DataFrame:
    """The search written to the hourly archive by window, with the profiles of users not enriched before; run twice."""
    archive = sources.HourlyArchive(v.spark, v.new_path("archive"))
    author = lambda c: F.col(c) % 1000
    posts = v.timed_posts().withColumn("username", F.concat(F.lit("u"), author("id")))
    profiles = posts.select(author("id").alias("id"), "username").distinct()
    for _ in range(2):
        new = plans.search_to_archive(
            posts, "ts", "full_text", _TERMS, _SINCE, _UNTIL, archive, "span", profiles.where("id % 2 = 0"), profiles, "10 minutes",
            store=_stored_posts(v), order_cols=["ts"])
    rows = archive.read("id bigint").select(F.lit("post").alias("kind"), "ingest_hour", "id")
    return rows.unionByName(new.select(F.lit("profile").alias("kind"), F.lit(None).cast("string").alias("ingest_hour"), "id"))


def _phrase_sql(p: str) -> str:
    return f"regexp_matches(lower(text), '(^|{NON_WORD}){p.lower()}($|{NON_WORD})')"


@query("match_any_phrase",
       "SELECT doc_id FROM documents WHERE " + " OR ".join(_phrase_sql(p) for p in PHRASES))
def _(v: Views) -> DataFrame:
    return v.table("documents").where(op.match_any_phrase(F.col("text"), PHRASES)).select("doc_id")


@query("tag_topics", with_views("posts vocab topics", f"""
    SELECT status_id, string_agg(DISTINCT topic, ',' ORDER BY topic) AS topics
    FROM (SELECT status_id, {filled('lower(full_text)')} AS t FROM posts) JOIN topics ON {whole('phrase', 't')}
    GROUP BY status_id"""))
def _(v: Views) -> DataFrame:
    tagged = op.tag_topics(v.posts(), "status_id", "full_text", v.topics())
    return tagged.select("status_id", F.array_join("topics", ",").alias("topics"))


@query("keyword_track", "SELECT doc_id FROM documents WHERE " + " OR ".join(
    f"contains(lower(text), '{w.lower()}')" for w in WORDS))
def _(v: Views) -> DataFrame:
    return op.keyword_track(v.table("documents"), "text", WORDS).select("doc_id")


@query("bounding_box",
       "SELECT event_id FROM events WHERE value BETWEEN 10 AND 50 AND user_id BETWEEN 5 AND 60")
def _(v: Views) -> DataFrame:
    return op.bounding_box(v.ev(), "value", "user_id", (10, 5, 50, 60)).select("event_id")


@query("user_timeline", """
    SELECT user_id, event_id, epoch_us(ts) AS us FROM events
    WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def _(v: Views) -> DataFrame:
    users = v.table("customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("user_id")
    )
    return op.user_timeline(v.ev(), users, "ts").select("user_id", "event_id", F.unix_micros("ts").alias("us"))


@query("suspended_profiles", """
    SELECT c_custkey AS username, c_custkey NOT IN (SELECT o_custkey FROM orders) AS suspended FROM customer""")
def _(v: Views) -> DataFrame:
    return op.suspended_profiles(
        v.table("customer").select(F.col("c_custkey").alias("username")),
        v.table("orders").select(F.col("o_custkey").alias("username")),
    )


@query("non_empty_mentions", with_views("mentions", """
    SELECT status_id, array_to_string(user_mentions, ' ') AS found FROM mentions
    WHERE len(user_mentions) > 0"""))
def _(v: Views) -> DataFrame:
    return op.non_empty_mentions(v.mentions()).select(
        "status_id", F.array_join("user_mentions", " ").alias("found")
    )


# --- windows ---------------------------------------------------------------------------------

def _windows_sql(since: str, until: str, step: int) -> str:
    us = step * 1_000_000
    return f"""w AS (
        SELECT *, epoch_us(TIMESTAMP '{since}')
            + ((epoch_us(ts) - epoch_us(TIMESTAMP '{since}')) // {us}) * {us} AS t0_us
        FROM events WHERE ts >= TIMESTAMP '{since}'),
      inside AS (SELECT * FROM w WHERE t0_us < epoch_us(TIMESTAMP '{until}'))"""


@query("stride_windows", f"""
    WITH {_windows_sql('2024-01-02 03:07:00', '2024-01-29 00:00:00', 600)}
    SELECT event_id, t0_us, t0_us + 600000000 AS t1_us FROM inside""")
def _(v: Views) -> DataFrame:
    rows = op.stride_windows(v.ev(), "ts", "2024-01-02 03:07:00", "2024-01-29 00:00:00", 600)
    return rows.select("event_id", F.unix_micros("t0").alias("t0_us"), F.unix_micros("t1").alias("t1_us"))


@query("stride_windows_limited", f"""
    WITH {_windows_sql('2024-01-02 03:07:00', '2024-01-29 00:00:00', 600)},
    counts AS (SELECT t0_us, count(*) AS n FROM inside GROUP BY t0_us),
    kept AS (SELECT t0_us FROM (
        SELECT t0_us, COALESCE(sum(n) OVER (ORDER BY t0_us
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM counts) WHERE before < 500)
    SELECT event_id, t0_us FROM inside WHERE t0_us IN (SELECT t0_us FROM kept)""")
def _(v: Views) -> DataFrame:
    rows = op.stride_windows_limited(
        v.ev(), "ts", "2024-01-02 03:07:00", "2024-01-29 00:00:00", 600, 500
    )
    return rows.select("event_id", F.unix_micros("t0").alias("t0_us"))


@query("backfill_windows", """
    SELECT outer_no, epoch_us(TIMESTAMP '2024-01-03 00:00:00') + outer_no * 86400000000
             + ((off - outer_no * 86400000000) // 28800000000) * 28800000000 AS t0_us, count(*) AS hits
    FROM (SELECT off, off // 86400000000 AS outer_no FROM (
            SELECT epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-03 00:00:00') AS off
            FROM events WHERE ts >= TIMESTAMP '2024-01-03 00:00:00'))
    GROUP BY ALL""")
def _(v: Views) -> DataFrame:
    rows = op.backfill_windows(v.ev(), "ts", "2024-01-03 00:00:00", "1 day", "8 hours")
    return rows.groupBy("outer_no", F.unix_micros("t0").alias("t0_us")).agg(F.count("*").alias("hits"))


@query("hits_per_window", """
    SELECT (epoch_us(ts) // 21600000000) * 21600000000 AS t0_us, count(*) AS hits FROM events GROUP BY 1""")
def _(v: Views) -> DataFrame:
    return op.hits_per_window(v.ev(), "ts", "6 hours").select(F.unix_micros("t0").alias("t0_us"), "hits")


# --- store look-ups --------------------------------------------------------------------------

@query("tweet_hydration_status", with_views("hyd", "SELECT id, hydrated FROM hyd"))
def _(v: Views) -> DataFrame:
    ids = v.table("documents").select(F.col("doc_id").alias("id"))
    return op.tweet_hydration_status(ids, v.stored())


@query("account_hydration_status", """
    SELECT c_custkey AS id, CASE WHEN n >= 10 THEN 'FULL' WHEN n IS NOT NULL THEN 'PARTIAL' END AS hydrated
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def _(v: Views) -> DataFrame:
    store = v.table("orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n")).select(
        "id", F.when(F.col("n") >= 10, "FULL").otherwise("PARTIAL").alias("hydrated")
    )
    return op.account_hydration_status(v.table("customer").select(F.col("c_custkey").alias("id")), store)


@query("needs_hydration", with_views("hyd", """
    SELECT h.id, d.lang FROM hyd h JOIN documents d ON h.id = d.doc_id
    WHERE h.hydrated IS DISTINCT FROM 'FULL'"""))
def _(v: Views) -> DataFrame:
    docs = v.table("documents").select(F.col("doc_id").alias("id"), "lang", F.lit(0).alias("seq"))
    twice = docs.unionByName(docs.withColumns({"lang": F.lit("copy"), "seq": F.lit(1)}))
    return op.needs_hydration(twice, v.stored(), order_cols=["seq"]).select("id", "lang")


@query("missing_ids_batched", with_views("hyd", """
    SELECT CAST((r - 1) // 100 AS BIGINT) AS batch_no, count(*) AS requested,
           count(*) FILTER (hydrated IS DISTINCT FROM 'FULL') AS missing
    FROM (SELECT *, row_number() OVER (ORDER BY id) AS r FROM hyd) GROUP BY 1"""))
def _(v: Views) -> DataFrame:
    ids = v.table("documents").select(F.col("doc_id").alias("id"))
    return op.missing_ids_batched(ids, v.stored(), "id").groupBy("batch_no").agg(
        F.count("*").alias("requested"), F.count_if("missing").alias("missing")
    )


@query("get_by_ids", """
    SELECT o_orderkey AS id, o_orderstatus FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def _(v: Views) -> DataFrame:
    ids = v.table("lineitem").where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("id"))
    return op.get_by_ids(v.table("orders").withColumnRenamed("o_orderkey", "id"), ids, ["id", "o_orderstatus"])


@query("unseen_users", """
    SELECT c_custkey AS id, c_custkey AS username, c_name FROM customer
    WHERE c_custkey IN (SELECT user_id FROM events)
      AND c_custkey NOT IN (SELECT user_id FROM events WHERE value < 2)""")
def _(v: Views) -> DataFrame:
    e = v.ev().select(F.col("user_id").alias("username"), "value")
    profiles = v.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("username"), "c_name"
    )
    return op.unseen_users(e, e.where(F.col("value") < 2), profiles)


@query("cache_hit_rate", with_views("hyd", """
    SELECT count(*) AS requested, count(*) FILTER (hydrated = 'FULL') AS cached,
           count(*) FILTER (hydrated IS DISTINCT FROM 'FULL') AS missing,
           count(*) FILTER (hydrated IS NULL) AS unseen FROM hyd"""))
def _(v: Views) -> DataFrame:
    return op.cache_hit_rate(v.hyd())


@query("word_boundary_link", with_views("posts vocab", f"""
    SELECT term, status_id FROM vocab JOIN (SELECT status_id, {filled('lower(full_text)')} AS t FROM posts)
    ON {whole('term', 't')}"""))
def _(v: Views) -> DataFrame:
    return op.word_boundary_link(v.vocab(), v.posts(), "term", "status_id", "full_text")
