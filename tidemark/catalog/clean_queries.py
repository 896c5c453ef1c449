"""Schema, projection, cleaning and post types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as op
from ..functions import parse_repr_struct
from ..schemas import INNER_STATUS_SCHEMA
from .registry import query
from .views import Views, with_views

# Post time as text: Thu Jan 04 10:00:00 +0000 2024
POST_TIME = "EEE MMM dd HH:mm:ss Z yyyy"


@query("fill_expected_columns", with_views("posts", """
    SELECT status_id AS id, full_text, reply_to AS in_reply_to_status_id, '[]' AS contributors,
           CAST(0 AS BIGINT) AS favorite_count, FALSE AS possibly_sensitive,
           CAST(NULL AS VARCHAR) AS lang, CAST(0 AS BIGINT) AS in_reply_to_user_id
    FROM posts"""))
def _(v: Views) -> DataFrame:
    return op.fill_expected_columns(v.raw_posts()).select(
        "id", "full_text", "in_reply_to_status_id", "contributors", "favorite_count",
        "possibly_sensitive", "lang", "in_reply_to_user_id",
    )


@query("drop_columns", "SELECT doc_id, text, lang FROM documents")
def _(v: Views) -> DataFrame:
    return op.drop_columns(v.table("documents"), ["n_chars", "source", "no_such_column"])


@query("sort_columns", "SELECT c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey FROM customer")
def _(v: Views) -> DataFrame:
    return op.sort_columns(v.table("customer"))


@query("coerce_columns", """
    SELECT d.doc_id, '[0,' || d.n_chars || ']' AS display_text_range,
           COALESCE(l.toxic = 1, FALSE) AS possibly_sensitive,
           CAST(COALESCE(l.quality, 0) AS BIGINT) AS in_reply_to_status_id,
           '{"lang":"' || d.lang || '","source":"' || d.source || '"}' AS entities
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(v: Views) -> DataFrame:
    rows = v.table("documents").join(v.table("labels"), "doc_id", "left").select(
        "doc_id",
        F.array(F.lit(0).cast("bigint"), F.col("n_chars")).alias("display_text_range"),
        (F.col("toxic") == 1).alias("possibly_sensitive"),
        F.col("quality").alias("in_reply_to_status_id"),
        F.struct("lang", "source").alias("entities"),
    )
    return op.coerce_columns(rows)


@query("enforce_schema", "SELECT user_id, event_id, event_type FROM events")
def _(v: Views) -> DataFrame:
    schema = T.StructType([
        T.StructField("user_id", T.LongType()), T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
    ])
    return op.enforce_schema(v.ev(), schema)[0]


@query("make_serializable", """
    SELECT vec_id, label, CAST(len(embedding) AS BIGINT) AS n,
           CAST(round(embedding[1] * 1000) AS BIGINT) AS first_milli
    FROM embeddings""")
def _(v: Views) -> DataFrame:
    text = op.make_serializable(v.table("embeddings"), "csv")
    back = F.from_json("embedding", "array<double>")
    return text.select(
        "vec_id", "label", F.size(back).cast("bigint").alias("n"),
        F.round(back[0].cast("float") * 1000).cast("bigint").alias("first_milli"),
    )


@query("rename_status_ids", with_views("posts", """
    SELECT status_id, CAST(status_id AS VARCHAR) AS status_id_str, full_text FROM posts"""))
def _(v: Views) -> DataFrame:
    return op.rename_status_ids(v.raw_posts().select("id", "id_str", "full_text"))


@query("normalize_headers",
       "SELECT p_partkey AS trial_id, p_name AS public_title, p_type AS study_type, p_brand AS study_url FROM part")
def _(v: Views) -> DataFrame:
    return op.normalize_headers(v.table("part").select(
        F.col("p_partkey").alias("TrialID"), F.col("p_name").alias("Public title"),
        F.col("p_type").alias("Study type"), F.col("p_brand").alias("web address"),
    ))


@query("drop_columns_matching", "SELECT c_custkey, c_name FROM customer")
def _(v: Views) -> DataFrame:
    rows = v.table("customer").select("c_custkey", "c_name").withColumns({
        "Unnamed: 0": F.col("c_custkey"), "x.unNAMED_2": F.lit(1),
    })
    return op.drop_columns_matching(rows)


@query("fill_blank", """
    SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, d.lang, COALESCE(CAST(l.quality AS VARCHAR), '') AS quality
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(v: Views) -> DataFrame:
    return op.fill_blank(
        v.table("documents").join(v.table("labels"), "doc_id", "left").select("doc_id", "lang", "quality")
    )


@query("project_properties", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(v: Views) -> DataFrame:
    return op.project_properties(v.table("orders"), ["o_orderkey", "o_orderstatus"])


@query("clean_datetimes", """
    SELECT o_orderkey, epoch_us(o_orderdate) AS created_us, epoch(o_orderdate) AS created_date FROM orders""")
def _(v: Views) -> DataFrame:
    text = F.date_format(F.col("o_orderdate").cast("timestamp"), POST_TIME)
    rows = v.table("orders").select("o_orderkey", text.alias("created_at"))
    return op.clean_datetimes(rows).select(
        "o_orderkey", F.unix_micros("created_at").alias("created_us"), "created_date"
    )


@query("flag_retweeted", "SELECT event_id, event_type = 'click' AS retweeted FROM events")
def _(v: Views) -> DataFrame:
    held = F.when(F.col("event_type") == "click", F.col("props")).when(F.col("event_type") == "error", "None")
    return op.flag_retweeted(v.ev().select("event_id", held.alias("retweeted_status"))).select(
        "event_id", "retweeted"
    )


@query("tag_status_type", with_views("ev_typed", "SELECT event_id, status_type FROM ev_typed"))
def _(v: Views) -> DataFrame:
    return op.tag_status_type(v.ev_typed()).select("event_id", "status_type")


@query("parse_repr_struct", """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN event_id END AS id,
           CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
           CASE WHEN event_type NOT IN ('error', 'view') THEN 'it''s ' || event_type END AS created_at
    FROM events""")
def _(v: Views) -> DataFrame:
    made = F.when(F.col("event_type") == "view", "None").otherwise(
        F.concat(F.lit('"it\'s '), "event_type", F.lit('"'))
    )
    text = F.concat(
        F.lit("{'id': "), "event_id", F.lit(", 'kept': True, 'created_at': "), made,
        F.lit(", 'user': {'id': "), "user_id",
        F.when(F.col("event_type") == "error", "}").otherwise("}}"),
    )
    return v.ev().select("event_id", parse_repr_struct(text, INNER_STATUS_SCHEMA).alias("p")).select(
        "event_id", "p.id", F.col("p.user.id").alias("user_id"), "p.created_at"
    )


def _inner_json() -> F.Column:
    return F.to_json(F.struct(
        F.col("event_id").alias("id"), F.date_format("ts", POST_TIME).alias("created_at"),
        F.struct(F.col("user_id").alias("id")).alias("user"), F.col("props").alias("more"),
    ))


def _inner_sql(status_type: str, prefix: str) -> str:
    return with_views("ev_typed", f"""
        SELECT event_id, CASE WHEN status_type = '{status_type}' THEN event_id END AS {prefix}id,
               CASE WHEN status_type = '{status_type}' THEN epoch(date_trunc('second', ts)) END
                 AS {prefix}created_at,
               CASE WHEN status_type = '{status_type}' THEN user_id END AS {prefix}user_id
        FROM ev_typed""")


@query("flatten_retweets", _inner_sql("retweet", "retweet_"))
def _(v: Views) -> DataFrame:
    rows = op.tag_status_type(v.ev_typed()).withColumn("retweeted_status", _inner_json())
    return op.flatten_retweets(rows).select(
        "event_id", "retweet_id", "retweet_created_at", "retweet_user_id"
    )


@query("flatten_quotes", _inner_sql("retweet_quote", "quote_"))
def _(v: Views) -> DataFrame:
    rows = op.tag_status_type(v.ev_typed()).withColumn("quoted_status", _inner_json())
    return op.flatten_quotes(rows).select("event_id", "quote_id", "quote_created_at", "quote_user_id")


@query("flatten_users", """
    SELECT c_custkey, c_custkey AS user_id, c_name AS user_name, c_mktsegment AS user_location,
           CAST(c_nationkey AS BIGINT) AS user_followers_count, CAST(NULL AS VARCHAR) AS user_time_zone,
           epoch(TIMESTAMP '2020-05-06 07:08:09') AS user_created_at
    FROM customer""")
def _(v: Views) -> DataFrame:
    packed = F.to_json(F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("location"), F.col("c_nationkey").alias("followers_count"),
        F.lit("Wed May 06 07:08:09 +0000 2020").alias("created_at"), F.lit(1).alias("unknown_field"),
    ))
    return op.flatten_users(v.table("customer").select("c_custkey", packed.alias("user"))).select(
        "c_custkey", "user_id", "user_name", "user_location", "user_followers_count",
        "user_time_zone", "user_created_at",
    )


@query("flatten_entities", """
    SELECT l_orderkey, l_linenumber, 'http://p/' || l_partkey || ' http://s/' || l_suppkey AS links,
           CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag || ',' || l_linestatus END AS tags,
           l_suppkey AS first_account, '@p' || l_partkey AS last_account
    FROM lineitem""")
def _(v: Views) -> DataFrame:
    packed = F.to_json(F.struct(
        F.transform("links", lambda u: F.struct(u.alias("expanded_url"))).alias("urls"),
        F.transform("tags", lambda t: F.struct(t.alias("text"))).alias("hashtags"), "user_mentions",
    ))
    flat = op.flatten_entities(v.items().select("l_orderkey", "l_linenumber", packed.alias("entities")))
    return flat.select(
        "l_orderkey", "l_linenumber",
        F.array_join(F.transform("urls", lambda u: u["expanded_url"]), " ").alias("links"),
        F.array_join(F.transform("hashtags", lambda h: h["text"]), ",").alias("tags"),
        F.col("user_mentions")[0]["id"].alias("first_account"),
        F.col("user_mentions")[1]["screen_name"].alias("last_account"),
    )


@query("normalize_status", with_views("ev_typed", """
    SELECT event_id AS status_id, epoch(date_trunc('second', ts)) AS created_date, status_type,
           event_type = 'click' AS retweeted,
           CASE WHEN status_type = 'retweet' THEN event_id END AS retweet_id,
           CASE WHEN status_type = 'retweet_quote' THEN user_id END AS quote_user_id,
           user_id, event_type AS user_screen_name, CAST(1 AS BIGINT) AS n_urls
    FROM ev_typed"""))
def _(v: Views) -> DataFrame:
    e = v.ev_typed()
    raw = e.select(
        F.col("event_id").alias("id"), F.col("event_id").cast("string").alias("id_str"),
        F.date_format("ts", POST_TIME).alias("created_at"), "is_quote_status", "in_reply_to_status_id",
        F.when(F.col("event_type") == "click", _inner_json()).alias("retweeted_status"),
        F.when(F.col("event_type") == "error", _inner_json()).alias("quoted_status"),
        F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("screen_name"),
                 *[F.lit(None).cast(t).alias(n) for n, t in (
                     ("created_at", "string"), ("followers_count", "bigint"), ("friends_count", "bigint"),
                     ("favourites_count", "bigint"), ("utc_offset", "string"), ("time_zone", "string"),
                     ("verified", "boolean"), ("statuses_count", "bigint"),
                     ("profile_image_url", "string"), ("location", "string"), ("name", "string"),
                     ("description", "string"))]).alias("user"),
        F.to_json(F.struct(F.array(F.struct(
            F.concat(F.lit("http://e/"), "event_id").alias("expanded_url"))).alias("urls"))).alias("entities"),
    )
    return op.normalize_status(raw).select(
        "status_id", "created_date", "status_type", "retweeted", "retweet_id", "quote_user_id",
        "user_id", "user_screen_name", F.size("urls").cast("bigint").alias("n_urls"),
    )


def _scraped(v: Views) -> DataFrame:
    return v.posts().select(
        F.col("status_id").cast("string").alias("id"),
        F.col("conversation_id").cast("string").alias("conversation_id"),
        (F.col("status_id") * 1000 + 1_700_000_000_000).alias("created_at"),
        F.length("user_name").cast("string").alias("user_id"),
        F.col("user_name").alias("username"), F.upper("user_name").alias("name"),
        F.concat("full_text", F.lit(" @"), "user_name", F.lit(" see http://a.example/x?y=1, now"))
        .alias("tweet"),
        F.length("full_text").cast("bigint").alias("nlikes"), F.lit(3).cast("bigint").alias("nretweets"),
        F.when(F.length("full_text") % 5 == 0, "http://q.example/1").otherwise("").alias("quote_url"),
        (F.length("full_text") % 7 == 0).alias("retweet"),
        F.array("user_name", F.lit("all")).alias("hashtags"),
    )


_SCRAPED_TYPE = """CASE WHEN length(full_text) % 5 = 0 THEN 'QUOTE_RETWEET'
                        WHEN length(full_text) % 7 = 0 THEN 'RETWEET'
                        WHEN status_id = conversation_id THEN 'TWEET' ELSE 'REPLY' END"""


@query("normalize_scraped", with_views("posts", rf"""
    SELECT status_id, full_text || ' @' || user_name || ' see http://a.example/x?y=1, now' AS full_text,
           CAST(length(full_text) AS BIGINT) AS favorite_count, upper(user_name) AS user_screen_name,
           {_SCRAPED_TYPE} AS tweet_type_twint,
           (status_id * 1000 + 1700000000000) * 1000 AS created_us,
           user_name || ',all' AS tags, '@' || user_name AS mentioned, 'http://a.example/x?y=1' AS links,
           CAST(0 AS BIGINT) AS in_reply_to_status_id
    FROM posts"""))
def _(v: Views) -> DataFrame:
    return op.normalize_scraped(_scraped(v)).select(
        "status_id", "full_text", "favorite_count", "user_screen_name", "tweet_type_twint",
        F.unix_micros("created_at").alias("created_us"),
        F.array_join(F.transform("hashtags", lambda h: h["text"]), ",").alias("tags"),
        F.array_join("user_mentions", " ").alias("mentioned"), F.array_join("urls", " ").alias("links"),
        "in_reply_to_status_id",
    )


@query("classify_scraped_type", with_views("posts", f"""
    SELECT CAST(status_id AS VARCHAR) AS id, {_SCRAPED_TYPE} AS tweet_type_twint FROM posts"""))
def _(v: Views) -> DataFrame:
    return op.classify_scraped_type(_scraped(v)).select("id", "tweet_type_twint")


@query("classify_graph_type", """
    SELECT event_id, CASE WHEN event_type = 'signup' THEN 'PRESET'
        WHEN event_id % 3 > 0 AND event_type = 'view' THEN 'REPLY'
        WHEN user_id % 5 > 0 THEN 'QUOTE_RETWEET' WHEN event_id % 2 > 0 THEN 'RETWEET'
        ELSE 'TWEET' END AS tweet_type
    FROM events""")
def _(v: Views) -> DataFrame:
    rows = v.ev().select(
        "event_id",
        F.when(F.col("event_type") == "signup", "PRESET").when(F.col("event_type") == "view", "")
        .alias("tweet_type_twint"),
        F.when(F.col("event_type") == "view", F.col("event_id") % 3).alias("in_reply_to_status_id"),
        (F.col("user_id") % 5).alias("quoted_status_id"), (F.col("event_id") % 2).alias("retweet_id"),
    )
    return op.classify_graph_type(rows).select("event_id", "tweet_type")


@query("sample_rows", """
    SELECT doc_id, lang, n_chars FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 20""")
def _(v: Views) -> DataFrame:
    return op.sample_rows(v.table("documents"), "doc_id", 20, seed=7).select("doc_id", "lang", "n_chars")
