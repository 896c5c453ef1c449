"""Cleaning, flattening and types on hand-written posts."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import operators as op
from tidemark import plans
from tidemark.schemas import SCRAPED_SCHEMA, STATUS_SCHEMA

WHEN = "Wed Oct 10 20:19:24 +0000 2018"


def archive(spark, *posts):
    """Archive rows from partial dictionaries."""
    full = [{**dict.fromkeys(STATUS_SCHEMA.fieldNames()), "created_at": WHEN, **p} for p in posts]
    return spark.createDataFrame([tuple(p[n] for n in STATUS_SCHEMA.fieldNames()) for p in full], STATUS_SCHEMA)


USER = "{'id': 9, 'screen_name': \"O'Neil\", 'created_at': 'Wed Oct 10 20:19:24 +0000 2018', 'verified': True, 'location': None}"
INNER = "{'id': 77, 'created_at': 'Wed Oct 10 20:19:24 +0000 2018', 'user': {'id': 78}}"
ENTITIES = "{'urls': [{'expanded_url': 'http://a.b/'}], 'hashtags': [{'text': 'été'}], 'user_mentions': []}"


def test_legacy_archive(spark):
    df = archive(
        spark,
        {"id": 1, "user": USER, "entities": ENTITIES, "in_reply_to_status_id": 0},
        {"id": 2, "user": USER, "in_reply_to_status_id": 5, "retweeted_status": "None"},
        {"id": 3, "user": "{'id': ", "retweeted_status": INNER, "is_quote_status": False},
        {"id": 4, "user": None, "quoted_status": INNER, "is_quote_status": True},
        {"id": 5, "is_quote_status": True, "retweeted_status": INNER, "quoted_status": "broken("},
        {"id": 6, "retweeted_status": "nan", "in_reply_to_status_id": None},
    )
    got = {r.status_id: r for r in op.normalize_status(df, legacy=True).collect()}
    assert [got[i].status_type for i in range(1, 7)] == [
        "original", "reply", "retweet", "retweet_quote", "retweet_quote", "original"]
    assert got[1].created_date == got[1].user_created_at == 1539202764.0
    assert (got[1].user_id, got[1].user_screen_name, got[1].user_verified, got[1].user_location) == (
        9, "O'Neil", True, None)
    assert got[1].hashtags[0].text == "été" and got[1].urls[0].expanded_url == "http://a.b/"
    assert (got[3].retweet_id, got[3].retweet_user_id, got[3].retweet_created_at) == (77, 78, 1539202764.0)
    assert got[3].user_id is None and got[3].quote_id is None
    assert (got[4].quote_id, got[4].retweet_id) == (77, None)
    assert got[5].quote_id is None and got[5].retweet_id is None
    assert got[2].retweeted is False and got[6].retweeted is False


def test_to_archive_keeps_schema_and_defaults(spark):
    raw = spark.createDataFrame(
        [(1, None, None, (5, "x"), "extra", ["DE"])],
        "id LONG, possibly_sensitive BOOLEAN, in_reply_to_user_id LONG, user STRUCT<id: INT, n: STRING>, "
        "not_known STRING, withheld_in_countries ARRAY<STRING>",
    )
    out = plans.to_archive(raw)
    assert out.schema.fieldNames() == STATUS_SCHEMA.fieldNames()
    r = out.first()
    assert (r.possibly_sensitive, r.in_reply_to_user_id, r.user) == (False, 0, '{"id":5,"n":"x"}')
    assert r.favorite_count == 0 and r.lang is None


def test_enforce_schema(spark):
    schema = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.StringType())])
    df = spark.createDataFrame([("x", 1, True)], "a STRING, b INT, c BOOLEAN")
    out, dropped = op.enforce_schema(df, schema)
    assert out.columns == ["b", "a"] and dropped == ["c"] and out.first().b == 1
    with pytest.raises(ValueError, match="b"):
        op.enforce_schema(df.drop("b"), schema)
    with pytest.raises(Exception, match="(?i)cast|type"):
        op.enforce_schema(df.withColumn("b", F.array("b")), schema)[0].collect()


def test_fill_and_serializable(spark):
    df = spark.createDataFrame([(1, [1, 2], None)], "id INT, l ARRAY<INT>, place STRING").withColumn("v", F.lit(None))
    assert op.make_serializable(df, "csv").first().asDict() == {"id": 1, "l": "[1,2]", "place": None}
    assert op.make_serializable(df, "parquet").columns == ["id", "l", "place"]
    blank = op.fill_blank(df.drop("v")).first()
    assert (blank.id, blank.place, blank.l) == ("1", "", "[1,2]")
    assert op.drop_columns(df, ["nope", "v"]).columns == ["id", "l", "place"]


def scraped(spark, *posts):
    base = dict(id="1", conversation_id="1", created_at=1577820376771, user_id="4", username="u", name="N",
                tweet="", nlikes=1, nretweets=2, quote_url="", retweet=False, hashtags=[])
    full = [{**base, **p} for p in posts]
    return spark.createDataFrame([tuple(p[n] for n in SCRAPED_SCHEMA.fieldNames()) for p in full], SCRAPED_SCHEMA)


def test_scraped(spark):
    df = scraped(
        spark, {"id": "1"}, {"id": "2"}, {"id": "3", "quote_url": "http://q/1"}, {"id": "4", "retweet": True},
        {"id": "5", "quote_url": None, "tweet": "Hé @zoé see a.com/x and http://b.c", "hashtags": ["x", "y"]},
    )
    got = {r.status_id: r for r in op.normalize_scraped(df).collect()}
    assert [got[i].tweet_type_twint for i in range(1, 6)] == ["TWEET", "REPLY", "QUOTE_RETWEET", "RETWEET", "REPLY"]
    assert got[5].user_mentions == ["@zoé"] and got[5].urls == ["a.com/x", "http://b.c"]
    assert [h.text for h in got[5].hashtags] == ["x", "y"] and got[1].hashtags == []
    assert str(got[1].created_at).startswith("2019-12-31 19:26:16.771")
    old = {r.id: r.tweet_type_twint for r in op.classify_scraped_type(df, compat=True).collect()}
    assert old["1"] == old["5"] == "QUOTE_RETWEET" and old["3"] == "REPLY"


def test_graph_type_without_optional_columns(spark):
    df = spark.createDataFrame([(1, 0), (2, 3), (3, None)], "id INT, in_reply_to_status_id LONG")
    assert [r.tweet_type for r in op.classify_graph_type(df).orderBy("id").collect()] == ["TWEET", "REPLY", "TWEET"]


def test_rehydrate(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id LONG")
    store = spark.createDataFrame([(1, "FULL"), (2, "PARTIAL"), (3, None)], "id LONG, hydrated STRING")
    posts = archive(spark, *[{"id": i, "user": '{"id": 9}', "entities": "{}"} for i in (1, 2, 3, 4, 5)])
    assert sorted(r.status_id for r in plans.rehydrate(ids, store, posts).collect()) == [2, 3, 4]
