"""Column functions on hand-written values."""

import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.schemas import INNER_STATUS_SCHEMA


def value(spark, column, **inputs):
    df = spark.createDataFrame([tuple(inputs.values())], ", ".join(f"{k} STRING" for k in inputs))
    return df.select(column.alias("x")).first().x


def test_snowflake(spark):
    r = spark.range(1).select(
        fn.snowflake_time(F.lit(1212092628029698048)).alias("t"),
        fn.snowflake_machine(F.lit(1212092628029698048)).alias("m"),
        fn.snowflake_sequence(F.lit((5 << 22) | (375 << 12) | 77)).alias("s"),
    ).first()
    assert (r.t, r.m, r.s) == (1577820376771, (1212092628029698048 >> 12) & 1023, 77)
    ids = fn.snowflake_id_range(spark, 1577820376771, 1577820376781).collect()
    assert len(ids) == 10 * 20 and len({i.id for i in ids}) == 200
    assert all((i.id >> 22) + fn.SNOWFLAKE_EPOCH_MS == i.ms for i in ids)
    assert fn.snowflake_id_range(spark, 5, 5).count() == 0


@pytest.mark.parametrize(("text", "want"), [
    ("hi @bob, @émile and a@b.c", ["@bob", "@émile", "@b"]), ("none", []), ("@", []), ("@@x_1", ["@x_1"]),
])
def test_mentions(spark, text, want):
    assert value(spark, fn.extract_mentions(F.col("t")), t=text) == want


@pytest.mark.parametrize(("text", "want"), [
    ("see http://a.b/c?d=1#e, then (https://x.org/y).", ["http://a.b/c?d=1#e", "https://x.org/y"]),
    ("www.site.test and example.com/path; mail me@example.com", ["www.site.test", "example.com/path"]),
    ("end.The start, version 1.2.3", []), ("http://localhost:80/x", ["http://localhost:80/x"]),
    ("example.nosuchlabel example.com example.community", ["example.com", "example.community"]), ("", []),
    ("HTTP://U.EXAMPLE/ÀB", ["HTTP://U.EXAMPLE/ÀB"]),
])
def test_urls(spark, text, want):
    assert value(spark, fn.extract_urls(F.col("t")), t=text) == want


def test_url_parts(spark):
    p = value(spark, fn.parse_url_parts(F.col("u")), u="https://me:pw@Host.example:8080/a/b;v=1?q=1&r=2#top")
    assert p.asDict() == {
        "schema": "https", "netloc": "me:pw@Host.example:8080", "path": "/a/b;v=1", "params": "",
        "query": "q=1&r=2", "fragment": "top", "username": "me", "password": "pw",
        "hostname": "host.example", "port": 8080,
    }
    blank = value(spark, fn.parse_url_blank(F.col("u")), u="https://me:pw@Host.example:8080/a/b;v=1?q=1").asDict()
    assert (blank["path"], blank["params"], blank["fragment"], blank["port"]) == ("/a/b", "v=1", "", "8080")
    assert blank["tweet_id"] == blank["job_name"] == ""
    odd = value(spark, fn.parse_url_parts(F.col("u")), u="::not a url[")
    assert odd.hostname is None
    assert value(spark, fn.parse_url_parts(F.col("u")), u=None) is None
    v6 = value(spark, fn.parse_url_parts(F.col("u")), u="http://[::1]:99/")
    assert (v6.hostname, v6.port) == ("::1", 99)


@pytest.mark.parametrize(("text", "want"), [
    ("Wed Oct 10 20:19:24 +0000 2018", "2018-10-10 20:19:24"), ("Wed Oct 10 20:19:24 +0200 2018", "2018-10-10 18:19:24"),
    ("2018-10-10 20:19:24", "2018-10-10 20:19:24"), ("soon", None), (None, None),
])
def test_post_time(spark, text, want):
    assert value(spark, fn.parse_post_time(F.col("t")).cast("string"), t=text) == want


@pytest.mark.parametrize(("text", "want"), [
    ("{'id': 5, 'created_at': None, 'user': {'id': 6}, 'ok': True}", (5, None, (6,))),
    ('{"id": 7, "created_at": "it\'s None"}', (7, "it's None", None)),
    ("{'id': ", (None, None, None)), ("None", (None, None, None)), (None, (None, None, None)),
    ("{1: 'a', 'id': 8, 'created_at': 'été'}", (8, "été", None)),
])
def test_literal_text(spark, text, want):
    got = value(spark, fn.parse_repr_struct(F.col("t"), INNER_STATUS_SCHEMA), t=text)
    assert tuple(got) == want


def test_json_text(spark):
    r = spark.range(1).select(
        fn.to_json_string(F.lit("a\"b")).alias("s"), fn.to_json_string(F.lit(True)).alias("b"),
        fn.to_json_string(F.lit(None).cast("string")).alias("n"),
        fn.to_json_string(F.lit(float("nan")), nan_is_null=True).alias("f"),
        fn.to_json_string(F.array(F.lit(1), F.lit(2))).alias("l"),
    ).first()
    assert (r.s, r.b, r.n, r.f, r.l) == ('"a\\"b"', "true", None, None, "[1,2]")


def test_small_texts(spark):
    assert value(spark, fn.lower_trim(F.col("t")), t=" \tAspirin \n") == "aspirin"
    assert value(spark, fn.clean_file_name(F.col("t")), t="a/b c-é_1.txt") == "abc-_1txt"
    assert value(spark, fn.default_job_name("search", F.col("t")), t="x" * 30) == "search_" + "x" * 20
    assert value(spark, fn.embed_img(F.col("t")), t=None) == value(spark, fn.embed_img(F.col("t")), t="nan") == ""
    assert value(spark, fn.link_urls(F.col("t")), t="a") == '<a href="a" target="_blank">a</a>'
    empty = fn.normalize_hashtags(fn.wrap_hashtags(F.array().cast("array<string>")))
    assert value(spark, empty, t="x") is None
    two = fn.normalize_hashtags(fn.wrap_hashtags(F.array(F.lit("a"), F.lit("b"))))
    assert value(spark, two, t="x") == "a,b"


def test_links_by_country_code_and_listed_domain(spark):
    text = "see bit.ly/abc, youtu.be/xyz and cbc.ca; https://a.ly/1 ex.com/q www.x.y me@b.co name.Surname v1.2 a.museum/x"
    got = spark.range(1).select(F.lit(text).alias("t")).select(fn.extract_urls(F.col("t"))).first()[0]
    assert got == ["bit.ly/abc", "youtu.be/xyz", "cbc.ca", "https://a.ly/1", "ex.com/q", "www.x.y", "a.museum/x"]
    few = spark.range(1).select(fn.extract_urls(F.lit("a.museum b.com"), ["com"])).first()[0]
    assert few == ["b.com"]


def test_urls_are_split_once(spark):
    urls = spark.createDataFrame([("HTTPS://u:p@[::1]:80/A;x?q#f",), (None,)], "u STRING")
    both = urls.select(fn.parse_url_parts(F.col("u")).alias("p"), fn.parse_url_blank(F.col("u")).alias("b"))
    r = both.first()
    assert (r.p.schema, r.p.hostname, r.p.port, r.b.schema, r.b.hostname, r.b.params) == ("https", "::1", 80, "https", "::1", "x")
    plan = urls.select(fn.parse_url_parts(F.col("u")).alias("p")).where("p.port > 1").select("p.*")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("[^:/?#]+") <= 2


def test_empty_phrase(spark):
    from tidemark import operators as op

    with pytest.raises(ValueError):
        op.match_any_phrase(F.lit("x"), ["a", ""])


def test_links_under_any_public_domain(spark):
    text = "visit.berlin my.bank/a x.capital, y.ventures z.london. пример.рф/б a.xn--p1ai shop.co me@mail.berlin no.suchdomain Ende.Dann"
    got = spark.range(1).select(fn.extract_urls(F.lit(text))).first()[0]
    assert got == ["visit.berlin", "my.bank/a", "x.capital", "y.ventures", "z.london", "пример.рф/б", "a.xn--p1ai", "shop.co"]
