"""Store look-ups, upserts and edges on small tables."""

import pytest
from pyspark.sql import functions as F

from tidemark import operators as op
from tidemark import plans
from tidemark.operators.graph import empty_store, unresolved_edges

NOW, LATER = "2024-05-01 00:00:00", "2024-06-01 00:00:00"

TWEETS = {
    "id": "bigint", "text": "string", "created_at": "timestamp", "favorite_count": "bigint",
    "retweet_count": "bigint", "job_name": "string", "job_id": "string", "hashtags": "string",
    "type": "string", "hydrated": "string", "record_created_at": "timestamp", "record_updated_at": "timestamp",
}


@pytest.fixture(scope="module")
def store(spark):
    return spark.createDataFrame(
        [(1, "Tweet 1", "FULL"), (2, "Tweet 2", "FULL"), (3, "Tweet 3", None),
         (4, "Tweet 4", "PARTIAL"), (5, "Tweet 5", "PARTIAL")],
        "id LONG, text STRING, hydrated STRING",
    )


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id LONG")


def test_status_of_ids(spark, store, rows):
    want = [(1, "FULL"), (2, "FULL"), (3, None), (4, "PARTIAL"), (5, "PARTIAL"), (9, None)]
    assert rows(op.tweet_hydration_status(ids(spark, 1, 2, 3, 4, 5, 9), store)) == want
    assert rows(op.account_hydration_status(ids(spark, 1, 9), store)) == [(1, "FULL"), (9, None)]
    assert rows(op.tweet_hydration_status(ids(spark, 8, 9), store)) == [(8, None), (9, None)]
    with pytest.raises(TypeError):
        op.tweet_hydration_status(store.drop("id"), store)


def test_needs_hydration(spark, store, rows):
    df = spark.createDataFrame([(1, "a", 0), (3, "b", 1), (9, "late", 3), (9, "c", 2), (4, "d", 4)],
                               "id LONG, t STRING, n INT")
    assert rows(op.needs_hydration(df, store, order_cols=["n"]).select("id", "t")) == [(3, "b"), (4, "d"), (9, "c")]
    assert rows(op.cache_hit_rate(op.tweet_hydration_status(ids(spark, 1, 2, 4, 9), store))) == [(4, 2, 2, 1)]


def test_batches(spark, store):
    wanted = ids(spark, *range(1, 251))
    got = op.missing_ids_batched(wanted, store, "id").collect()
    assert len(got) == 250 and {r.id for r in got if not r.missing} == {1, 2}
    assert all(r.batch_no == (r.id - 1) // 100 for r in got)


def test_get_and_limit(spark, store, rows):
    assert rows(op.get_by_ids(store, ids(spark, 1))) == [(1, "Tweet 1", "FULL")]
    assert op.get_by_ids(store, ids(spark, 1), ["id", "text"]).columns == ["id", "text"]
    assert rows(op.read_limited(store, ["id"], 1)) == [(1, "Tweet 1", "FULL")]
    assert op.read_limited(store, ["id"], None).count() == 5
    with pytest.raises(TypeError):
        op.get_by_ids(store, store.select("text"))


def test_users(spark, rows):
    posts = spark.createDataFrame([("a",), ("b",), ("b",), ("z",)], "username STRING")
    done = spark.createDataFrame([("a",)], "username STRING")
    profiles = spark.createDataFrame([(2, "b", 0), (2, "b", 1), (1, "a", 2)], "id LONG, username STRING, n INT")
    assert rows(op.unseen_users(posts, done, profiles, order_cols=["n"])) == [(2, "b", 0)]
    users = spark.createDataFrame([("a",), ("q",), ("q",)], "username STRING")
    assert rows(op.suspended_profiles(users, posts)) == [("a", False), ("q", True)]


def test_enrichment(spark, store, rows):
    batch = spark.createDataFrame([(1, "new"), (111, "222")], "id LONG, text STRING")
    out = op.enrich_nodes(store, batch, "Tweet")
    assert rows(out.where(F.col("id").isin(1, 2, 111))) == [
        (1, "new", "FULL"), (111, "222", None), (2, "Tweet 2", "FULL")]
    wide = batch.withColumn("new_prop", F.lit(7))
    with pytest.raises(ValueError, match="new_prop"):
        op.enrich_nodes(store, wide, "Tweet")
    grown = op.enrich_nodes(store, wide, "Tweet", allow_new_columns=True)
    assert grown.where("id = 1").first().new_prop == 7 and grown.where("id = 2").first().new_prop is None
    cleared = op.enrich_nodes(store, spark.createDataFrame([(1, None)], "id LONG, text STRING"), "Tweet")
    assert cleared.where("id = 1").first().text is None
    with pytest.raises(TypeError):
        op.enrich_nodes(store, batch, "Post")
    with pytest.raises(TypeError):
        op.enrich_nodes(store, [{"id": 1}], "Tweet")


def posts(spark, *given):
    """Flat posts: (status_id, text, reply, quoted, shared, user)."""
    return spark.createDataFrame(
        list(given), "status_id LONG, full_text STRING, in_reply_to_status_id LONG, quoted_status_id LONG, "
        "retweet_id LONG, user_id LONG",
    ).withColumns({"created_at": F.lit("2024-01-01 00:00:00").cast("timestamp"), "user_name": F.lit("n")})


def test_upsert_and_stubs(spark):
    first = op.graph_rows(posts(spark, (1, "one", 0, 0, 0, 7), (2, "two", 99, 0, 0, 7), (3, "q", 0, 1, 0, 8)), "job")
    empty = empty_store(TWEETS, spark)
    nodes = op.stub_tweets(op.upsert_tweets(empty, first, NOW, ["tweet_id"]), first, NOW)
    got = {r.id: r for r in nodes.collect()}
    assert set(got) == {1, 2, 3, 99}
    assert (got[99].hydrated, got[99].text, got[1].hydrated, got[2].type) == ("PARTIAL", None, "FULL", "REPLY")
    assert got[1].record_updated_at is None

    second = op.graph_rows(posts(spark, (1, "one again", 0, 0, 0, 7), (99, "was a stub", 0, 0, 0, 5)), "next")
    second = second.withColumn("tweet_created_at", F.lit("2024-03-03 00:00:00").cast("timestamp"))
    later = {r.id: r for r in op.upsert_tweets(nodes, second, LATER, ["tweet_id"]).collect()}
    assert set(later) == {1, 2, 3, 99}
    assert (later[1].text, str(later[1].created_at)[:4], str(later[1].created_at)[5:7]) == ("one again", "2024", "01")
    assert str(later[1].record_updated_at) == LATER and str(later[1].record_created_at) == NOW
    assert (later[99].hydrated, str(later[99].created_at)[5:7], later[99].text) == ("FULL", "03", "was a stub")
    assert later[2].record_updated_at is None
    stubs = op.stub_tweets(op.upsert_tweets(nodes, second, LATER, ["tweet_id"]), first, LATER)
    assert stubs.count() == 4 and stubs.where("hydrated = 'PARTIAL'").count() == 0


def test_repeating_an_upsert_changes_only_the_stamp(spark, rows):
    batch = op.graph_rows(posts(spark, (1, "one", 0, 0, 0, 7), (2, "two", 1, 0, 0, 7)), "job")
    once = op.upsert_tweets(empty_store(TWEETS, spark), batch, NOW, ["tweet_id"])
    twice = op.upsert_tweets(once, batch, NOW, ["tweet_id"])
    assert rows(once.drop("record_updated_at")) == rows(twice.drop("record_updated_at"))


def test_edges(spark, rows):
    batch = op.graph_rows(posts(
        spark, (1, "a", 0, 0, 0, 7), (2, "b", 1, 0, 0, 7), (3, "c", 0, 2, 0, 8), (4, "d", 0, 0, 50, 8),
        (5, "e", 60, 0, 0, 9), (2, "b", 1, 0, 0, 7)), "job")
    tweets = ids(spark, 1, 2, 3, 4, 5, 50)
    assert rows(op.edges_replied(batch, tweets)) == [(2, 1, "REPLIED")]
    assert rows(op.edges_quoted(batch, tweets)) == [(3, 2, "QUOTED")]
    assert rows(op.edges_retweeted(batch, tweets)) == [(4, 50, "RETWEETED")]
    assert rows(op.resolve_relationships(batch, tweets, ids(spark, 7, 8))) == [
        (2, 1, "REPLIED"), (3, 2, "QUOTED"), (4, 50, "RETWEETED"),
        (7, 1, "TWEETED"), (7, 2, "TWEETED"), (8, 3, "TWEETED"), (8, 4, "TWEETED")]


def test_social_graph_of_scraped_and_archived_posts(spark, rows):
    p = posts(spark, (1, "a", 0, 0, 0, 7), (2, "b", 1, 0, 0, 8), (3, "c", 40, 0, 0, 8)).withColumns({
        "user_mentions": F.array(F.struct(F.lit(8).cast("bigint").alias("id"), F.lit("x").alias("screen_name"))),
        "urls": F.array(F.struct(F.lit("http://u/").alias("expanded_url"))),
    })
    nodes, edges = plans.build_social_graph(p, NOW)
    assert rows(nodes.drop("record_created_at")) == [
        ("Account", "7", "FULL"), ("Account", "8", "FULL"), ("Tweet", "1", "FULL"), ("Tweet", "2", "FULL"),
        ("Tweet", "3", "FULL"), ("Tweet", "40", "PARTIAL"), ("Url", "http://u/", None)]
    assert edges.where("rel = 'REPLIED'").count() == 2 and edges.where("rel = 'MENTIONED'").count() == 3
    scraped = p.withColumns({"user_mentions": F.array(F.lit("@k")), "urls": F.array().cast("array<string>")})
    assert rows(plans.build_social_graph(scraped, NOW)[0].where("label = 'Account' and hydrated = 'PARTIAL'")
                .select("node_key")) == [("@k",)]


def test_mentioned_accounts_and_urls(spark, rows):
    known = ids(spark, 1)
    accounts = spark.createDataFrame([(7, "seven", "FULL", None)],
                                     "id LONG, name STRING, hydrated STRING, record_created_at TIMESTAMP")
    m = spark.createDataFrame(
        [(1, 7, "x", "@x"), (1, 8, "y", "@y"), (1, 8, "y", "@y"), (2, 9, "z", "@z"), (1, None, "w", "@w")],
        "tweet_id LONG, user_id LONG, user_name STRING, user_screen_name STRING",
    ).withColumns({"job_name": F.lit("j"), "job_id": F.lit("i")})
    out = op.upsert_mentioned_accounts(accounts, m, known, NOW)
    assert rows(out.select("id", "name", "hydrated")) == [(7, "seven", "FULL"), (8, "y", "PARTIAL")]
    assert rows(op.edges_mentioned(m, known)) == [(1, "7", "MENTIONED"), (1, "8", "MENTIONED"), (1, "@w", "MENTIONED")]


def test_merges(spark, rows):
    store = spark.createDataFrame([("a", None, NOW, None), ("b", 1, NOW, None)],
                                  "name STRING, n INT, record_created_at STRING, record_updated_at STRING")
    store = store.withColumns({c: F.col(c).cast("timestamp") for c in ("record_created_at", "record_updated_at")})
    batch = spark.createDataFrame([("a", None), ("a", 2), ("a", 2)], "name STRING, n INT")
    got = {(r.name, r.n): (str(r.record_created_at), str(r.record_updated_at))
           for r in op.merge_nodes(store, batch, LATER).collect()}
    assert got == {("a", None): (NOW, LATER), ("b", 1): (NOW, "None"), ("a", 2): (LATER, "None")}
    edges = spark.createDataFrame([(1, 2, "R")], "from_id LONG, to_id LONG, rel STRING")
    more = spark.createDataFrame([(1, 2), (2, 1), (2, 1)], "from_id LONG, to_id LONG")
    assert rows(op.merge_edges(edges, more, "R")) == [(1, 2, "R"), (2, 1, "R")]


def test_edge_ids(spark, rows):
    nodes = spark.createDataFrame([("Drug", "x", 1), ("Synonym", "x", 2), ("Study", "s", 3)],
                                  "label STRING, name STRING, id LONG")
    edges = spark.createDataFrame([("Drug", "x", "Study", "s"), ("Synonym", "x", "Study", "s")],
                                  "src_label STRING, src STRING, dst_label STRING, dst STRING")
    assert rows(op.resolve_edge_ids(edges, nodes)) == [(1, 3), (2, 3)]
    bad = edges.unionAll(spark.createDataFrame([("Drug", "nobody", "Study", "s")], edges.schema))
    assert rows(unresolved_edges(bad, nodes).select("src")) == [("nobody",)]
    assert op.resolve_edge_ids(bad, nodes, "drop").count() == 2
    with pytest.raises(Exception, match="nobody"):
        op.resolve_edge_ids(bad, nodes).collect()


def test_drug_graph(spark, rows):
    vocab = spark.createDataFrame(
        [(1, " Aspirin", "ASA|Aspirin|ab|acetyl (x)"), (2, "Heparin", None), (3, "aspirin", "Salicyl|asa "),
         (4, "asa", "aspirin")],
        "row_no INT, `Common name` STRING, Synonyms STRING",
    )
    words = op.split_synonyms(vocab, "Common name", "Synonyms")
    assert {r.row_no: r.synonyms for r in words.collect()} == {
        1: ["asa", "acetyl (x)"], 2: None, 3: ["salicyl", "asa"], 4: ["aspirin"]}

    def study(i, arms=None, title=None):
        return (({"IdentificationModule": {"NCTId": i, "BriefTitle": "brief", "OfficialTitle": title},
                  "ArmsInterventionsModule": arms and {"ArmGroupList": {"ArmGroup": [
                      {"ArmGroupInterventionList": {"ArmGroupInterventionName": arms}}]}},
                  "DesignModule": None},),)

    from tidemark.schemas import TRIAL_SCHEMA
    pages = spark.createDataFrame(
        [((3, [(study("N1", ["Drug: ASA 5", "x"], "official"),)[0], study("N2"), study("N1", ["later"])]),)],
        TRIAL_SCHEMA)
    flat = {(r.trial_id, r.intervention): r for r in op.flatten_trials(pages).collect()}
    assert flat["N1", "Drug: ASA 5"].public_title == "official"
    assert flat["N2", ""].public_title == "brief" and flat["N2", ""].target_size == ""

    intl = op.normalize_headers(spark.createDataFrame(
        [("N2", "aspirin", "t", "http://i/2", "9", "p"), ("I3", "heparin-based", "t", "http://i/3", None, "p")],
        "TrialID STRING, Intervention STRING, `Study type` STRING, `web address` STRING, `Target size` STRING, "
        "`Public title` STRING"))
    studies = {r.trial_id: r for r in plans.all_studies(pages, intl).collect()}
    assert set(studies) == {"N1", "N2", "I3"}
    assert studies["N2"].intervention == "" and studies["I3"].target_size == ""
    nodes, edges = plans.build_drug_graph(vocab, pages, intl)
    linked = rows(edges.where("rel = 'APPEARED_IN'").select("src_label", "src", "dst"))
    assert linked in ([("Drug", "asa", "N1"), ("Drug", "heparin", "I3"), ("Synonym", "asa", "N1")],
                      [("Drug", "heparin", "I3")])
    assert rows(edges.where("rel = 'KNOWN_AS'").select("src", "dst")) == [
        ("asa", "aspirin"), ("aspirin", "asa"), ("aspirin", "salicyl")]
    assert nodes.where("label = 'Drug'").count() == 3


def test_unions(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k LONG, a STRING")
    b = spark.createDataFrame([(1, 5), (2, None)], "k LONG, b INT")
    assert rows(op.union_by_name_fill(a, b, "k", "k")) == [("1", "x", ""), ("2", "", "")]
    assert op.concat_same_schema(a, a).count() == 2
    with pytest.raises(ValueError, match="schemas differ"):
        op.concat_same_schema(a, b)
    assert rows(op.terms_union_all(a.select("a"), a.select("a"))) == [("x",), ("x",)]
    assert rows(op.page_ranges(spark.createDataFrame([(0,), (1,), (101,), (200,)], "n LONG"), "n")) == [
        (1, 1, 100), (101, 1, 100), (101, 101, 200), (200, 1, 100), (200, 101, 200)]


def test_stub_takes_name_and_id_of_one_job(spark):
    rows = [(1, 9, "a", "z"), (2, 9, "b", "y")]
    batch = spark.createDataFrame(rows, "tweet_id LONG, reply_tweet_id LONG, job_name STRING, job_id STRING").selectExpr(
        "*", "'REPLY' AS tweet_type", "CAST(NULL AS BIGINT) AS quoted_status_id", "CAST(NULL AS BIGINT) AS retweet_id")
    stub = op.stub_tweets(empty_store(TWEETS, spark), batch, NOW).first()
    assert (stub.id, stub.job_name, stub.job_id) == (9, "a", "z")


def test_release_empties_the_working_folder(spark):
    from tidemark.session import materialize, release, work_root

    made = materialize(spark.range(5).toDF("n"), "scratch")
    assert made.count() == 5
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work_root(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert fs.exists(path)
    release(spark)
    assert not fs.exists(path)
