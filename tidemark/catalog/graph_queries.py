"""Upserts, edges, and whole graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from .. import operators as op
from .. import plans, sources, streaming
from .registry import query
from .views import AS_OF, AS_OF_SQL, Views, guard, with_views

_TWEET = ["id", "text", "created_at", "favorite_count", "retweet_count", "job_name", "job_id",
          "hashtags", "type", "hydrated", "record_created_at", "record_updated_at"]
_OLD = "TIMESTAMP '2023-01-01 00:00:00'"


def _old() -> F.Column:
    return F.lit("2023-01-01 00:00:00").cast("timestamp")


def _us(name: str) -> F.Column:
    return F.unix_micros(name).alias(name.replace("_at", "_us"))


UPSERT_SQL = f"""
    SELECT COALESCE(s.doc_id, b.doc_id) AS id,
           CASE WHEN b.doc_id IS NULL THEN s.lang ELSE 'q' || b.quality END AS text,
           epoch_us(CASE WHEN s.doc_id IS NULL THEN {AS_OF_SQL} ELSE {_OLD} END) AS created_us,
           CASE WHEN b.doc_id IS NULL THEN 'PARTIAL' ELSE 'FULL' END AS hydrated,
           CASE WHEN b.doc_id IS NULL THEN 'old' ELSE 'new' END AS job_name,
           epoch_us(CASE WHEN s.doc_id IS NULL THEN {AS_OF_SQL} ELSE {_OLD} END) AS record_created_us,
           CASE WHEN s.doc_id IS NOT NULL AND b.doc_id IS NOT NULL THEN epoch_us({AS_OF_SQL}) END
             AS record_updated_us
    FROM (SELECT * FROM documents WHERE lang = 'en') s FULL JOIN labels b ON s.doc_id = b.doc_id"""


def tweet_store(v: Views) -> DataFrame:
    """English documents as stored posts."""
    none = F.lit(None)
    return v.table("documents").where(F.col("lang") == "en").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("text"), _old().alias("created_at"),
        F.lit(0).cast("bigint").alias("favorite_count"), F.lit(0).cast("bigint").alias("retweet_count"),
        F.lit("old").alias("job_name"), none.cast("string").alias("job_id"),
        none.cast("string").alias("hashtags"), F.lit("TWEET").alias("type"),
        F.lit("PARTIAL").alias("hydrated"), _old().alias("record_created_at"),
        none.cast("timestamp").alias("record_updated_at"),
    )


def tweet_batch(v: Views) -> DataFrame:
    """Labels as incoming posts, each twice; the later one counts."""
    none = F.lit(None)
    once = v.table("labels").select(
        F.col("doc_id").alias("tweet_id"), F.concat(F.lit("q"), "quality").alias("text"),
        F.lit(AS_OF).cast("timestamp").alias("tweet_created_at"),
        F.col("toxic").cast("bigint").alias("favorite_count"), F.lit(1).cast("bigint").alias("retweet_count"),
        F.lit("new").alias("job_name"), none.cast("string").alias("job_id"),
        none.cast("string").alias("hashtags"), F.lit("TWEET").alias("tweet_type"), F.lit(1).alias("seq"),
    )
    return once.unionByName(once.withColumns({"text": F.lit("earlier"), "seq": F.lit(0)}))


def tweet_columns(tweets: DataFrame) -> DataFrame:
    return tweets.select(
        "id", "text", _us("created_at"), "hydrated", "job_name", _us("record_created_at"), _us("record_updated_at"))


@query("upsert_tweets", UPSERT_SQL)
def _(v: Views) -> DataFrame:
    return tweet_columns(op.upsert_tweets(tweet_store(v), tweet_batch(v), AS_OF, ["seq"]))


@query("upsert_accounts", f"""
    SELECT COALESCE(c.c_custkey, o.o_custkey) AS id,
           CASE WHEN o.o_custkey IS NULL THEN c.c_name ELSE 'customer ' || o.o_custkey END AS name,
           CASE WHEN o.o_custkey IS NULL THEN CAST(c.c_nationkey AS BIGINT) ELSE o.n END AS followers_count,
           c.c_mktsegment AS note, CASE WHEN o.o_custkey IS NULL THEN 'PARTIAL' ELSE 'FULL' END AS hydrated,
           CASE WHEN c.c_custkey IS NOT NULL AND o.o_custkey IS NOT NULL THEN epoch_us({AS_OF_SQL}) END
             AS record_updated_us
    FROM (SELECT * FROM customer WHERE c_nationkey <= 12) c
    FULL JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_totalprice > 300000 GROUP BY 1) o
      ON c.c_custkey = o.o_custkey""")
def _(v: Views) -> DataFrame:
    none = F.lit(None)
    store = v.table("customer").where(F.col("c_nationkey") <= 12).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("bigint").alias("followers_count"), F.col("c_mktsegment").alias("note"),
        F.lit("PARTIAL").alias("hydrated"), _old().alias("record_created_at"),
        none.cast("timestamp").alias("record_updated_at"),
    )
    counts = v.table("orders").where(F.col("o_totalprice") > 300000).groupBy(
        F.col("o_custkey").alias("user_id")).agg(F.count("*").alias("user_followers_count"))
    batch = counts.select(
        "user_id", F.concat(F.lit("customer "), "user_id").alias("user_name"),
        none.cast("string").alias("user_screen_name"), "user_followers_count",
        none.cast("bigint").alias("user_friends_count"), none.cast("string").alias("user_location"),
        none.cast("string").alias("user_profile_image_url"), none.cast("timestamp").alias("user_created_at"),
        F.lit("job").alias("job_name"), none.cast("string").alias("job_id"),
    )
    return op.upsert_accounts(store, batch, AS_OF, ["user_followers_count"]).select(
        "id", "name", "followers_count", "note", "hydrated", _us("record_updated_at")
    )


def _long_posts(v: Views) -> DataFrame:
    return v.posts().where(F.length("full_text") > 100).select(
        F.col("status_id").alias("id"), F.lit("FULL").alias("hydrated"),
        F.lit(None).cast("timestamp").alias("record_created_at"), F.lit("old").alias("job_name"),
    )


@query("stub_tweets", with_views("posts", f"""
    SELECT status_id AS id, 'FULL' AS hydrated, 'old' AS job_name, CAST(NULL AS BIGINT) AS record_created_us
    FROM posts WHERE length(full_text) > 100
    UNION ALL
    SELECT DISTINCT reply_to, 'PARTIAL', 'posts', epoch_us({AS_OF_SQL}) FROM posts
    WHERE reply_to > 0 AND reply_to NOT IN (SELECT status_id FROM posts WHERE length(full_text) > 100)"""))
def _(v: Views) -> DataFrame:
    return op.stub_tweets(_long_posts(v), v.post_rows(), AS_OF).select(
        "id", "hydrated", "job_name", _us("record_created_at")
    )


def _finished_orders(v: Views) -> DataFrame:
    return v.table("orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("id"))


@query("upsert_mentioned_accounts", f"""
    SELECT s_suppkey AS id, s_name AS name, 'FULL' AS hydrated, CAST(NULL AS BIGINT) AS record_created_us
    FROM supplier WHERE s_nationkey < 12
    UNION ALL
    SELECT DISTINCT l_suppkey, 's' || l_suppkey, 'PARTIAL', epoch_us({AS_OF_SQL})
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE o_orderstatus = 'F' AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12)""")
def _(v: Views) -> DataFrame:
    accounts = v.table("supplier").where(F.col("s_nationkey") < 12).select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("FULL").alias("hydrated"),
        F.lit(None).cast("timestamp").alias("record_created_at"),
    )
    return op.upsert_mentioned_accounts(accounts, v.order_mentions(), _finished_orders(v), AS_OF).select(
        "id", "name", "hydrated", _us("record_created_at")
    )


@query("upsert_urls", with_views("page_parts", f"""
    SELECT url AS full_url, CASE WHEN scheme = 'https' THEN 'kept' ELSE address END AS hostname,
           CASE WHEN scheme = 'https' THEN NULL ELSE scheme END AS "schema",
           CASE WHEN scheme = 'https' THEN NULL ELSE epoch_us({AS_OF_SQL}) END AS record_created_us
    FROM page_parts"""))
def _(v: Views) -> DataFrame:
    store = v.table("pages").where(F.col("url").startswith("https:")).select(
        F.col("url").alias("full_url"), F.lit("kept").alias("hostname"),
        F.lit(None).cast("string").alias("schema"), F.lit(None).cast("timestamp").alias("record_created_at"),
    )
    urls = op.explode_urls(v.page_urls(), "job")
    posts = v.table("documents").select(F.col("doc_id").alias("id"))
    again = urls.withColumns({"tweet_id": F.col("tweet_id") + 1, "hostname": F.lit("later")})
    return op.upsert_urls(store, urls.unionByName(again), posts, AS_OF).select(
        "full_url", "hostname", "schema", _us("record_created_at")
    )


@query("edges_tweeted", "SELECT DISTINCT user_id AS src_id, event_id AS dst_id, 'TWEETED' AS rel FROM events")
def _(v: Views) -> DataFrame:
    return op.edges_tweeted(v.ev_edges())


@query("edges_replied", with_views("posts", """
    SELECT status_id AS src_id, reply_to AS dst_id, 'REPLIED' AS rel FROM posts
    WHERE reply_to IN (SELECT status_id FROM posts WHERE length(full_text) > 100)"""))
def _(v: Views) -> DataFrame:
    return op.edges_replied(v.post_rows(), _long_posts(v))


def _known_events(v: Views) -> DataFrame:
    return v.ev().where(F.col("event_type") != "view").select(F.col("event_id").alias("id"))


def _event_edge_sql(kind: str, rel: str) -> str:
    return f"""
        SELECT event_id AS src_id, event_id - 1 AS dst_id, '{rel}' AS rel FROM events
        WHERE event_type = '{kind}' AND event_id > 1
          AND event_id - 1 IN (SELECT event_id FROM events WHERE event_type <> 'view')"""


@query("edges_quoted", _event_edge_sql("error", "QUOTED"))
def _(v: Views) -> DataFrame:
    return op.edges_quoted(v.ev_edges(), _known_events(v))


@query("edges_retweeted", _event_edge_sql("click", "RETWEETED"))
def _(v: Views) -> DataFrame:
    return op.edges_retweeted(v.ev_edges(), _known_events(v))


@query("resolve_relationships", with_views("posts", """
    , known AS (SELECT * FROM posts WHERE length(full_text) > 100),
    mine AS (SELECT * FROM known WHERE user_name <> 'system')
    SELECT length(user_name) AS src_id, status_id AS dst_id, 'TWEETED' AS rel FROM mine
    UNION
    SELECT status_id, reply_to, 'REPLIED' FROM mine WHERE reply_to IN (SELECT status_id FROM known)"""))
def _(v: Views) -> DataFrame:
    accounts = v.posts().where(F.col("user_name") != "system").select(
        F.length("user_name").cast("bigint").alias("id")).distinct()
    return op.resolve_relationships(v.post_rows(), _long_posts(v), accounts)


@query("edges_mentioned", with_views("mentions", """
    SELECT DISTINCT status_id AS src_id, unnest(user_mentions) AS dst_key, 'MENTIONED' AS rel FROM mentions"""))
def _(v: Views) -> DataFrame:
    rows = v.mentions().select(
        F.col("status_id").alias("tweet_id"), F.explode("user_mentions").alias("user_screen_name")
    )
    return op.edges_mentioned(rows, v.table("documents").select(F.col("doc_id").alias("id")))


@query("edges_includes", """
    SELECT page_id AS src_id, url AS dst_key, 'INCLUDES' AS rel FROM pages
    WHERE page_id IN (SELECT doc_id FROM documents WHERE lang = 'en')""")
def _(v: Views) -> DataFrame:
    urls = op.explode_urls(v.page_urls())
    posts = v.table("documents").where(F.col("lang") == "en").select(F.col("doc_id").alias("id"))
    return op.edges_includes(urls.unionAll(urls), posts)


@query("enrich_nodes", """
    SELECT COALESCE(d.doc_id, l.doc_id) AS id, CASE WHEN l.doc_id IS NULL THEN d.lang ELSE 'seen' END AS text,
           d.source, l.quality
    FROM (SELECT * FROM documents WHERE lang <> 'de') d FULL JOIN labels l ON d.doc_id = l.doc_id""")
def _(v: Views) -> DataFrame:
    store = v.table("documents").where(F.col("lang") != "de").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("text"), "source"
    )
    batch = v.table("labels").select(F.col("doc_id").alias("id"), F.lit("seen").alias("text"), "quality")
    return op.enrich_nodes(store, batch, "Tweet", allow_new_columns=True)


MERGE_NODES_SQL = f"""
    SELECT p_brand, p_type, epoch_us(CASE WHEN bool_or(p_size <= 5) THEN {_OLD} ELSE {AS_OF_SQL} END)
             AS record_created_us,
           CASE WHEN bool_or(p_size <= 5) AND bool_or(p_size > 3) THEN epoch_us({AS_OF_SQL}) END
             AS record_updated_us
    FROM part GROUP BY ALL"""


def node_store(v: Views) -> DataFrame:
    return v.table("part").where(F.col("p_size") <= 5).select("p_brand", "p_type").distinct().withColumns({
        "record_created_at": _old(), "record_updated_at": F.lit(None).cast("timestamp"),
    })


@query("merge_nodes", MERGE_NODES_SQL)
def _(v: Views) -> DataFrame:
    return op.merge_nodes(node_store(v), v.table("part").where(F.col("p_size") > 3), AS_OF).select(
        "p_brand", "p_type", _us("record_created_at"), _us("record_updated_at")
    )


MERGE_EDGES_SQL = """
    SELECT DISTINCT l_partkey AS from_id, l_suppkey AS to_id, 'SUPPLIED_BY' AS rel FROM lineitem"""


def edge_rows(v: Views) -> tuple[DataFrame, DataFrame]:
    """Stored edges, and a batch that holds them again."""
    rows = v.table("lineitem").select(F.col("l_partkey").alias("from_id"), F.col("l_suppkey").alias("to_id"),
                                      "l_returnflag")
    store = rows.where(F.col("l_returnflag") == "R").select(
        "from_id", "to_id", F.lit("SUPPLIED_BY").alias("rel")).distinct()
    return store, rows


@query("merge_edges", MERGE_EDGES_SQL)
def _(v: Views) -> DataFrame:
    return op.merge_edges(*edge_rows(v), "SUPPLIED_BY")


@query("resolve_edge_ids", """
    SELECT p.p_partkey, n.id AS from_id, t.id AS to_id FROM part p
    JOIN (SELECT p_name, min(p_partkey) AS id FROM part GROUP BY 1) n ON p.p_name = n.p_name
    JOIN (SELECT p_type, -max(p_partkey) AS id FROM part GROUP BY 1) t ON p.p_type = t.p_type""")
def _(v: Views) -> DataFrame:
    part = v.table("part")
    drugs = part.groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))
    kinds = part.groupBy(F.col("p_type").alias("name")).agg((-F.max("p_partkey")).alias("id"))
    nodes = drugs.withColumn("label", F.lit("Drug")).unionByName(kinds.withColumn("label", F.lit("Synonym")))
    edges = part.select(
        "p_partkey", F.lit("Drug").alias("src_label"), F.col("p_name").alias("src"),
        F.lit("Synonym").alias("dst_label"), F.col("p_type").alias("dst"),
    )
    return op.resolve_edge_ids(edges, nodes)


@query("build_drug_graph", with_views("studies all_studies", rf"""
    , words AS (
        SELECT lower(p_name) AS name, arg_max(lower(p_brand), p_partkey) AS brand,
               lower(regexp_extract(p_name, '\S+$')) AS noun FROM part GROUP BY p_name),
    known AS (SELECT name AS drug, unnest([brand, noun]) AS synonym FROM words),
    synonyms AS (SELECT * FROM known WHERE synonym <> drug AND length(synonym) >= 3),
    terms AS (SELECT 'Drug' AS label, name FROM words UNION SELECT 'Synonym', synonym FROM synonyms),
    texts AS (SELECT DISTINCT intervention FROM all_studies),
    found AS (SELECT label, name, intervention FROM terms
              JOIN texts ON {guard('name', 'lower(intervention)')})
    SELECT 'edge' AS kind, 'KNOWN_AS' AS rel, 'Drug' AS src_label, drug AS src, 'Synonym' AS dst_label, synonym AS dst FROM synonyms
    UNION
    SELECT 'edge', 'APPEARED_IN', label, name, 'Study', trial_id FROM found JOIN all_studies USING (intervention)
    UNION
    SELECT 'edge', 'POINTS_AT', 'Url', study_url, 'Study', trial_id FROM all_studies
    UNION
    SELECT 'node', NULL, label, name, NULL, NULL FROM (
        SELECT * FROM terms UNION SELECT 'Study', trial_id FROM all_studies UNION SELECT 'Url', study_url FROM all_studies)"""))
def _(v: Views) -> DataFrame:
    """Vocabulary, national and international studies as nodes and edges."""
    nodes, edges = plans.build_drug_graph(v.drug_words(), v.trials(), v.intl())
    none = F.lit(None).cast("string")
    named = nodes.select(F.lit("node").alias("kind"), none.alias("rel"), F.col("label").alias("src_label"), F.col("name").alias("src"),
                         none.alias("dst_label"), none.alias("dst"))
    return edges.select(F.lit("edge").alias("kind"), "rel", "src_label", "src", "dst_label", "dst").unionByName(named)


@query("build_social_graph", with_views("posts mentions", """
    , p AS (
        SELECT status_id AS id, length(user_name) AS author, reply_to AS target,
               [] AS mentioned, [] AS links FROM posts
        UNION ALL
        SELECT -1 - m.status_id, d.n_chars % 50, 0, m.user_mentions,
               CASE WHEN g.url IS NULL THEN [] ELSE [g.url] END
        FROM mentions m JOIN documents d ON m.status_id = d.doc_id
        LEFT JOIN pages g ON g.page_id = m.status_id),
    edges AS (
        SELECT 'TWEETED' AS a, CAST(author AS VARCHAR) AS b, CAST(id AS VARCHAR) AS c FROM p
        UNION SELECT 'REPLIED', CAST(id AS VARCHAR), CAST(target AS VARCHAR) FROM p WHERE target > 0
        UNION SELECT 'MENTIONED', CAST(id AS VARCHAR), unnest(mentioned) FROM p
        UNION SELECT 'INCLUDES', CAST(id AS VARCHAR), unnest(links) FROM p),
    nodes AS (
        SELECT label, node_key, min(hydrated) AS hydrated FROM (
            SELECT 'Tweet' AS label, CAST(id AS VARCHAR) AS node_key, 'FULL' AS hydrated FROM p
            UNION ALL SELECT 'Account', CAST(author AS VARCHAR), 'FULL' FROM p
            UNION ALL SELECT 'Tweet', CAST(target AS VARCHAR), 'PARTIAL' FROM p WHERE target > 0
            UNION ALL SELECT 'Account', unnest(mentioned), 'PARTIAL' FROM p
            UNION ALL SELECT 'Url', unnest(links), NULL FROM p) GROUP BY 1, 2)
    SELECT 'edge' AS kind, a, b, c FROM edges
    UNION ALL SELECT 'node', label, node_key, hydrated FROM nodes"""))
def social_graph(v: Views) -> DataFrame:
    """Conversations and documents, with mentions and page links, as one graph."""
    none = F.array().cast("array<string>")
    talks = v.posts().select(
        "status_id", F.length("user_name").cast("bigint").alias("user_id"),
        F.col("reply_to").alias("in_reply_to_status_id"), none.alias("user_mentions"), none.alias("urls"),
    )
    docs = v.table("documents").join(
        v.table("pages").select(F.col("page_id").alias("doc_id"), "url"), "doc_id", "left"
    ).select(
        (-1 - F.col("doc_id")).alias("status_id"), (F.col("n_chars") % 50).alias("user_id"),
        F.lit(0).cast("bigint").alias("in_reply_to_status_id"),
        fn.extract_mentions(F.col("text")).alias("user_mentions"),
        F.array_compact(F.array("url")).alias("urls"),
    )
    nodes, edges = plans.build_social_graph(talks.unionByName(docs), AS_OF)
    return edges.select(
        F.lit("edge").alias("kind"), F.col("rel").alias("a"), F.col("src").alias("b"), F.col("dst").alias("c")
    ).unionAll(nodes.select(F.lit("node"), "label", "node_key", "hydrated"))


_STAMPS = {"hydrated": "string", "record_created_at": "timestamp", "record_updated_at": "timestamp"}
_STORES = {
    "tweets": {
        "id": "bigint", "text": "string", "created_at": "timestamp", "favorite_count": "bigint", "retweet_count": "bigint",
        "job_name": "string", "job_id": "string", "hashtags": "string", "type": "string", "geo": "string",
        "ingest_method": "string", **_STAMPS},
    "accounts": {"id": "bigint", "name": "string", "screen_name": "string", "job_name": "string", "job_id": "string", **_STAMPS},
    "urls": {"full_url": "string", "hostname": "string", "path": "string", "job_name": "string", **_STAMPS},
    "edges": {"rel": "string", "src": "string", "dst": "string"},
}


_GRAPH_SQL = with_views("posts", f"""
    , p AS (
        SELECT *, (conversation_id // 1000) % 3 = 0 AS in_first, status_id % 2 = 0 AS in_second, length(user_name) AS author
        FROM posts),
    b AS (SELECT * FROM p WHERE in_first OR in_second),
    stubs AS (SELECT DISTINCT reply_to AS id FROM b WHERE reply_to > 0 AND reply_to NOT IN (SELECT status_id FROM b)),
    people AS (
        SELECT author AS id, 'FULL' AS hydrated, user_name AS name, bool_or(in_first) AS early FROM b GROUP BY ALL
        UNION ALL SELECT 100 + author, 'PARTIAL', 'm', bool_or(in_first) FROM b GROUP BY ALL),
    made AS (
        SELECT 'Tweet' AS kind, CAST(status_id AS VARCHAR) AS a, 'FULL' AS b, 'place ' || status_id AS c, in_first AS early,
               in_first AND in_second AS again FROM b
        UNION ALL SELECT 'Tweet', CAST(id AS VARCHAR), 'PARTIAL', NULL, FALSE, FALSE FROM stubs
        UNION ALL SELECT 'Account', CAST(id AS VARCHAR), hydrated, name, early, NULL FROM people
        UNION ALL SELECT 'Url', 'http://h/' || conversation_id, 'h', NULL, bool_or(in_first), NULL FROM b GROUP BY conversation_id)
    SELECT kind, a, b, c, CASE WHEN early THEN epoch_us({_OLD}) ELSE epoch_us({AS_OF_SQL}) END AS created_us, again FROM made
    UNION ALL SELECT 'TWEETED', CAST(author AS VARCHAR), CAST(status_id AS VARCHAR), NULL, NULL, NULL FROM b
    UNION ALL SELECT 'REPLIED', CAST(status_id AS VARCHAR), CAST(reply_to AS VARCHAR), NULL, NULL, NULL FROM b WHERE reply_to > 0
    UNION ALL SELECT 'MENTIONED', CAST(status_id AS VARCHAR), CAST(100 + author AS VARCHAR), NULL, NULL, NULL FROM b
    UNION ALL SELECT 'INCLUDES', CAST(status_id AS VARCHAR), 'http://h/' || conversation_id, NULL, NULL, NULL FROM b""")


def _graph_posts(v: Views) -> DataFrame:
    author = F.length("user_name").cast("bigint")
    return v.posts().select(
        "status_id", "conversation_id", "full_text", F.col("reply_to").alias("in_reply_to_status_id"), author.alias("user_id"),
        "user_name", F.concat(F.lit("place "), F.col("status_id").cast("string")).alias("geo"),
        F.array(F.struct((author + 100).alias("id"), F.lit("m").alias("name"), F.lit("@m").alias("screen_name"))).alias("user_mentions"),
        F.array(F.concat(F.lit("http://h/"), F.col("conversation_id").cast("string"))).alias("urls"))


# The second batch meets a third of the first one's posts again.
_FIRST, _SECOND = "floor(conversation_id / 1000) % 3 = 0", "status_id % 2 = 0"
_TIMES = ("2023-01-01 00:00:00", AS_OF)


def _batch_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return op.graph_rows(rows, "job", ingest_method="archive"), op.explode_mentions(rows, "job"), op.explode_urls(rows, "job")


@query("archive_to_graph", _GRAPH_SQL)
def archive_to_graph(v: Views) -> DataFrame:
    """Two overlapping batches of posts, one after the other, into a graph with all properties."""
    stores = {name: op.empty_store(columns, v.spark) for name, columns in _STORES.items()}
    flat = _graph_posts(v)
    for rows, as_of in zip((flat.where(_FIRST), flat.where(_SECOND)), _TIMES, strict=True):
        stores = plans.archive_to_graph(stores, *_batch_rows(rows), as_of, ["tweet_id"])
    return _graph_table(stores)


def _graph_store(v: Views, buckets: int = 16) -> sources.BucketStore:
    columns = {n: ", ".join(f"`{c}` {t}" for c, t in cols.items()) for n, cols in _STORES.items()}
    return sources.BucketStore(v.spark, v.new_path("graph"), {n: (ddl, plans.GRAPH_KEYS[n]) for n, ddl in columns.items()}, buckets)


@query("stream_archive_to_graph", _GRAPH_SQL)
def stream_archive_to_graph(v: Views) -> DataFrame:
    """The same two batches as micro-batches of a stream, into a store in buckets; the last one is sent twice."""
    feed, store = v.new_path("feed"), _graph_store(v)
    flat = _graph_posts(v)
    for rows in (flat.where(_FIRST), flat.where(_SECOND)):
        rows.coalesce(1).write.mode("append").parquet(feed)
    stream = v.spark.readStream.schema(flat.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    write = streaming.stream_archive_to_graph(store, _batch_rows, lambda n: _TIMES[n], ["tweet_id"])

    def twice(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        write(batch, batch_id)

    streaming.micro_batch_flush(stream, twice, v.new_path("progress")).awaitTermination()
    return _graph_table({n: store.read(n) for n in _STORES})


def _graph_table(stores: dict[str, DataFrame]) -> DataFrame:
    created, none = F.unix_micros("record_created_at").alias("created_us"), F.lit(None)
    text = lambda c: F.col(c).cast("string").alias("a")
    tweets = stores["tweets"].select(
        F.lit("Tweet").alias("kind"), text("id"), F.col("hydrated").alias("b"), F.col("geo").alias("c"), created,
        F.col("record_updated_at").isNotNull().alias("again"))
    accounts = stores["accounts"].select(
        F.lit("Account").alias("kind"), text("id"), F.col("hydrated").alias("b"), F.col("name").alias("c"), created,
        none.cast("boolean").alias("again"))
    urls = stores["urls"].select(
        F.lit("Url").alias("kind"), text("full_url"), F.col("hostname").alias("b"), none.cast("string").alias("c"), created,
        none.cast("boolean").alias("again"))
    edges = stores["edges"].select(
        F.col("rel").alias("kind"), text("src"), F.col("dst").alias("b"), none.cast("string").alias("c"),
        none.cast("bigint").alias("created_us"), none.cast("boolean").alias("again"))
    return tweets.unionByName(accounts).unionByName(urls).unionByName(edges)


@query("rehydrate", with_views("posts", "SELECT status_id, full_text FROM posts WHERE status_id % 3 <> 0"))
def rehydrate(v: Views) -> DataFrame:
    """Posts of a request that are not stored in full, flattened."""
    ids = v.posts().select(F.col("status_id").alias("id"))
    store = ids.where("id % 3 < 2").withColumn("hydrated", F.when(F.col("id") % 3 == 0, "FULL").otherwise("PARTIAL"))
    return plans.rehydrate(ids, store, v.raw_posts()).select("status_id", "full_text")
