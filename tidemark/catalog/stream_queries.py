"""Streaming queries, run over everything there is and then stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as op
from .. import sources, streaming
from .registry import query
from .views import AS_OF, AS_OF_SQL, Views, with_views


def _to_table(v: Views, stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream to its end into a table and read that."""
    path = v.new_path("table")
    streaming.micro_batch_flush(stream, streaming.overwrite_table(path), v.new_path("progress"), None, mode).awaitTermination()
    table = v.spark.read.parquet(path)
    return streaming.latest_batch(table) if mode == "complete" else table.drop("batch_id")


_HITS_SQL = """
    SELECT (epoch_us(ts) // {us}) * {us} AS t0_us, count(*) AS hits FROM events {where} GROUP BY 1"""


_PHRASES = ("the", "you", "is")
_MATCHED = " OR ".join(f"regexp_matches(lower(full_text), '(^|[^\\p{{L}}\\p{{N}}_]){p}($|[^\\p{{L}}\\p{{N}}_])')" for p in _PHRASES)


@query("live_window_search", with_views("timed_posts", f"""
    SELECT s // 30 * 30 * 1000000 AS t0_us, count(*) AS hits FROM timed_posts WHERE {_MATCHED} GROUP BY 1"""))
def _(v: Views) -> DataFrame:
    """Posts that hold a phrase, by half minute."""
    hits = streaming.live_window_search(v.timed_posts(v.stream("conversations")), "ts", "full_text", _PHRASES)
    return _to_table(v, hits, "complete").select(F.unix_micros("t0").alias("t0_us"), "hits")


@query("micro_batch_flush", "SELECT event_id, event_type FROM events")
def _(v: Views) -> DataFrame:
    return _to_table(v, v.ev_stream().select("event_id", "event_type"))


@query("stream_dedupe", "SELECT event_id, user_id FROM events")
def _(v: Views) -> DataFrame:
    twice = v.ev_stream().unionAll(v.ev_stream())
    return _to_table(v, streaming.stream_dedupe(twice, ["event_id"], "ts").select("event_id", "user_id"))


@query("stream_unseen_users", "SELECT DISTINCT user_id FROM events")
def _(v: Views) -> DataFrame:
    return _to_table(v, streaming.stream_unseen_users(v.ev_stream(), "user_id"))


@query("stream_hydration_filter", with_views("hyd", """
    SELECT event_id AS id, user_id FROM events
    WHERE event_id NOT IN (SELECT id FROM hyd WHERE hydrated = 'FULL')"""))
def _(v: Views) -> DataFrame:
    path = v.new_path("fresh")
    handle = streaming.stream_hydration_filter(
        v.stored, lambda df, i: sources.write_batch_table(df, path, i)
    )
    stream = v.ev_stream().select(F.col("event_id").alias("id"), "user_id")
    streaming.micro_batch_flush(stream, handle, v.new_path("progress")).awaitTermination()
    return v.spark.read.parquet(path).drop("batch_id")


@query("stream_backfill", _HITS_SQL.format(us=28_800_000_000, where=""))
def _(v: Views) -> DataFrame:
    path = v.new_path("history")
    streaming.stream_backfill(
        v.ev_stream(), "ts", "8 hours", streaming.overwrite_table(path), v.new_path("progress")
    ).awaitTermination()
    rows = streaming.latest_batch(v.spark.read.parquet(path))
    return rows.select(F.unix_micros("t0").alias("t0_us"), "hits")


@query("stream_graph_upsert", f"""
    SELECT user_id AS id, arg_max(event_type, event_id) AS type, 'FULL' AS hydrated,
           epoch_us({AS_OF_SQL}) AS record_created_us
    FROM events GROUP BY user_id""")
def _(v: Views) -> DataFrame:
    path = v.new_path("nodes")
    upsert = streaming.stream_graph_upsert(path, lambda batch_id: AS_OF, "id", ["event_id"])
    stream = v.ev_stream().select(F.col("user_id").alias("id"), "event_id", F.col("event_type").alias("type"))
    streaming.micro_batch_flush(stream, upsert, v.new_path("progress")).awaitTermination()
    nodes = streaming.read_nodes(v.spark.read.parquet(path))
    return nodes.select("id", "type", "hydrated", F.unix_micros("record_created_at").alias("record_created_us"))


@query("stream_graph_compact", f"""
    WITH e AS (SELECT *, event_id // ((SELECT max(event_id) FROM events) // 12 + 1) AS batch FROM events)
    SELECT user_id AS id, arg_max(event_type, event_id) AS type, arg_min(event_id, batch * 1000000000 + event_id) AS first_event,
           epoch_us({AS_OF_SQL}) + min(batch) AS record_created_us,
           CASE WHEN count(DISTINCT batch) > 1 THEN epoch_us({AS_OF_SQL}) + max(batch) END AS record_updated_us
    FROM e GROUP BY user_id""")
def _(v: Views) -> DataFrame:
    """Twelve batches of upserts, folded as they come; kept columns hold what the first batch of a node said."""
    feed, path = v.new_path("feed"), v.new_path("nodes")
    last = v.table("events").agg(F.max("event_id")).scalar()
    rows = v.ev().withColumn("batch", F.floor(F.col("event_id") / (F.floor(last / 12) + 1)))
    first = F.first_value("event_id").over(Window.partitionBy("batch", "user_id").orderBy("event_id"))
    rows = rows.select("batch", F.col("user_id").alias("id"), "event_id", F.col("event_type").alias("type"), first.alias("first_event"))
    for n in range(12):
        rows.where(F.col("batch") == n).drop("batch").coalesce(1).write.mode("append").parquet(feed)
    log = streaming.BatchLog(v.spark, path, "id", ("first_event",), fan=3)
    upsert = streaming.stream_graph_upsert(path, lambda n: f"2024-02-01 00:00:00.{n:06d}", "id", ["event_id"])

    def write(batch: DataFrame, number: int) -> None:
        upsert(batch, number)
        log.compact()

    stream = v.spark.readStream.schema(rows.drop("batch").schema).option("maxFilesPerTrigger", 1).parquet(feed)
    streaming.micro_batch_flush(stream, write, v.new_path("progress")).awaitTermination()
    return log.read().select("id", "type", "first_event", *[F.unix_micros(f"record_{w}_at").alias(f"record_{w}_us") for w in ("created", "updated")])


@query("count_or_age_flush", """
    WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
    SELECT event_type, flush_no, 'count' AS reason, 51 AS size FROM c, unnest(range(n // 51)) r(flush_no)
    UNION ALL SELECT event_type, n // 51, 'age', n % 51 FROM c WHERE n % 51 > 0""")
def _(v: Views) -> DataFrame:
    """Events of each type flushed above 50 rows; what is left at the end is flushed by its age."""
    path, progress = v.new_path("flushed"), v.new_path("progress")
    groups = streaming.count_or_age_groups(v.ev_stream().select("event_type", "event_id"), ["event_type"], 50, 1)
    sink = streaming.overwrite_table(path)
    streaming.flush_what_is_there(groups, sink, progress).awaitTermination()
    streaming.flush_rest(groups, sink, progress, 120)
    return v.spark.read.parquet(path).groupBy("event_type", "flush_no", "reason").agg(F.countDistinct("event_id").alias("size"))


@query("windows_and_late_rows", with_views("timed_posts", f"""
    , m AS (SELECT *, s // 30 * 30 AS t0, id % 1000 <= 2 AS early FROM timed_posts WHERE {_MATCHED}),
    w AS (SELECT max(s) FILTER (early) - 60 AS first, max(s) - 60 AS last FROM m),
    j AS (SELECT m.*, NOT early AND t0 + 30 <= first AS is_late, t0 + 30 <= last AS is_closed FROM m, w)
    SELECT 'late' AS kind, t0 * 1000000 AS t0_us, id, CAST(NULL AS BIGINT) AS hits FROM j WHERE is_late
    UNION ALL SELECT 'closed', t0 * 1000000, NULL, count(*) FROM j WHERE NOT is_late AND is_closed GROUP BY t0"""))
def _(v: Views) -> DataFrame:
    """Posts searched by phrases in two batches: first the openings, then the rest, much of it too late."""
    feed, path, posts = v.new_path("feed"), v.new_path("found"), v.timed_posts()
    for some in ("id % 1000 <= 2", "id % 1000 > 2"):
        posts.where(some).coalesce(1).write.mode("append").parquet(feed)
    stream = v.spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    found = streaming.windows_and_late_rows(stream, "ts", "full_text", _PHRASES, spread=["id"])
    streaming.micro_batch_flush(found, streaming.overwrite_table(path), v.new_path("progress")).awaitTermination()
    table = v.spark.read.schema(T.StructType([*found.schema.fields, T.StructField("batch_id", T.IntegerType())])).parquet(path)
    none = F.lit(None).cast("bigint")
    late = streaming.late_rows(table).select(F.lit("late").alias("kind"), "t0_us", "id", none.alias("hits"))
    return late.unionByName(streaming.closed_windows(table).select(F.lit("closed").alias("kind"), "t0_us", none.alias("id"), "hits"))


@query("unseen_users_with_memory", "SELECT DISTINCT user_id FROM events WHERE user_id % 2 = 1")
def _(v: Views) -> DataFrame:
    """Every second user is stored before the stream begins."""
    stored = v.table("events").where("user_id % 2 = 0").select("user_id")
    news, path = streaming.unseen_users_with_memory(v.ev_stream(), "user_id", stored, 3600), v.new_path("users")
    streaming.flush_what_is_there(news, streaming.overwrite_table(path), v.new_path("progress")).awaitTermination()
    return v.spark.read.parquet(path).select("user_id")


@query("stream_rolling_rate", """
    WITH e AS (
        SELECT event_id, event_type, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               CAST(round(value * 100) AS BIGINT) + 1 AS ms FROM events)
    SELECT event_id, event_type, rate, total FROM (
        SELECT event_id, event_type, ts, CAST(sum(k) OVER w AS DOUBLE) / sum(ms) OVER w AS rate,
               CAST(sum(k) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total
        FROM e WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
    WHERE epoch_ms(ts) < (SELECT max(epoch_ms(ts)) FROM events)""")
def _(v: Views) -> DataFrame:
    """Rates over the last 20 events of each type, of all events the watermark has passed."""
    rows = v.ev_stream().select(
        "event_id", "event_type", "ts", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        (F.round(F.col("value") * 100).cast("bigint") + 1).alias("ms"))
    rates = streaming.stream_rolling_rate(rows, "event_type", "ts", "event_id", "ms", "k")
    return _to_table(v, rates).select("event_id", "event_type", "rate", "total")


# --- sheets ----------------------------------------------------------------------------------

_COLOR_SQL = """SELECT o_orderpriority, row_number() OVER (ORDER BY min(o_orderkey)) AS c
                FROM orders GROUP BY 1"""


@query("transform_registry", f"""
    SELECT o_custkey AS source, o_orderkey AS destination, CAST(c % 12 AS BIGINT) AS edge_color
    FROM orders JOIN ({_COLOR_SQL}) USING (o_orderpriority)""")
def _(v: Views) -> DataFrame:
    edges = v.table("orders").select(
        F.col("o_custkey").alias("Vertex 1"), F.col("o_orderkey").alias("Vertex 2"),
        F.col("o_orderpriority").alias("Color"),
    )
    return op.transform_registry().edges(edges, "Vertex 2", "simple")


@query("bind_graph", "SELECT o_custkey AS source, o_orderkey AS destination FROM orders")
def _(v: Views) -> DataFrame:
    return op.bind_graph(v.table("orders"), {"source": "o_custkey", "destination": "o_orderkey"})


def _vertices(v: Views) -> DataFrame:
    host = F.regexp_extract("url", "^[a-z]+://([^/]*)", 1)
    return v.table("pages").select(
        "page_id", F.col("url").alias("Vertex"), host.alias("Vertex Group"),
        F.col("url").alias("Custom Menu Item Action"),
        F.concat(F.lit("page "), "page_id").alias("Custom Menu Item Text"),
        F.col("page_id").alias("X"), F.col("url").alias("Image File"),
        F.when(F.col("page_id") % 2 == 0, F.col("url")).alias("Profile Background Image Url"),
        F.lit("").alias("Profile Banner Url"),
        F.concat_ws(" ", host, F.lit("b.example")).alias("Domains in Tweet by Count"),
        host.alias("Domains in Tweet by Salience"),
    )


_VERTEX_SQL = """
    , p AS (SELECT *, regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS host FROM pages),
    g AS (SELECT host, row_number() OVER (ORDER BY min(page_id)) - 1 AS c FROM p GROUP BY host),
    n AS (SELECT p.*, c % 12 AS color FROM p JOIN g USING (host)
          WHERE page_id > (SELECT min(page_id) FROM pages))
    SELECT page_id, page_id AS x, color,
           '<a href="' || url || '" target="_blank">page ' || page_id || '</a>' AS menu,
           '<a href="' || url || '" target="_blank"><img src="' || url || '"/></a>' AS image"""


@query("twitter_nodes", with_views("vocab", _VERTEX_SQL + """,
           CASE WHEN page_id % 2 = 0 THEN '<a href="' || url || '" target="_blank"><img src="' || url || '"/></a>'
                ELSE '' END AS background,
           '' AS banner,
           '<a href="' || host || '" target="_blank">' || host ||
             '</a> <a href="b.example" target="_blank">b.example</a>' AS domains
    FROM n"""))
def _(v: Views) -> DataFrame:
    return op.twitter_nodes(_vertices(v), "page_id").select(
        "page_id", "x", F.col("Color2").alias("color"), F.col("`Custom Menu Item`").alias("menu"),
        F.col("`Image File`").alias("image"), F.col("`Profile Background Image Url`").alias("background"),
        F.col("`Profile Banner Url`").alias("banner"), F.col("`Domains in Tweet by Count`").alias("domains"),
    )


@query("mediawiki_nodes", with_views("vocab", _VERTEX_SQL + ", url AS vertex FROM n"))
def _(v: Views) -> DataFrame:
    return op.mediawiki_nodes(_vertices(v), "page_id").select(
        "page_id", "x", F.col("Color2").alias("color"), F.col("`Custom Menu Item`").alias("menu"),
        F.col("`Image File`").alias("image"), F.col("Vertex").alias("vertex"),
    )
