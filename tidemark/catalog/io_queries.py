"""Readers and writers."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as op
from .. import plans, sources, streaming
from .registry import query
from .views import Views, with_views


@query("scan_id_file", "SELECT o_orderkey AS id FROM orders")
def _(v: Views) -> DataFrame:
    path = v.new_path("ids")
    v.table("orders").select("o_orderkey").write.csv(path)
    return sources.scan_id_file(v.spark, path)


@query("scan_hourly_partition",
       "SELECT event_id AS id FROM events WHERE strftime(ts, '%Y-%m-%d-%H') = '2024-01-03-05'")
def _(v: Views) -> DataFrame:
    path = v.new_path("hourly")
    hours = v.ev().select("event_id", F.date_format("ts", "yyyy-MM-dd-HH").alias("hour"))
    hours.hint("rebalance", F.col("hour")).write.partitionBy("hour").csv(path)
    return sources.scan_hourly_partition(v.spark, path, "2024-01-03-05")


@query("scan_status_archive", with_views("posts", """
    SELECT status_id AS id, full_text, reply_to AS in_reply_to_status_id, FALSE AS possibly_sensitive,
           '{"id":' || length(user_name) || ',"screen_name":"' || user_name || '"}' AS "user",
           CAST(NULL AS VARCHAR) AS lang
    FROM posts"""))
def _(v: Views) -> DataFrame:
    path = v.new_path("archive")
    plans.to_archive(v.raw_posts()).write.parquet(path)
    return sources.scan_status_archive(v.spark, path).select(
        "id", "full_text", "in_reply_to_status_id", "possibly_sensitive", "user", "lang"
    )


@query("scan_vocab_csv",
       "SELECT p_name AS name, p_brand || '|' || p_type || '|' || p_name AS synonyms FROM part")
def _(v: Views) -> DataFrame:
    path = v.new_path("vocab")
    v.table("part").select(
        "p_partkey", F.col("p_name").alias("Common name"),
        F.concat_ws("|", "p_brand", "p_type", "p_name").alias("Synonyms"),
    ).write.csv(path, header=True)
    return sources.scan_vocab_csv(v.spark, path).toDF("name", "synonyms")


_STUDY_SQL = with_views("studies", "SELECT * FROM studies")


@query("scan_trials_json", _STUDY_SQL)
def _(v: Views) -> DataFrame:
    path = v.new_path("trials")
    v.trials().write.json(path)
    return op.flatten_trials(sources.scan_trials_json(v.spark, path))


@query("promote_header_row", "SELECT p_partkey, p_name AS drug_name, p_brand AS maker FROM part")
def _(v: Views) -> DataFrame:
    part = v.table("part").select("p_partkey", F.col("p_name").alias("a"), F.col("p_brand").alias("b"))
    head = part.agg(F.min("p_partkey")).select(
        (F.col("min(p_partkey)") - 1).alias("p_partkey"), F.lit("drug_name").alias("a"),
        F.lit("maker").alias("b"),
    )
    return op.promote_header_row(part.unionByName(head), "p_partkey")


@query("scan_topics", with_views("vocab topics", "SELECT topic, 0 AS position, phrase FROM topics"))
def _(v: Views) -> DataFrame:
    path = v.new_path("topics")
    v.topics().select(F.to_json(F.create_map("topic", F.array("phrase")))).write.text(path)
    return sources.scan_topics(v.spark, path)


@query("sink_parquet_hourly", """
    SELECT 'newsfeed' AS job_name, strftime(ts, '%Y-%m-%d-%H') AS ingest_hour, count(*) AS n,
           count(DISTINCT user_id) AS users
    FROM events GROUP BY 2""")
def _(v: Views) -> DataFrame:
    path = v.new_path("hourly-archive")
    hours = v.ev().withColumn("ingest_hour", F.date_format("ts", "yyyy-MM-dd-HH"))
    for _ in range(2):  # sent twice, there once
        sources.sink_parquet_hourly(hours, path, "news feed!", query="feed", batch=7)
    back = sources.HourlyArchive(v.spark, path).read(hours.schema)
    return back.groupBy("job_name", "ingest_hour").agg(
        F.count("*").alias("n"), F.countDistinct("user_id").alias("users")
    )


@query("sink_batch", """
    SELECT e.event_id, e.event_type, e.props, f.fmt
    FROM events e, (VALUES ('csv'), ('json'), ('parquet')) f(fmt)""")
def _(v: Views) -> DataFrame:
    root = v.new_path("batches")
    span = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")
    rows = v.ev().select("event_id", "event_type", "props")
    out = None
    for fmt in ("csv", "json", "parquet"):
        target = sources.sink_batch(rows, root, fmt + " job", "tweets", *span, fmt)
        reader = v.spark.read.schema(rows.schema)
        if fmt == "csv":
            reader = reader.option("header", True).option("escape", '"')
        part = reader.format(fmt).load(target).withColumn("fmt", F.lit(fmt))
        out = part if out is None else out.unionByName(part)
    return out


@query("sink_quarantine", with_views("ev_typed", """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN k END AS k,
           CASE WHEN event_type = 'error' THEN 'k' ELSE '' END AS reason
    FROM ev_typed"""))
def _(v: Views) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    rows = v.ev().select(
        "event_id", F.when(F.col("event_type") == "error", F.concat(F.lit("x"), k)).otherwise(k).alias("k")
    )
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("k", T.LongType())])
    good, bad = v.new_path("valid"), v.new_path("rejected")
    sources.write_quarantine(rows, schema, good, bad)
    valid = v.spark.read.schema(schema).parquet(good)
    rejected = v.spark.read.schema("event_id LONG, k STRING, reason STRING").json(bad)
    return valid.withColumn("reason", F.lit("")).unionByName(
        rejected.withColumn("k", F.lit(None).cast("bigint"))
    )


@query("sink_dual_flush", """
    SELECT s.sink, e.event_type, count(*) AS n
    FROM events e, (VALUES ('archive'), ('graph')) s(sink) GROUP BY ALL""")
def _(v: Views) -> DataFrame:
    """A stream into archive and graph; the graph fails at first, so the batch is sent again."""
    path, progress = v.new_path("archive"), v.new_path("progress")
    archive, events = sources.HourlyArchive(v.spark, path), v.ev_stream()
    graph = sources.BucketStore(v.spark, v.new_path("graph"), {"events": ("event_id bigint, event_type string", ["event_id"])}, 16)
    failures = ["down"]

    def to_graph(df: DataFrame, number: int) -> None:
        if failures:
            raise ConnectionError(failures.pop())
        news = df.select("event_id", "event_type")
        graph.update("events", news, lambda part: part.unionByName(news).distinct(), number)

    flush = sources.sink_dual_flush(
        lambda df, number: sources.sink_parquet_hourly(df.withColumn("ingest_hour", F.date_format("ts", "yyyy-MM-dd")), path, "job", query="dual", batch=number),
        to_graph)
    for _ in range(2):
        query = streaming.micro_batch_flush(events, flush, progress)
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if failures:
                raise
    tables = [df.select(F.lit(s).alias("sink"), "event_type") for s, df in (
        ("archive", archive.read(events.schema)), ("graph", graph.read("events")))]
    return tables[0].unionByName(tables[1]).groupBy("sink", "event_type").agg(F.count("*").alias("n"))


@query("read_limited", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey DESC LIMIT 1000")
def _(v: Views) -> DataFrame:
    return op.read_limited(v.table("orders").select("o_orderkey", "o_custkey"), [F.desc("o_orderkey")])
