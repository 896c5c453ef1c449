"""Streams give what the batch operators give, survive repeats, and lose only what is late."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark import operators as op
from tidemark import sources, streaming
from tidemark.catalog.views import Views

SCHEMA = "id LONG, user_id LONG, t STRING, kind STRING"


@pytest.fixture()
def feed(spark, tmp_path):
    """A folder of JSON files with rising modification times, one micro-batch each."""
    folder = tmp_path / "feed"
    folder.mkdir()
    count = iter(range(1, 100))

    def add(*rows):
        n = next(count)
        part = folder / f"{n:03d}.json"
        lines = ['{"id":%d,"user_id":%d,"t":"%s","kind":"%s"}' % r for r in rows]
        part.write_text("\n".join(lines) + "\n")
        os.utime(part, (1_700_000_000 + n, 1_700_000_000 + n))

    def stream():
        raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))
        return raw.withColumn("ts", F.col("t").cast("timestamp"))

    def batch():
        return spark.read.schema(SCHEMA).json(str(folder)).withColumn("ts", F.col("t").cast("timestamp"))

    return add, stream, batch


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def test_windows_match_batch(spark, feed, tmp_path, rows):
    add, stream, batch = feed
    add((1, 1, "2024-01-01 00:00:10", "a"), (2, 1, "2024-01-01 00:00:40", "a"))
    add((3, 2, "2024-01-01 00:01:05", "b"), (4, 2, "2024-01-01 00:00:20", "a"))
    out = str(tmp_path / "out")
    drain(streaming.stream_backfill(stream(), "ts", "30 seconds", streaming.overwrite_table(out), str(tmp_path / "progress")))
    got = streaming.latest_batch(spark.read.parquet(out)).select("t0", "t1", "hits")
    assert rows(got) == rows(op.hits_per_window(batch(), "ts", 30))


def test_late_posts_are_lost_beyond_the_delay(spark, feed, tmp_path):
    add, stream, _ = feed
    add((1, 1, "2024-01-01 00:00:10", "a"))
    add((2, 1, "2024-01-01 00:10:00", "a"))
    # Rows are judged by the watermark of the batch before.
    add((9, 1, "2024-01-01 00:10:01", "b"))
    add((3, 1, "2024-01-01 00:00:11", "a"), (4, 1, "2024-01-01 00:09:45", "a"))
    add((5, 1, "2024-01-01 00:30:00", "a"))
    add((6, 1, "2024-01-01 00:31:00", "b"))
    out = str(tmp_path / "out")
    hits = streaming.live_window_search(stream(), "ts", "kind", ["A"])
    drain(streaming.micro_batch_flush(hits, lambda df, i: sources.write_batch_table(df, out, i), str(tmp_path / "progress")))
    got = {str(r.t0)[11:]: r.hits for r in spark.read.parquet(out).collect()}
    assert got == {"00:00:00": 1, "00:09:30": 1, "00:10:00": 1}


def test_dedupe_and_users(spark, feed, tmp_path, rows):
    add, stream, _ = feed
    add((1, 1, "2024-01-01 00:00:10", "a"), (1, 1, "2024-01-01 00:00:10", "a"), (2, 2, "2024-01-01 00:00:12", "a"))
    add((2, 2, "2024-01-01 00:00:12", "b"), (3, 1, "2024-01-01 00:00:20", "a"))
    for name, made, want in (
        ("ids", streaming.stream_dedupe(stream(), ["id"], "ts").select("id"), [(1,), (2,), (3,)]),
        ("users", streaming.stream_unseen_users(stream(), "user_id"), [(1,), (2,)]),
    ):
        out = str(tmp_path / name)
        drain(streaming.micro_batch_flush(made, lambda df, i, o=out: sources.write_batch_table(df, o, i), str(tmp_path / f"progress-{name}")))
        assert rows(spark.read.parquet(out).drop("batch_id")) == want


def test_hydration_filter_sees_own_writes(spark, feed, tmp_path, rows):
    add, stream, _ = feed
    add((1, 1, "2024-01-01 00:00:10", "a"), (2, 2, "2024-01-01 00:00:12", "a"))
    add((2, 2, "2024-01-01 00:00:12", "b"), (3, 1, "2024-01-01 00:00:20", "a"))
    out = str(tmp_path / "fresh")
    stored = spark.createDataFrame([(1, "FULL")], "id LONG, hydrated STRING")

    def store():
        if not os.path.exists(out):
            return stored
        seen = spark.read.parquet(out).select("id", F.lit("FULL").alias("hydrated"))
        return stored.unionByName(seen)

    handle = streaming.stream_hydration_filter(store, lambda df, i: sources.write_batch_table(df, out, i))
    drain(streaming.micro_batch_flush(stream().select("id", "kind"), handle, str(tmp_path / "progress")))
    assert rows(spark.read.parquet(out).select("id", "kind")) == [(2, "a"), (3, "a")]


def test_graph_upsert_folds_batches_and_repeats(spark, feed, tmp_path):
    add, stream, _ = feed
    add((1, 1, "2024-01-01 00:00:10", "a"), (2, 2, "2024-01-01 00:00:12", "a"), (3, 1, "2024-01-01 00:00:13", "b"))
    add((4, 1, "2024-01-01 00:00:20", "c"))
    out = str(tmp_path / "nodes")
    upsert = streaming.stream_graph_upsert(out, lambda i: f"2024-02-0{i + 1} 00:00:00", "user_id", ["id"])

    def twice(df, i):
        upsert(df, i)
        upsert(df, i)

    drain(streaming.micro_batch_flush(stream().select("user_id", "id", "kind", F.col("ts").alias("created_at")), twice, str(tmp_path / "progress")))
    got = {r.user_id: r for r in streaming.read_nodes(spark.read.parquet(out), "user_id").collect()}
    assert (got[1].kind, got[1].id, str(got[1].created_at)[17:]) == ("c", 4, "13")
    assert (str(got[1].record_created_at)[:10], str(got[1].record_updated_at)[:10]) == ("2024-02-01", "2024-02-02")
    assert (got[2].kind, got[2].record_updated_at) == ("a", None)


def test_dual_flush_writes_the_graph_before_failing(spark):
    calls = []

    def archive(df, i):
        calls.append(("archive", i))
        raise OSError("disk")

    def graph(df, i):
        calls.append(("graph", df.count()))

    with pytest.raises(OSError, match="disk"):
        sources.sink_dual_flush(archive, graph)(spark.range(3), 7)
    assert calls == [("archive", 7), ("graph", 3)]


@pytest.mark.parametrize("parts", [0, 3])
def test_a_table_streams_as_one_file_or_as_a_folder(spark, tmp_path, rows, parts):
    (tmp_path / "tables").mkdir()
    ids = spark.range(50).withColumn("text", F.concat(F.lit("t"), "id"))
    ids.repartition(parts or 1).write.parquet(str(tmp_path / ("tables/posts.parquet" if parts else "made")))
    if not parts:
        part, = (tmp_path / "made").glob("part-*.parquet")
        os.link(part, tmp_path / "tables/posts.parquet")
    ids.limit(5).write.parquet(str(tmp_path / "tables/others.parquet"))
    stream, out = Views(spark, str(tmp_path / "tables")).stream("posts"), str(tmp_path / "out")
    drain(streaming.micro_batch_flush(stream, streaming.overwrite_table(out), str(tmp_path / "progress")))
    assert rows(spark.read.parquet(out).drop("batch_id")) == rows(ids)
