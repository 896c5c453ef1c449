"""Stores in buckets, ids of names, folded batches, the archive of committed batches."""

import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark import operators as op
from tidemark import plans, sources, streaming

NODE = "id bigint, text string, hydrated string, record_created_at timestamp, record_updated_at timestamp"
NOW, LATER = "2024-05-01 00:00:00", "2024-06-01 00:00:00"


@pytest.fixture()
def store(spark, tmp_path):
    made = sources.BucketStore(spark, str(tmp_path / "store"), {"tweets": (NODE, ["id"])}, 8)
    rows = spark.range(1000).select(
        "id", F.lit("old").alias("text"), F.lit("PARTIAL").alias("hydrated"), F.lit(NOW).cast("timestamp").alias("record_created_at"),
        F.lit(None).cast("timestamp").alias("record_updated_at"))
    made.publish(0, {"tweets": made.stage("tweets", rows, range(8))}, 0)
    return made


def upsert(batch):
    return lambda part: op.upsert_tweets(part, batch, LATER, ["text"])


def test_batch_writes_only_its_buckets(spark, store, rows):
    before = store.manifest()["tables"]["tweets"]
    # One per cent of the keys, all in two buckets; one of them new.
    keys = [r.id for r in spark.range(2000).where(store.bucket_of("tweets").isin(2, 5)).limit(9).collect()] + [None]
    new = spark.range(5000, 6000).where(store.bucket_of("tweets") == 5).first().id
    batch = spark.createDataFrame([(k, "new") for k in [*keys, new] if k is not None], "tweet_id bigint, text string")
    version = store.update("tweets", batch, upsert(batch), 1, ["tweet_id"])
    after = store.manifest()["tables"]["tweets"]
    assert {b for b in after if after[b] != before[b]} == {"2", "5"}
    assert len(store.files.names(f"{store.root}/data/{after['2'].split('/')[1]}/tweets")) == 2
    # The same as the operator on the whole table.
    assert rows(store.read("tweets")) == rows(op.upsert_tweets(store.read("tweets", 1), batch, LATER, ["text"]))
    # The version before is still there, and a repeated batch changes nothing.
    assert store.read("tweets", 1).where("text = 'new'").count() == 0
    assert store.update("tweets", batch, upsert(batch), 1, ["tweet_id"]) == version == store.version()


def test_second_writer_and_rows_of_other_buckets(spark, store):
    batch = spark.createDataFrame([(1, "new")], "tweet_id bigint, text string")
    staged = store.stage("tweets", store.read("tweets", buckets=[3]), [3])
    store.update("tweets", batch, upsert(batch), 1, ["tweet_id"])
    with pytest.raises(sources.VersionTakenError):
        store.publish(1, {"tweets": staged})
    with pytest.raises(Exception, match="is not part of this change"):
        store.stage("tweets", store.read("tweets"), [3])


def test_empty_bucket_lookup_and_vacuum(spark, store):
    gone = store.touched("tweets", spark.createDataFrame([(7,)], "id bigint"))
    folders = store.stage("tweets", store.read("tweets", buckets=gone).where("false"), gone)
    assert set(folders.values()) == {None}
    store.publish(1, {"tweets": folders})
    assert store.lookup("tweets", spark.createDataFrame([(7,), (None,)], "id bigint")).count() == 0
    left = store.read("tweets").count()
    kept = spark.range(3).where(~store.bucket_of("tweets").isin(*gone))
    assert store.lookup("tweets", kept).count() == kept.count()
    assert store.vacuum(keep=1) == 1
    assert store.read("tweets").count() == left and store.versions() == [2]
    with pytest.raises(Exception):  # noqa: B017 - a version that is no more
        store.read("tweets", 1)


def test_ids_stay_and_are_dense(spark, tmp_path):
    store = sources.BucketStore(spark, str(tmp_path / "names"), plans.NAMED_GRAPH, 4)

    def names(*values):
        return spark.createDataFrame([("Drug", v) for v in values] + [(None, "x"), ("Drug", None)], "label string, name string")

    plans.register_names(store, names("b", "a", "a"), 0)
    first = {r.name: r.id for r in store.read("names").collect()}
    assert first == {"a": 1, "b": 2}
    plans.register_names(store, names("c", "b", "aa"), 1)
    plans.register_names(store, names("never"), 1)
    got = {r.name: r.id for r in store.read("names").collect()}
    assert got == {**first, "aa": 3, "c": 4}
    plans.register_names(store, names(*[f"n{k:03d}" for k in range(300)]), 2)
    ids = sorted(r.id for r in store.read("names").collect())
    assert ids == list(range(1, 305))
    edges = spark.createDataFrame([("R", "Drug", "c", "Drug", "new"), ("R", "Drug", "c", "Drug", "new")], "rel string, src_label string, src string, dst_label string, dst string")
    plans.merge_named_graph(store, names("c", "new"), edges, 3)
    plans.merge_named_graph(store, names("c", "new"), edges, 4)
    assert [tuple(r) for r in store.read("edges").collect()] == [(4, 305, "R")]


def batch_folder(path, number, keys):
    folder = path / f"batch_id={number}"
    folder.mkdir(parents=True)
    stamp = pa.array([number * 1_000_000] * len(keys), pa.timestamp("us"))
    seen = pa.array([None if (k + number) % 3 else number for k in keys], pa.int64())
    pq.write_table(pa.table({"id": pa.array(keys, pa.int64()), "v": pa.array([f"{number}-{k}" for k in keys]), "created_at": seen, "as_of": stamp}),
                   folder / "part-0.parquet")


def test_folds_give_the_same_nodes_and_stay_few(spark, tmp_path, rows):
    path, log = tmp_path / "nodes", None
    log = streaming.BatchLog(spark, str(path), "id", fan=3)
    for n in range(40):
        batch_folder(path, n, [n % 7, 7 + n % 5, 20])
        if n % 4 == 3:
            log.compact()
            assert len(log.folders()) <= 3 + 3 + 2 * 4
    everything = tmp_path / "again"
    for n in range(40):
        batch_folder(everything, n, [n % 7, 7 + n % 5, 20])
    want = streaming.read_nodes(spark.read.parquet(str(everything)), "id")
    got = log.read().select(*want.columns)
    assert rows(got) == rows(want)
    # The newest batch is never folded; it may be written again.
    assert "batch_id=39" in log.folders() and log.manifest()[1]["upto"] < 39
    # What the last compaction replaced is still there for its readers, older folders are not.
    assert not (path / "batch_id=0").exists()


def test_a_thousand_batches_open_a_bounded_number_of_folders(spark, tmp_path):
    path = tmp_path / "nodes"
    log = streaming.BatchLog(spark, str(path), "id")
    for n in range(1000):
        batch_folder(path, n, [n % 97])
        if n in (333, 666, 999):
            log.compact()
    assert len(log.folders()) <= 9 * 3 + 10
    assert log.read().count() == 97
    assert log.compact() == 0


def test_archive_holds_a_batch_once(spark, tmp_path):
    path = str(tmp_path / "archive")
    df = spark.createDataFrame([(1, "2024-01-01-00"), (2, "2024-01-01-01"), (3, None)], "id bigint, ingest_hour string")
    assert sources.sink_parquet_hourly(df, path, "a job!", query="q", batch=0)
    assert not sources.sink_parquet_hourly(df, path, "a job!", query="q", batch=0)
    assert sources.sink_parquet_hourly(df.where("id = 1").drop("ingest_hour"), path, "other", "2024-01-01-00", query="q", batch=1)
    archive = sources.HourlyArchive(spark, path)
    # A try that died before its record is never read.
    archive.stage(df, "dead")
    assert archive.read("id bigint").count() == 4
    assert {(r.id, r.job_name) for r in archive.read("id bigint", "2024-01-01-00").collect()} == {(1, "ajob"), (1, "other")}
    assert archive.read("id bigint, ingest_hour string", job_name="other").columns == ["id", "job_name", "ingest_hour"]
    assert archive.read("id bigint", "2030-01-01-00").count() == 0
    assert archive.clear_failed() == 1 and archive.read("id bigint").count() == 4
    record = json.loads(archive.files.read(f"{path}/_commits/q/000000000001.json"))
    assert [p["ingest_hour"] for p in record["parts"]] == ["2024-01-01-00"]
    # Two tries at the same time: the second finds the name taken.
    write = archive.stage(df, "job")
    assert archive.commit("q", 2, write) and not archive.commit("q", 2, archive.stage(df, "job"))
    assert sources.HourlyArchive(spark, str(tmp_path / "none")).read("id bigint").count() == 0


def test_failed_graph_write_adds_no_row(spark, tmp_path):
    path, graph = str(tmp_path / "archive"), []

    def to_graph(df, number):
        graph.append(number)
        if len(graph) == 1:
            raise OSError("down")

    flush = sources.sink_dual_flush(
        lambda df, n: sources.sink_parquet_hourly(df, path, "job", "2024-01-01-00", query="dual", batch=n), to_graph)
    df = spark.range(5)
    with pytest.raises(OSError, match="down"):
        flush(df, 0)
    flush(df, 0)
    assert sources.HourlyArchive(spark, path).read("id bigint").count() == 5 and graph == [0, 0]
