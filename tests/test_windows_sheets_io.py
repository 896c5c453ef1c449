"""Time windows, sheets, readers and writers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import operators as op
from tidemark import plans, sources


@pytest.fixture(scope="module")
def times(spark):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    data = [(i, str(start + dt.timedelta(seconds=rng.randrange(200_000), microseconds=rng.randrange(10**6))))
            for i in range(600)]
    df = spark.createDataFrame(data, "id LONG, t STRING").select("id", F.col("t").cast("timestamp").alias("ts"))
    return df, [(i, dt.datetime.fromisoformat(t)) for i, t in data]


def strides(rows, since, until, step, limit=None):
    """The plain loop over windows."""
    t, total, out = since, 0, []
    while t < until and (not total or limit is None or total < limit):
        hits = [(i, t) for i, ts in rows if t <= ts < t + step]
        total += len(hits)
        out += hits
        t += step
    return sorted(out)


SINCE, UNTIL, STEP = dt.datetime(2024, 1, 1, 3, 7), dt.datetime(2024, 1, 2, 20), dt.timedelta(seconds=5000)


@pytest.mark.parametrize("limit", [None, 1, 100, 250, 10_000])
def test_strides(times, limit):
    df, data = times
    args = (df, "ts", SINCE, UNTIL, 5000)
    got = op.stride_windows(*args) if limit is None else op.stride_windows_limited(*args, limit)
    assert sorted((r.id, r.t0) for r in got.collect()) == strides(data, SINCE, UNTIL, STEP, limit)
    assert all((r.t1 - r.t0) == STEP for r in got.collect())


@pytest.mark.parametrize(("outer", "inner"), [(43200, 14400), (40000, 9000), (10000, 25000)])
def test_backfill(times, outer, inner):
    df, data = times
    start, want = dt.datetime(2024, 1, 1, 2), []
    for n in range(30):
        since = start + dt.timedelta(seconds=n * outer)
        for i, t0 in strides(data, since, since + dt.timedelta(seconds=outer), dt.timedelta(seconds=inner)):
            want.append((i, n, t0))
    got = op.backfill_windows(df, "ts", start, outer, inner).collect()
    assert sorted((r.id, r.outer_no, r.t0) for r in got) == sorted(want)


def test_search(spark, times):
    df, data = times
    posts = df.withColumn("text", F.when(F.col("id") % 2 == 0, "A Red ring").otherwise("other"))
    store = spark.createDataFrame([(0, "FULL"), (2, "PARTIAL")], "id LONG, hydrated STRING")
    got = plans.search_time_range(posts, "ts", "text", ["red RING"], SINCE, UNTIL, 5000, None, store)
    want = [(i, t) for i, t in strides(data, SINCE, UNTIL, STEP) if i % 2 == 0 and i != 0]
    assert sorted((r.id, r.t0) for r in got.collect()) == want
    few = plans.search_time_range(posts, "ts", "text", ["red ring"], SINCE, UNTIL, 5000, 20)
    even = [(i, t) for i, t in data if i % 2 == 0]
    assert sorted((r.id, r.t0) for r in few.collect()) == strides(even, SINCE, UNTIL, STEP, 20)


def test_time_filter_reaches_the_scan(spark, times, tmp_path):
    path = str(tmp_path / "t")
    times[0].write.parquet(path)
    plan = op.stride_windows(spark.read.parquet(path), "ts", SINCE, UNTIL, 600)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_sheets(spark, rows):
    raw = spark.createDataFrame(
        [(0, "Vertex 1", "Vertex 2", "Color"), (1, "a", "b", "red"), (2, "a", "c", "blue"), (3, "b", "c", "red"),
         (4, "c", "a", None)], "n INT, c0 STRING, c1 STRING, c2 STRING")
    edges = op.promote_header_row(raw, "n")
    assert edges.columns == ["n", "Vertex 1", "Vertex 2", "Color"] and edges.count() == 4
    colored = op.factorize_mod_edges(edges, "Color", "n")
    assert rows(colored.select("n", "ColorInt")) == [(1, 1), (2, 2), (3, 1), (4, 11)]
    assert rows(op.factorize_mod_edges(edges, "Color", "n", header=False).select("n", "ColorInt")) == [
        (1, 0), (2, 1), (3, 0), (4, 11)]
    many = spark.range(40).select("id", F.concat(F.lit("g"), F.col("id")).alias("g"))
    nodes = op.factorize_mod_nodes(many, "g", "id")
    assert {r.id: r.Color2 for r in nodes.collect()} == {i: i % 12 for i in range(1, 40)}
    reg = op.transform_registry({"mine": {"edge_bindings": {"source": "Vertex 2"}}})
    assert reg.edges(edges, "n", "mine").columns == ["source"]
    assert reg.edges(edges, "n").columns == ["source", "destination", "edge_color"]
    assert reg.edges(edges, "n", {"edges_df_transformer": lambda df, o: df.withColumn("ColorInt", F.lit(5))}
                     ).first().edge_color == 5
    with pytest.raises(KeyError, match="nope"):
        reg.edges(edges, "n", "nope")


def test_phrases_and_chunks(spark):
    df = spark.createDataFrame([(i, f"p{i:02d}") for i in range(45)], "n INT, term STRING")
    got = {r.batch_no: r.query for r in op.phrase_query(df, "n").collect()}
    assert set(got) == {0, 1, 2} and got[2] == " OR ".join(f'"p{i:02d}"' for i in range(40, 45))
    sizes = [r["count"] for r in op.chunk_rows(df, ["n"], 20).groupBy("batch_no").count().collect()]
    assert sorted(sizes) == [5, 20, 20]


def test_id_files(spark, tmp_path, rows):
    for hour, text in (("2024-01-01-05", "1\n2\n"), ("2024-01-01-06", "3\n")):
        (tmp_path / f"ids_{hour}.txt").write_text(text)
    assert sources.scan_id_file(spark, str(tmp_path / "ids_2024-01-01-05.txt")).count() == 2
    assert rows(sources.scan_hourly_partition(spark, str(tmp_path), "2024-01-01-06", "files")) == [(3,)]
    assert sources.scan_hourly_partition(spark, str(tmp_path), "2024-01-01-07", "files").count() == 0
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    for root, i in ((a, 1), (b, 2)):
        spark.createDataFrame([(i, "h1"), (9, "h2")], "id LONG, hour STRING").write.partitionBy("hour").csv(root)
    assert rows(sources.scan_hourly_partition(spark, [a, b], "h1")) == [(1,), (2,)]
    assert sources.scan_hourly_partition(spark, [a, b], "h3").count() == 0


def test_topics_and_vocab(spark, tmp_path, rows):
    want = [("a", 0, "x y"), ("a", 1, "é"), ("b", 0, "z")]
    assert rows(sources.scan_topics(spark, {"a": ["x y", "é"], "b": ["z"]})) == want
    (tmp_path / "t.json").write_text('{"a": ["x y", "é"]}\n{"b": ["z"]}\n')
    assert rows(sources.scan_topics(spark, str(tmp_path / "t.json"))) == want
    (tmp_path / "v.csv").write_text('id,Common name,Synonyms\n1,"a, ""b""",x|y\n2,c,\n')
    assert rows(sources.scan_vocab_csv(spark, str(tmp_path / "v.csv"))) == [('a, "b"', "x|y"), ("c", None)]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "parquet_s3"])
def test_batches_replace_themselves(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a,\"b\"\n", [1])], "id INT, t STRING, l ARRAY<INT>")
    args = (str(tmp_path), "job one", "tweets", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), fmt)
    target = sources.sink_batch(df, *args)
    assert target.endswith("/jobone/tweets/20240101000000_20240102000000")
    assert sources.sink_batch(df, *args) == target
    kind = fmt.removesuffix("_s3")
    options = {"header": True, "multiLine": True, "escape": '"'} if kind == "csv" else {}
    back = spark.read.format(kind).options(**options).load(target)
    assert back.count() == 1 and back.first().t == "a,\"b\"\n"


def test_batch_formats(spark, tmp_path):
    df = spark.range(1)
    assert sources.sink_batch(df, str(tmp_path), "j", "k", "1", "2", None) is None
    with pytest.raises(ValueError, match="xml"):
        sources.sink_batch(df, str(tmp_path), "j", "k", "1", "2", "xml")
    with pytest.raises(ValueError, match="lzo"):
        sources.sink_parquet_hourly(df, str(tmp_path), "j", "h", "lzo")


def test_hourly_archive_appends(spark, tmp_path):
    path = str(tmp_path / "archive")
    for _ in range(2):
        sources.sink_parquet_hourly(spark.range(3), path, "a b", "2024-01-01-05", "none")
    got = sources.HourlyArchive(spark, path).read("id bigint")
    assert got.count() == 6 and got.select("job_name", "ingest_hour").distinct().collect()[0][0] == "ab"


def test_quarantine(spark, rows):
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("n", T.IntegerType())])
    df = spark.createDataFrame([("1", "5"), ("2", None), ("x", "y"), (None, "3"), ("4", "99999999999")],
                               "id STRING, n STRING")
    valid, rejected = sources.sink_quarantine(df, schema)
    assert rows(valid) == [(1, 5), (2, None)]
    assert rows(rejected) == [("4", "99999999999", "n"), ("x", "y", "id,n"), (None, "3", "id")]


def test_archive_scan_fills_missing_columns(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.createDataFrame([(5, "t")], "id LONG, full_text STRING").write.parquet(path)
    r = sources.scan_status_archive(spark, path).first()
    assert (r.id, r.full_text, r.lang, len(r)) == (5, "t", None, 34)


def test_topics_over_several_lines_or_one_per_line(spark, tmp_path):
    pretty, lines, broken = tmp_path / "pretty.json", tmp_path / "lines.json", tmp_path / "broken.json"
    pretty.write_text('{\n  "a": ["x y", "é"],\n  "b": [\n    "z"\n  ]\n}\n')
    lines.write_text('{"a": ["x y", "é"]}\n\n{"b": ["z"]}\n')
    broken.write_text("[1, 2")
    want = [("a", 0, "x y"), ("a", 1, "é"), ("b", 0, "z")]
    for path in (pretty, lines):
        assert sorted(map(tuple, sources.scan_topics(spark, str(path)).collect())) == want
    with pytest.raises(Exception, match="not a JSON object"):
        sources.scan_topics(spark, str(broken)).collect()


def test_quarantine_is_written(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType())])
    df = spark.createDataFrame([("1",), ("x",)], "id STRING")
    sources.write_quarantine(df, schema, str(tmp_path / "v"), str(tmp_path / "r"))
    assert [r.id for r in spark.read.parquet(str(tmp_path / "v")).collect()] == [1]
    assert [(r.id, r.reason) for r in spark.read.json(str(tmp_path / "r")).collect()] == [("x", "id")]
