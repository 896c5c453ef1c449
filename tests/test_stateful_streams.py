"""Buffers, late rows, seen users and rolling rates over restarts, against the batch operators."""

import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark import operators as op
from tidemark import sources, streaming
from tidemark.streaming import stateful

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
        part.write_text("\n".join('{"id":%d,"user_id":%d,"t":"%s","kind":"%s"}' % r for r in rows) + "\n")
        os.utime(part, (1_700_000_000 + n, 1_700_000_000 + n))

    def stream():
        raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))
        return raw.withColumn("ts", F.col("t").cast("timestamp"))

    return add, stream


def table(path):
    return lambda df, i: sources.write_batch_table(df, path, i)


def test_groups_flush_by_count_then_age_over_a_restart(spark, feed, tmp_path):
    add, stream = feed
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def groups():
        return streaming.count_or_age_groups(stream().select("kind", "id"), ["kind"], 3, 1)

    add(*[(n, 0, "2024-01-01", "a") for n in range(6)], (100, 0, "2024-01-01", "b"))
    add((6, 0, "2024-01-01", "a"))
    streaming.flush_what_is_there(groups(), table(out), progress).awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(out).groupBy("kind", "flush_no", "reason").count().collect()]
    assert got == [("a", 0, "count", 4)]
    assert streaming.held_rows(spark, progress).count() == 4
    # A new start goes on with what is held: one more row fills the group, the rest comes out by its age.
    add((7, 0, "2024-01-01", "a"), (8, 0, "2024-01-01", "a"))
    streaming.flush_rest(groups(), table(out), progress, 120)
    rows = spark.read.parquet(out)
    # Every row once, in flushes of one micro-batch each.
    assert sorted(r.id for r in rows.collect()) == [*range(9), 100]
    assert rows.groupBy("kind", "flush_no").agg(F.countDistinct("batch_id").alias("n")).where("n > 1").count() == 0
    sizes = {(r.kind, r.flush_no, r.reason): r["count"] for r in rows.groupBy("kind", "flush_no", "reason").count().collect()}
    assert sizes[("b", 0, "age")] == 1 and sum(n for (k, *_), n in sizes.items() if k == "a") == 9
    assert all(n == 4 for (_, _, reason), n in sizes.items() if reason == "count")
    assert streaming.held_rows(spark, progress).count() == 0


def test_every_row_is_counted_or_late(spark, feed, tmp_path):
    add, stream = feed
    add((1, 1, "2024-01-01 00:00:10", "a"), (2, 1, "2024-01-01 00:10:00", "a"))
    add((3, 1, "2024-01-01 00:00:11", "a"), (4, 1, "2024-01-01 00:09:45", "a"), (5, 1, "2024-01-01 00:00:12", "no"))
    add((6, 1, "2024-01-01 00:30:00.000001", "A"), (7, 2, "2024-01-01 00:09:59", "a"))
    add((8, 1, "2024-01-01 00:09:59", "a"), (9, 1, "2024-01-01 01:30:00", "a"))
    out = str(tmp_path / "out")
    found = streaming.windows_and_late_rows(stream(), "ts", "kind", ["a"], shards=3, spread=["id"])
    streaming.micro_batch_flush(found, table(out), str(tmp_path / "progress")).awaitTermination()
    got = spark.read.parquet(out)
    late = {r.id: (r.t0_us // 1_000_000 % 86_400, str(r.ts)[11:19]) for r in streaming.late_rows(got).collect()}
    assert late == {3: (0, "00:00:11"), 8: (570, "00:09:59")}
    hits = {r.t0_us // 1_000_000 % 86_400: r.hits for r in streaming.closed_windows(got).collect()}
    # The last window is still open.
    assert hits == {0: 1, 570: 2, 600: 1, 1800: 1} and sum(hits.values()) + len(late) == 8 - 1


def test_users_known_before_are_not_sent(spark, feed, tmp_path):
    add, stream = feed
    add((1, 1, "2024-01-01", "a"), (2, 2, "2024-01-01", "a"), (3, 3, "2024-01-01", "a"), (4, 3, "2024-01-01", "a"))
    stored = spark.createDataFrame([(2,), (2,), (None,)], "user_id LONG")

    def run(name, known, progress):
        out = str(tmp_path / name)
        news = streaming.unseen_users_with_memory(stream(), "user_id", known, 3600)
        streaming.flush_what_is_there(news, table(out), str(tmp_path / progress)).awaitTermination()
        return sorted(r.user_id for r in spark.read.schema("user_id LONG").parquet(out).collect())

    assert run("first", stored, "progress") == [1, 3]
    add((5, 1, "2024-01-02", "a"), (6, 4, "2024-01-02", "a"))
    assert run("second", stored, "progress") == [4]
    # A new checkpoint with the stored accounts of the first run enriches nobody again.
    assert run("third", spark.createDataFrame([(1,), (2,), (3,), (4,)], "user_id LONG"), "fresh") == []


def test_users_are_forgotten(spark, feed, tmp_path):
    add, stream = feed
    add((1, 1, "2024-01-01", "a"))
    for name, want in (("a", [1]), ("b", [1])):
        news = streaming.unseen_users_with_memory(stream(), "user_id", None, 0.001)
        streaming.flush_what_is_there(news, table(str(tmp_path / name)), str(tmp_path / "progress")).awaitTermination()
        assert [r.user_id for r in spark.read.parquet(str(tmp_path / name)).collect()] == want
        add((2, 1, "2024-01-01", "a"))


def test_rolling_rate_same_as_batch(spark, feed, tmp_path, rows):
    add, stream = feed
    # Operations of a batch arrive out of order; later batches never reach behind the watermark.
    times = [[3, 1, 2, 2], [9, 5, 5, 12], [30, 14, 22, 13]]
    for b, seconds in enumerate(times):
        add(*[(10 * b + k, s + 1, f"2024-01-01 00:00:{s:02d}", "ab"[k % 2]) for k, s in enumerate(seconds)])
    add((99, 1, "2024-01-01 00:10:00", "a"))
    out = str(tmp_path / "out")
    ready = stream().select("kind", "ts", "id", F.col("user_id").alias("took"), F.col("id").alias("done"))
    rates = streaming.stream_rolling_rate(ready, "kind", "ts", "id", "took", "done", n=3, delay="5 seconds")
    streaming.micro_batch_flush(rates, table(out), str(tmp_path / "progress")).awaitTermination()
    flat = [(10 * b + k, s + 1, s, "ab"[k % 2]) for b, ss in enumerate(times) for k, s in enumerate(ss)]
    batch = spark.createDataFrame([(i, took, i, kind, s * 1000 + i) for i, took, s, kind in flat], "id LONG, took LONG, done LONG, kind STRING, place LONG")
    want = op.rolling_rate(batch, "kind", "place", "took", "done", n=3)
    got = spark.read.parquet(out)
    pick = lambda df: rows(df.select("id", F.round("rate", 9), F.col("total").cast("double")))
    assert pick(got) == pick(want)


class Held(dict):
    """State of one key, as the calls of a state handle see it; no row list or part leaves it twice."""

    def __init__(self, what):
        super().__init__()
        self.what = what

    getListState = getMapState = getValueState = lambda self, name, *schema: self.setdefault(name, Held(name))  # noqa: N815
    exists = lambda self: None in self
    update = lambda self, v: self.__setitem__(None, v)
    updateValue = dict.__setitem__  # noqa: N815
    getValue, removeKey = dict.__getitem__, dict.__delitem__  # noqa: N815
    put = appendList = lambda self, v: self.__setitem__(None, [*v])  # noqa: N815

    def get(self):
        return dict.get(self, None, [] if self.what in ("ring", "rows") else None)

    def iterator(self):
        return iter([*self.items()])

    def registerTimer(self, at):  # noqa: N802
        self["timer"] = at

    deleteTimer = lambda self, at: self.pop("timer")  # noqa: E731, N815


class Clock:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = self.getCurrentProcessingTimeInMs = lambda: ms


def test_flushes_of_a_large_key_leave_in_frames(monkeypatch):
    """One key with many rows: frames come out while its input is still being read."""
    monkeypatch.setattr(stateful, "FRAME_ROWS", 100)
    handle, read, most = Held("state"), [], 9
    buffer = stateful._Buffer(most, 1000)
    buffer.init(handle)

    def frames():
        for at in range(0, 5005, 55):
            read.append(at)
            yield pd.DataFrame({"row": [f"r{k}" for k in range(at, at + 55)]})

    seen, sizes = [], []
    for frame in buffer.handleInputRows(("a", 0), frames(), Clock(0)):
        assert len(frame) <= 100 + most and read[-1] <= len(seen) + 200
        seen.extend(frame["row"])
        sizes.append(frame.groupby("flush_no").size())
    assert seen == [f"r{k}" for k in range(5000)] and all((s == 10).all() for s in sizes) and len(handle["rows"].get()) == 5
    rest, = buffer.handleExpiredTimer(("a", 0), Clock(2000), None)
    assert [*rest["row"]] == [f"r{k}" for k in range(5000, 5005)] and set(rest["flush_no"]) == {500} and set(rest["reason"]) == {"age"}


def test_waiting_rows_of_a_name_are_merged_from_parts(monkeypatch):
    """Rows of one name in any order: a merge holds one part of each run, and what is early stays."""
    for name, size in (("RUN_ROWS", 200), ("PART_ROWS", 10), ("FRAME_ROWS", 50)):
        monkeypatch.setattr(stateful, name, size)
    handle, draw = Held("state"), random.Random(1)
    rolling = stateful._Rolling(3)
    rolling.init(handle)
    values = [0.5, 1.0, 2.0, None]
    given = [(draw.randrange(1000) * 500, draw.choice([None, *range(5)]), draw.choice(values), draw.choice(values)) for _ in range(2000)]
    names = ("us", "place", "duration", "value")
    frames = (pd.DataFrame({"row": [dict(zip(names, r, strict=True), placed=r[1] is not None) for r in given[at:at + 70]]}) for at in range(0, 2000, 70))
    assert [*rolling.handleInputRows(("a",), frames, Clock(0))] == []
    assert len(handle["heads"]) == 10 and all(len(p[0]) <= 10 for p in handle["parts"].values())
    got = []
    for passed in (100, 333, 1000):
        assert handle["timer"] == min(r[0] for r in given if r[0] // 1000 >= (100 if got else 0)) // 1000 + 1 or passed == 1000
        for frame in rolling.handleExpiredTimer(("a",), Clock(passed), None):
            assert len(frame) <= 50
            got.extend(tuple(None if v is pd.NA else v for v in r) for r in frame[[*names, "rate", "total"]].itertuples(index=False))
        assert len(got) == sum(r[0] // 1000 < passed for r in given)
    want, total = [], 0.0
    ordered = sorted(given, key=lambda r: (r[0], r[1] is None, r[1] or 0))
    for k, row in enumerate(ordered):
        last = ordered[max(0, k - 2):k + 1]
        spent, done = (sum(r[c] for r in last if r[c] is not None) for c in (2, 3))
        total += row[3] or 0.0
        want.append((*row, done / spent if spent else None, total))
    assert got == want and not handle["parts"] and not handle["heads"]


def test_values_and_keys_of_any_type_pass_unchanged(spark, tmp_path):
    rows = spark.sql("""
        SELECT * FROM VALUES
          (CAST(NULL AS BIGINT), 9007199254740993L, CAST('NaN' AS DOUBLE), TIMESTAMP '2024-01-01 00:00:00.000001', array(1, NULL), X'00ff', 1.10BD, 'a"\\n'),
          (NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL),
          (9007199254740993L, -1L, CAST('-Infinity' AS DOUBLE), TIMESTAMP '1900-01-01 00:00:00', array(), X'', -0.01BD, '')
        AS t(k, n, x, ts, many, raw, exact, said)""")
    rows.coalesce(1).write.parquet(str(tmp_path / "feed"))
    stream, out, progress = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "feed")), str(tmp_path / "out"), str(tmp_path / "progress")
    groups = streaming.count_or_age_groups(stream, ["k"], 0, 1)
    assert groups.columns == ["k", "shard", "flush_no", "reason", "n", "x", "ts", "many", "raw", "exact", "said"]
    streaming.flush_what_is_there(groups, table(out), progress).awaitTermination()
    shown = lambda df: sorted(str(tuple(r)) for r in df.select(*rows.columns).collect())
    assert shown(spark.read.parquet(out)) == shown(rows)


def test_rolling_rate_leaves_out_rows_without_a_time(spark, feed, tmp_path):
    add, stream = feed
    add((1, 2, "2024-01-01 00:00:01", "a"), (2, 2, "none", "a"), (3, 4, "2024-01-01 00:00:01", "a"))
    add((9, 1, "2024-01-01 00:10:00", "a"))
    ready = stream().withColumn("ts", F.expr("try_cast(t AS timestamp)")).select(
        "kind", "ts", F.when(F.col("id") > 1, F.col("id")).alias("id"), F.col("user_id").alias("took"), F.when(F.col("id") > 1, F.lit(float("nan"))).alias("done"))
    out = str(tmp_path / "out")
    rates = streaming.stream_rolling_rate(ready, "kind", "ts", "id", "took", "done", n=3)
    streaming.micro_batch_flush(rates, table(out), str(tmp_path / "progress")).awaitTermination()
    got = sorted(str((r.id, r.took, r.done, r.rate, r.total)) for r in spark.read.parquet(out).collect())
    assert got == sorted([str((3, 4.0, float("nan"), float("nan"), float("nan"))), str((None, 2.0, None, float("nan"), float("nan")))])
