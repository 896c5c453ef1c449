"""Stream operators with state of their own: buffers, closed windows, seen keys, rolling spans.

Each is a ``StatefulProcessor`` whose state Spark shards by key, checkpoints with the query and restores
after a restart, so nothing is lost or repeated. Keys that may be hot take a ``shards`` argument that
deals their rows to several states.
"""

from __future__ import annotations

import heapq
import time
from collections import deque
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.search import match_any_phrase

_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def _shard(key_cols: Sequence[str], shards: int, spread: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*(spread or key_cols)), F.lit(shards)).cast("int")


# Rows of one frame of output.
FRAME_ROWS = 10_000
# Keys and whole rows pass through Python as text, so that no type, null or NaN changes on the way.
_TEXT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timeZone": "UTC"}


def _packed(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns), _TEXT)


def _unpacked(column: str, fields: Sequence[T.StructField]) -> Column:
    return F.from_json(column, T.StructType(list(fields)), _TEXT)


# --- flush by count or age -------------------------------------------------------------------

class _Buffer(StatefulProcessor):
    """Rows of a key until there are more than ``most`` or the first of them is ``age_ms`` old.

    Flushes go out in frames while the input is read, so a task holds a frame of a key, not all its rows.
    """

    def __init__(self, most: int, age_ms: int):
        self.most, self.age_ms = most, age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "row string")
        self.place = handle.getValueState("place", "held bigint, flushes bigint, due bigint")

    def _frame(self, key: tuple, flushed: list[tuple[int, str, str]]) -> pd.DataFrame:
        return pd.DataFrame(flushed, columns=["flush_no", "reason", "row"]).assign(key=key[0], shard=key[1])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - the interface's names
        held, flushes, due = self.place.get() if self.place.exists() else (0, 0, 0)
        news: list[str] = []
        out: list[tuple[int, str, str]] = []
        for frame in rows:
            for row in frame["row"]:
                news.append(row)
                if held + len(news) > self.most:
                    if held:
                        out.extend((flushes, "count", r[0]) for r in self.rows.get())
                        self.rows.clear()
                    out.extend((flushes, "count", r) for r in news)
                    held, news, flushes = 0, [], flushes + 1
                    due = self._cancel(due)
                    if len(out) >= FRAME_ROWS:
                        yield self._frame(key, out)
                        out = []
        if out:
            yield self._frame(key, out)
        if news:
            self.rows.appendList([(r,) for r in news])
            held += len(news)
            if not due:
                due = timerValues.getCurrentProcessingTimeInMs() + self.age_ms
                self.handle.registerTimer(due)
        self.place.update((held, flushes, due))

    def _cancel(self, due: int) -> int:
        if due:
            self.handle.deleteTimer(due)
        return 0

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held, flushes, _ = self.place.get()
        if held:
            yield self._frame(key, [(flushes, "age", r[0]) for r in self.rows.get()])
            self.rows.clear()
            flushes += 1
        self.place.update((0, flushes, 0))

    def close(self) -> None:
        pass


def _with_pulse(stream: DataFrame) -> DataFrame:
    """The stream with a clock beside it that adds no row.

    After a restart timers are only looked at once there has been input; the clock is that input, so rows
    held from before the restart come out also if the feed is silent.
    """
    clock = stream.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load().where(F.col("value") < 0)
    return stream.unionByName(clock.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields]))


def count_or_age_groups(
    stream: DataFrame, by: Sequence[str], most: int, seconds: float, shards: int = 1, spread: Sequence[str] = (),
) -> DataFrame:
    """Rows as (by..., shard, flush_no, reason, other columns), held back until their group is flushed.

    A group is flushed when it holds more than ``most`` rows, so with ``most + 1``, or when its first row
    has waited ``seconds`` of processing time; all rows of a flush come out in one micro-batch. ``shards``
    splits the rows of each key by a hash of ``spread``. State is at most ``most`` rows for each group.
    The age needs a trigger that keeps running, as that of ``flush_rest``.
    """
    values = [c for c in stream.columns if c not in by]
    ready = _with_pulse(stream).select(_packed(by).alias("key"), _shard(by, shards, spread).alias("shard"), _packed(values).alias("row"))
    out = T.StructType([
        T.StructField("key", T.StringType()), T.StructField("shard", T.IntegerType()), T.StructField("flush_no", T.LongType()),
        T.StructField("reason", T.StringType()), T.StructField("row", T.StringType())])
    flushed = ready.groupBy("key", "shard").transformWithStateInPandas(_Buffer(most, int(seconds * 1000)), out, "append", "ProcessingTime")
    fields = stream.schema
    return flushed.select(
        _unpacked("key", [fields[c] for c in by]).alias("key"), "shard", "flush_no", "reason", _unpacked("row", [fields[c] for c in values]).alias("row"),
    ).select("key.*", "shard", "flush_no", "reason", "row.*")


def flush_what_is_there(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run over all input there is and stop; groups that are not full stay in the state."""
    stream.sparkSession.conf.set(_NO_DATA, "false")
    return stream.writeStream.foreachBatch(sink).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def held_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows that groups hold at the last finished micro-batch, as (key, row), packed as JSON text."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "rows").load()
    return state.select("key", F.col("list_element.row").alias("row"))


def flush_rest(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, timeout: float, interval: str = "1 second",
) -> None:
    """Run on with timers, until no group holds a row; for the end of a stream.

    Everything held comes out by its age. It leaves the state with the same micro-batch, so a later start
    from the checkpoint goes on with nothing held.
    """
    spark = stream.sparkSession
    spark.conf.set(_NO_DATA, "true")
    query = stream.writeStream.foreachBatch(sink).outputMode("append").option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()
    end = time.monotonic() + timeout
    try:
        while held_rows(spark, checkpoint).limit(1).count():
            if time.monotonic() > end:
                raise TimeoutError(f"rows still held after {timeout} s")
            if query.exception() is not None:
                raise query.exception()
            time.sleep(0.5)
    finally:
        query.stop()


# --- windows and what comes too late -----------------------------------------------------------

class _Windows(StatefulProcessor):
    """Hits of a window until it closes; rows after that are late."""

    def __init__(self, stride_us: int, row_type: T.StructType):
        self.stride_us, self.row_type = stride_us, row_type
        self.names = ("t0_us", "t1_us", "shard", "hits", "late")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.hits = handle.getValueState("hits", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        end_us, shard = key[0] + self.stride_us, key[1]
        closed = timerValues.getCurrentWatermarkInMs() * 1000 >= end_us
        n = 0
        for row in rows:
            if closed:
                yield Row(*self.names)(key[0], end_us, shard, None, Row(*self.row_type.names)(*tuple(row)[2:]))
            n += 1
        if not closed:
            known = self.hits.get()[0] if self.hits.exists() else 0
            self.hits.update((known + n,))
            if not known:
                # The first whole millisecond at or after the end.
                self.handle.registerTimer(-(-end_us // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        yield Row(*self.names)(key[0], key[0] + self.stride_us, key[1], self.hits.get()[0], None)
        self.hits.clear()

    def close(self) -> None:
        pass


def windows_and_late_rows(
    stream: DataFrame, ts: str, text: str | None = None, terms: Sequence[str] = (), delay: str = "60 seconds",
    stride_seconds: int = 30, shards: int = 8, spread: Sequence[str] = (),
) -> DataFrame:
    """Hits of closed windows and late rows of one search, as (t0_us, t1_us, shard, hits, late).

    Posts that match a phrase are counted in their window; the count comes out when the watermark,
    ``delay`` behind the latest post, reaches the window's end. A post of a window that is closed comes
    out itself, in ``late``, with its window: every matching post is in exactly one count or one late
    row. A window's rows are counted in ``shards`` states that close together; ``closed_windows`` adds them up.
    Posts without a time belong to no window and are left out.
    """
    hits = stream.where(match_any_phrase(F.col(text), terms)) if text and terms else stream
    hits = hits.where(F.col(ts).isNotNull()).withWatermark(ts, delay)
    stride_us = stride_seconds * 1_000_000
    us = F.unix_micros(ts)
    columns = [c for c in hits.columns if c != ts]
    # The time travels as a plain column: rows behind the watermark are to be told apart, not dropped.
    ready = hits.select(
        (us - F.pmod(us, F.lit(stride_us))).alias("t0_us"), _shard([ts], shards, spread).alias("shard"),
        F.timestamp_micros(us).alias(ts), *columns)
    row_type = T.StructType(ready.schema.fields[2:])
    out = T.StructType([
        T.StructField("t0_us", T.LongType()), T.StructField("t1_us", T.LongType()), T.StructField("shard", T.IntegerType()),
        T.StructField("hits", T.LongType()), T.StructField("late", row_type)])
    return ready.groupBy("t0_us", "shard").transformWithState(_Windows(stride_us, row_type), out, "append", "EventTime")


def closed_windows(found: DataFrame) -> DataFrame:
    """(t0_us, t1_us, hits) of the windows that closed, from the stored output of ``windows_and_late_rows``."""
    return found.where(F.col("hits").isNotNull()).groupBy("t0_us", "t1_us").agg(F.sum("hits").alias("hits"))


def late_rows(found: DataFrame) -> DataFrame:
    """Late rows with their window."""
    return found.where(F.col("late").isNotNull()).select("t0_us", "t1_us", "late.*")


# --- users seen before -------------------------------------------------------------------------

class _Seen(StatefulProcessor):
    """Whether a key has been met within the time to live."""

    def __init__(self, name: str, ttl_ms: int | None):
        self.name, self.ttl_ms = name, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "at bigint", self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.seen.update((timerValues.getCurrentProcessingTimeInMs(),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        for _ in rows:
            pass
        if not self.seen.exists():
            yield Row(self.name)(key[0])
        self.seen.update((timerValues.getCurrentProcessingTimeInMs(),))

    def close(self) -> None:
        pass


def unseen_users_with_memory(stream: DataFrame, user_col: str, stored: DataFrame | None = None, ttl_seconds: float | None = None) -> DataFrame:
    """Each user the first time the stream meets them, and again if they were away for ``ttl_seconds``.

    Users that are not met for that long are forgotten, so the state follows the active users. ``stored``
    has the users that are known already: a query that starts with a new checkpoint takes them into its
    state and does not send them again.
    """
    users = stream.select(user_col).where(F.col(user_col).isNotNull())
    known = None
    if stored is not None:
        known = stored.select(F.col(user_col).cast(users.schema[user_col].dataType)).where(F.col(user_col).isNotNull()).distinct().groupBy(user_col)
    ttl = None if ttl_seconds is None else int(ttl_seconds * 1000)
    out = T.StructType([users.schema[user_col]])
    return users.groupBy(user_col).transformWithState(_Seen(user_col, ttl), out, "append", "ProcessingTime", known)


# --- rolling rate ----------------------------------------------------------------------------

# Waiting rows of a sorted run, and of a part of it that is stored and read as one.
RUN_ROWS, PART_ROWS = 100_000, 500


def _in_time(row: tuple) -> tuple:
    return row[0], row[1] is None, row[1]


class _Rolling(StatefulProcessor):
    """The last ``n`` operations of a name, and those that wait for the watermark.

    What waits is kept as sorted runs, stored in parts. Runs are merged by reading one part of each at a
    time, so a task holds a run of new rows or a part of each waiting run, never all rows of a name.
    """

    def __init__(self, n: int):
        # Rows are (time in microseconds, order, duration, value).
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "run bigint, part bigint", "us array<bigint>, place array<bigint>, duration array<double>, value array<double>")
        # The parts of a run that are left, and the time of its first row.
        self.heads = handle.getMapState("heads", "run bigint", "part bigint, parts bigint, us bigint")
        self.runs = handle.getValueState("runs", "n bigint")
        self.ring = handle.getListState("ring", "duration double, value double")
        self.total = handle.getValueState("total", "value double")

    def _store(self, run: int, rows: list[tuple]) -> int:
        """Store a run; the time of its first row."""
        rows.sort(key=_in_time)
        for k in range(0, len(rows), PART_ROWS):
            self.parts.updateValue((run, k // PART_ROWS), tuple(map(list, zip(*rows[k:k + PART_ROWS], strict=True))))
        self.heads.updateValue((run,), (0, -(-len(rows) // PART_ROWS), rows[0][0]))
        return rows[0][0]

    def _take(self, run: int, part: int, parts: int, passed: int) -> Iterator[tuple]:
        """The rows of a run that the watermark has passed, in order; they leave the state."""
        for p in range(part, parts):
            rows = [*zip(*self.parts.getValue((run, p)), strict=True)]
            for k, row in enumerate(rows):
                if row[0] // 1000 >= passed:
                    if k:
                        self.parts.updateValue((run, p), tuple(map(list, zip(*rows[k:], strict=True))))
                    self.heads.updateValue((run,), (p, parts, row[0]))
                    return
                yield row
            self.parts.removeKey((run, p))
        self.heads.removeKey((run,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        run = self.runs.get()[0] if self.runs.exists() else 0
        firsts, news = [], []
        for frame in rows:
            news.extend((r["us"], r["place"] if r["placed"] else None, r["duration"], r["value"]) for r in frame["row"])
            if len(news) >= RUN_ROWS:
                firsts.append(self._store(run, news))
                run, news = run + 1, []
        if news:
            firsts.append(self._store(run, news))
            run += 1
        self.runs.update((run,))
        if firsts:
            # One timer is enough to look again; the rows that are still early set the next one.
            self.handle.registerTimer(min(firsts) // 1000 + 1)
        yield from ()

    def _frame(self, key: tuple, rows: list[tuple]) -> pd.DataFrame:
        # Arrow columns keep null and NaN apart.
        whole, double = pa.int64(), pa.float64()
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (whole, whole, double, double, double, double), strict=True)]
        names = ("us", "place", "duration", "value", "rate", "total")
        return pa.table(columns, names=names).to_pandas(types_mapper=pd.ArrowDtype).assign(key=key[0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs()
        heads = sorted((*run, *head) for run, head in self.heads.iterator())
        ready = [self._take(run, part, parts, passed) for run, part, parts, us in heads if us // 1000 < passed]
        ring = deque((tuple(r) for r in self.ring.get()), self.n)
        total = self.total.get()[0] if self.total.exists() else 0.0
        out = []
        for row in heapq.merge(*ready, key=_in_time):
            duration, value = row[2:]
            ring.append((duration, value))
            spent = sum(d for d, _ in ring if d is not None)
            total += value or 0.0
            done = sum(v for _, v in ring if v is not None)
            out.append((*row, done / spent if spent else None, total))
            if len(out) == FRAME_ROWS:
                yield self._frame(key, out)
                out = []
        if out:
            yield self._frame(key, out)
        if ring:
            self.ring.put([*ring])
        self.total.update((total,))
        early = min((head[2] for _, head in self.heads.iterator()), default=None)
        if early is not None:
            self.handle.registerTimer(early // 1000 + 1)

    def close(self) -> None:
        pass


def stream_rolling_rate(
    stream: DataFrame, name: str, ts: str, order_col: str, duration: str, value: str, n: int = 20, delay: str = "0 seconds",
) -> DataFrame:
    """``operators.rolling_rate`` on a live feed: (name, ts_us, order, duration, value, rate, total).

    Operations may come in any order within ``delay``: a row waits until the watermark has passed its
    millisecond, and then counts in order of time and ``order_col`` (null last). Each name keeps its last ``n``
    operations, its total, and the rows that wait. Rows later than the watermark, or without a time, are left out.
    """
    place = F.col(order_col).cast("long")
    # Whole numbers beside nulls would reach Python as doubles.
    row = F.struct(
        F.unix_micros(ts).alias("us"), F.coalesce(place, F.lit(0)).alias("place"), place.isNotNull().alias("placed"),
        F.col(duration).cast("double").alias("duration"), F.col(value).cast("double").alias("value"))
    ready = stream.where(F.col(ts).isNotNull()).withWatermark(ts, delay).select(_packed([name]).alias("key"), row.alias("row"), ts)
    out = "us bigint, place bigint, duration double, value double, rate double, total double, key string"
    rates = ready.groupBy("key").transformWithStateInPandas(_Rolling(n), out, "append", "EventTime")
    return rates.select(
        _unpacked("key", [stream.schema[name]]).alias("key"), F.col("us").alias("ts_us"), F.col("place").alias(order_col),
        F.col("duration").alias(duration), F.col("value").alias(value), "rate", "total",
    ).select("key.*", "ts_us", order_col, duration, value, "rate", "total")
