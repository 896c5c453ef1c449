"""Streaming forms of the batch operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedupe import dedupe_keep_last
from ..operators.hydration import needs_hydration
from ..operators.search import match_any_phrase
from ..plans.social import archive_to_store
from ..sources.buckets import BucketStore
from ..sources.sinks import write_batch_table
from .compaction import batch_states, fold_states, nodes_of

BatchFn = Callable[[DataFrame, int], None]


def live_window_search(
    stream: DataFrame, ts: str, text: str | None, terms: Sequence[str] = (),
    delay: str = "60 seconds", stride: str = "30 seconds",
) -> DataFrame:
    """Hits per stride window of posts that match; posts later than ``delay`` are lost, as they are
    to a search that never reads a closed window again. ``windows_and_late_rows`` keeps those."""
    hits = stream.where(match_any_phrase(F.col(text), terms)) if text and terms else stream
    counted = hits.withWatermark(ts, delay).groupBy(F.window(ts, stride)).agg(
        F.count("*").alias("hits")
    )
    return counted.select(F.col("window.start").alias("t0"), F.col("window.end").alias("t1"), "hits")


def stream_dedupe(
    stream: DataFrame, keys: Sequence[str], ts: str, delay: str = "60 seconds"
) -> DataFrame:
    """First row of each key; a key is remembered for ``delay``, so state stays bounded."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_unseen_users(stream: DataFrame, user_col: str) -> DataFrame:
    """Each user the first time it is seen. The seen set lives in the query's state, sharded by
    user, and survives restarts with the same checkpoint. It grows with the number of users;
    ``unseen_users_with_memory`` forgets users and starts from the stored ones."""
    return stream.select(user_col).where(F.col(user_col).isNotNull()).dropDuplicates([user_col])


def _start(
    stream: DataFrame, fn: BatchFn, mode: str, trigger: dict, checkpoint: str
) -> StreamingQuery:
    # Windows close, and keys are forgotten, in micro-batches without input.
    stream.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    return (
        stream.writeStream.foreachBatch(fn).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def micro_batch_flush(
    stream: DataFrame, sink: BatchFn, checkpoint: str, trigger: str | None = None, mode: str = "append",
) -> StreamingQuery:
    """Flush by batch: every ``trigger`` interval, or with ``None`` everything that is there, then
    stop. Batch size is set where the stream is read (``maxFilesPerTrigger``,
    ``maxBytesPerTrigger``). ``checkpoint`` must be the same at every start of a query: batch ids,
    state and the place in the input live there."""
    how = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    return _start(stream, sink, mode, how, checkpoint)


def stream_hydration_filter(
    store_fn: Callable[[], DataFrame], write_fn: BatchFn, key: str = "id",
    order_cols: Sequence[str] = (),
) -> BatchFn:
    """``foreachBatch`` function: rows whose id is not stored in full go to ``write_fn``. The store
    is read again for every batch, so earlier batches' writes are seen."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_fn(needs_hydration(batch, store_fn(), key, order_cols), batch_id)

    return handle


def stream_backfill(
    stream: DataFrame, ts: str, stride: str, sink: BatchFn, checkpoint: str
) -> StreamingQuery:
    """Replay history through the live window count and stop. Complete mode: no window is late."""
    counted = live_window_search(stream, ts, None, (), "0 seconds", stride)
    return _start(counted, sink, "complete", {"availableNow": True}, checkpoint)


def overwrite_table(path: str) -> BatchFn:
    """Sink for complete mode: each batch holds the whole result, the newest folder counts."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch_table(batch, path, batch_id)

    return write


def latest_batch(df: DataFrame) -> DataFrame:
    """Rows of the newest batch folder of a complete-mode table."""
    return df.where(F.col("batch_id") == df.agg(F.max("batch_id")).scalar()).drop("batch_id")


# --- graph upsert ---------------------------------------------------------------------------

def stream_graph_upsert(
    store_path: str, as_of_fn: Callable[[int], str], key: str = "id",
    order_cols: Sequence[str] = (),
) -> BatchFn:
    """``foreachBatch`` function for continuous upserts of one node table.

    A batch is reduced to its last row per key and stored under its batch id: the cost follows the
    batch, not the store, and a repeated batch replaces itself. ``read_nodes`` folds the batches.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        rows = dedupe_keep_last(batch, [key], order_cols).withColumn(
            "as_of", F.lit(as_of_fn(batch_id)).cast("timestamp")
        )
        write_batch_table(rows, store_path, batch_id)

    return upsert


def stream_archive_to_graph(
    store: BucketStore, rows_of: Callable[[DataFrame], tuple[DataFrame, DataFrame, DataFrame]],
    as_of_fn: Callable[[int], str], order_cols: Sequence[str],
) -> BatchFn:
    """``foreachBatch`` function that writes each batch into a whole graph, as ``archive_to_store``.

    ``rows_of`` turns a batch into graph rows, mentions and links. A batch rewrites the buckets it
    touches and becomes one version of all tables; a repeated batch finds its number and does nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        archive_to_store(store, *rows_of(batch), as_of_fn(batch_id), order_cols, batch_id)

    return write


def read_nodes(batches: DataFrame, key: str = "id", keep: Sequence[str] = ("created_at",)) -> DataFrame:
    """The node table after all batches: last values win, ``keep`` columns hold their first
    non-null value, and the stamps say when a node came and when it last changed.

    Reads every batch there ever was; ``BatchLog`` folds old ones and reads the rest.
    """
    return nodes_of(fold_states(batch_states(batches, key, keep), key), key)
