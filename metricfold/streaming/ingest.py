"""Structured Streaming forms of the update and sample flows (STR-1..4,
SNK-2, AGG-4b).

* ``fold_stream``: continuous keyed state with Spark's own state store
  (``groupBy().agg(sum, max_by)`` in update mode) -- incremental, no
  rewrite of old state per micro-batch.
* ``start_state_writer``: the table form -- each micro-batch is folded and
  upserted into the state table (see ``sinks.state_table``) as the version of
  its ``batch_id``, so a replay after restart is skipped, then its audit events
  go to every sink, one for each request.
* ``start_snapshots``: JSON snapshots on a timer of its own, with or without data.
* ``poll_count_stream``: watermark + tumbling window, append mode, distinct
  polls; ``closing_row`` ends a recorded stream so that every window closes.

Request bodies as a stream are in ``streaming.requests``, the agent's merged
samples and reports in ``streaming.agent``. Checkpoints live under the
session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from metricfold.operators.audit import audit_events
from metricfold.operators.fold import fold_state
from metricfold.operators.samples import poll_count
from metricfold.session import checkpoint_root
from metricfold.sinks import state_table as tbl
from metricfold.sinks.events import Sink, fanout
from metricfold.sinks.snapshot import latest_snapshot, save_snapshot


log = logging.getLogger(__name__)

SNAPSHOT_SECONDS = 300.0  # between periodic snapshots, whatever the trigger


def checkpoint_for(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/streams/{name}"


def update_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming update source over a directory of files (new files are new
    batches). ``maxFilesPerTrigger`` is the back-pressure knob."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _trigger(writer, every: str | None):
    return writer.trigger(availableNow=True) if every is None else \
        writer.trigger(processingTime=every)


def fold_stream(updates: DataFrame, order_col: str = "seq") -> DataFrame:
    """STR-1: the AGG-3 fold over an unbounded update feed (update mode)."""
    return fold_state(updates, order_col)


def start_fold(updates: DataFrame, sink: Callable[[DataFrame, int], None], name: str,
               every: str | None = None, order_col: str = "seq") -> StreamingQuery:
    """Run ``fold_stream`` and pass each micro-batch of changed keys to
    ``sink(df, batch_id)``."""
    spark = updates.sparkSession
    w = fold_stream(updates, order_col).writeStream.outputMode("update") \
        .option("checkpointLocation", checkpoint_for(spark, name)).foreachBatch(sink)
    return _trigger(w, every).start()


def start_fold_table(updates: DataFrame, root: str, name: str, every: str | None = None,
                     order_col: str = "seq") -> StreamingQuery:
    """STR-1 with a durable sink: Spark's state store keeps the fold; every
    micro-batch of changed keys (update mode: their current values) replaces
    those keys in the state table at ``root``, as the version of its batch id.
    Read the state with ``sinks.state_table.read_state``."""
    spark = updates.sparkSession

    def sink(df: DataFrame, batch_id: int) -> None:
        tbl.apply_set(spark, root, df, batch_id)
    return start_fold(updates, sink, name, every, order_col)


def start_state_writer(updates: DataFrame, root: str, name: str,
                       every: str | None = None, order_col: str = "seq",
                       strict: bool = False, quarantine: str | None = None,
                       audit_sinks: dict[str, Sink] | None = None,
                       snapshot_root: str | None = None,
                       snapshot_seconds: float = SNAPSHOT_SECONDS,
                       request_col: str = "batch_id", ip_col: str = "ip_address",
                       replay_audit: bool = False,
                       on_audit: Callable[[int, dict], None] | None = None) -> StreamingQuery:
    """STR-1/3/4 + SNK-2/3/5 + AGG-4b: micro-batch upsert into the state
    table, then audit events to the sinks (only after the state is stored).

    The stream is the table's only writer; a micro-batch is known by its id.
    ``request_col`` names the request that a row came with: each request is one
    event, however the rows fall into micro-batches' files (a request's rows
    must arrive together). Bodies that may be empty go through
    ``streaming.requests`` instead, where an empty one has its event too.

    Audit events are at-most-once per request by default (a crash between the
    state write and the audit write loses them, as the reference's
    fire-and-forget publish does). With idempotent sinks (e.g.
    ``write_audit_batch``) pass ``replay_audit=True``: a replayed batch then
    re-emits its events, which makes the audit effectively-once like the
    state. Each batch's outcome by sink (None or the error) goes to
    ``on_audit(batch_id, outcome)``; errors are logged as warnings too.

    ``every`` is the trigger interval. ``snapshot_root`` gets JSON snapshots: one
    every ``snapshot_seconds`` from a timer that needs no data (the reference
    saves every 300 s) as long as the stream runs, or with each batch if that
    is 0, and a last one from ``close_state_writer``.
    """
    spark = updates.sparkSession

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        replay = tbl.already_applied(spark, root, batch_id)
        if replay and not (replay_audit and audit_sinks):
            return  # replayed micro-batch: state already holds it
        batch.persist(StorageLevel.MEMORY_AND_DISK)  # read by apply, checks and audit
        try:
            _apply(batch, batch_id, replay)
        finally:
            batch.unpersist()

    def _apply(batch: DataFrame, batch_id: int, replay: bool) -> None:
        if not replay:
            if strict:
                done = tbl.apply_strict_batch(spark, root, batch, batch_id, order_col, quarantine)
            else:
                done = tbl.apply_batch(spark, root, batch, batch_id, order_col)
            if done is None:
                return
            if snapshot_root and not snapshot_seconds:
                save_snapshot(tbl.read_state(spark, root), snapshot_root, batch_id)
        if audit_sinks:
            ip = F.col(ip_col) if ip_col in batch.columns else F.lit("")
            key = request_col if request_col in batch.columns else None
            ev = audit_events(batch.withColumn("_ip", ip).withColumn("_request", F.col(key) if key else F.lit(batch_id)),
                              batch_col="_request", order_col=order_col, ip_col="_ip")
            outcome = fanout(ev, audit_sinks)
            for sink, error in outcome.items():
                if error:
                    log.warning("audit sink %s failed on batch %s: %s", sink, batch_id, error)
            if on_audit:
                on_audit(batch_id, outcome)

    w = updates.writeStream.option("checkpointLocation", checkpoint_for(spark, name)) \
        .foreachBatch(per_batch)
    query = _trigger(w, every).start()
    if snapshot_root and snapshot_seconds and every is not None:
        _TIMERS[query.id] = start_snapshots(spark, root, snapshot_root, f"{name}-snapshots", snapshot_seconds)
    return query


_TIMERS: dict[str, StreamingQuery] = {}


def start_snapshots(spark: SparkSession, root: str, snapshot_root: str, name: str,
                    seconds: float = SNAPSHOT_SECONDS) -> StreamingQuery:
    """SNK-2: a snapshot of the state table every ``seconds``, whether or not
    updates arrive. Spark's rate source is the clock; a run that a restart
    repeats saves the newest state under the same number of its own."""
    first = time.time_ns() // 1_000_000  # later runs write later numbers

    def save(_: DataFrame, tick: int) -> None:
        if tbl.latest(spark, root) is not None:
            save_snapshot(tbl.read_state(spark, root), snapshot_root, first + tick)

    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return clock.writeStream.option("checkpointLocation", checkpoint_for(spark, f"{name}-{first}")) \
        .trigger(processingTime=f"{seconds} seconds").foreachBatch(save).start()


def close_state_writer(spark: SparkSession, query: StreamingQuery, root: str,
                       snapshot_root: str | None = None) -> str | None:
    """Stop a state writer (and its snapshot timer) and, like the reference on
    close, save a final snapshot of the state. Returns the snapshot path."""
    query.stop()
    timer = _TIMERS.pop(query.id, None)
    if timer is not None:
        timer.stop()
    last = tbl.latest(spark, root)
    if snapshot_root is None or last is None:
        return None
    newest = latest_snapshot(spark, snapshot_root)
    number = max(last, int(newest.rsplit("-", 1)[1]) if newest else -1) + 1
    return save_snapshot(tbl.read_state(spark, root), snapshot_root, number)


def poll_count_stream(samples: DataFrame, every: str = "10 seconds",
                      watermark: str = "30 seconds", key: str = "host",
                      ts_col: str = "ts", poll_col: str | None = None) -> DataFrame:
    """STR-2: polls per host per report window over a sample stream; a
    window is emitted once the watermark passes its end (append mode).
    Naive timestamps are read as UTC instants (watermarks need TIMESTAMP).

    ``poll_col`` names the poll that a row belongs to, for polls that leave a
    row for each provider: later rows of a poll are dropped by a deduplication
    inside the watermark before the window counts. Rows without a host
    (``closing_row``) only move the watermark."""
    s = samples.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, watermark) \
        .where(hosted(key, ts_col))
    if poll_col:
        s = s.dropDuplicatesWithinWatermark([key, poll_col])
    return poll_count(s, every, key, ts_col)


def hosted(key: str, ts_col: str):
    """Rows with a host, as a condition that reads the event time too: it stays
    above the watermark, which so sees rows without a host (``closing_row``)."""
    return F.col(key).isNotNull() | (F.col(ts_col) == F.lit("0001-01-01 00:00:00").cast("timestamp"))


def closing_row(spark: SparkSession, schema, ts_col: str = "ts", after: str = "9000-01-01 00:00:00") -> DataFrame:
    """One row without a host, late enough to pass every window: landed last, it
    lets a recorded stream emit the windows and reports that are still open."""
    kind = schema[ts_col].dataType.simpleString()
    return spark.range(1).select(*[F.lit(after).cast(kind).alias(f.name) if f.name == ts_col
                                   else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def flush_poll_windows(samples: DataFrame, emitted: DataFrame, every: str = "10 seconds",
                       key: str = "host", ts_col: str = "ts") -> DataFrame:
    """STR-2, when a stream ends: the poll counts of the windows that its
    watermark has not closed, as a batch job. ``samples`` is the recorded input,
    ``emitted`` what the stream wrote; windows from the last emitted end on are
    open."""
    last = emitted.agg(F.max("window_end")).first()[0]
    s = samples.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    if last is not None:
        s = s.where(F.col(ts_col) >= F.lit(last))
    return poll_count(s, every, key, ts_col)
