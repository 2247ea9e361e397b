"""Request bodies as a stream (SRC-1, SRC-2, STR-3, STR-4, AGG-7).

A row is one request: its ``payload`` (a JSON array of updates, or one update
where ``single`` is set), its order of arrival, and what came with it (``sig``,
``ip_address``, ``ts``). One ``foreachBatch`` flow decodes the bodies, judges
each as a whole, folds the accepted ones into the state table and sends one
audit event for each of them, an empty one too. Nothing of a micro-batch is
gathered in one row: the ids of an event come from its own body.

A sender that got no answer sends the same body again. Such copies are known by
a digest of sender, time of sending and body, kept in Spark's state store until
the watermark passes (``drop_resent``), so they are folded once, whichever
micro-batch they fall into. Equal bodies sent at other times are requests of
their own.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from metricfold.operators.audit import payload_events
from metricfold.plans.flows import ingest_payloads
from metricfold.sinks.events import Sink
from metricfold.sources.updates import payload_ids, payload_verdicts
from metricfold.streaming.ingest import _trigger, checkpoint_for

log = logging.getLogger(__name__)


def body_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Request bodies from a folder of files, each file one body (``.gz`` files
    are decoded by the reader): ``request`` (the file), ``payload``, ``ts`` and
    ``arrival`` (its time in microseconds)."""
    r = spark.readStream.format("text").option("wholetext", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).select(
        F.col("_metadata.file_path").alias("request"), F.col("value").alias("payload"),
        F.col("_metadata.file_modification_time").alias("ts"),
        F.unix_micros("_metadata.file_modification_time").alias("arrival"))


def as_batches(bodies: DataFrame, single_col: str) -> DataFrame:
    """SRC-2 beside SRC-1 in one stream: a body of one update becomes a batch
    of one, with its kind compared in any case; batches pass unchanged. A
    single body that is no object, or that the single-update rule refuses,
    becomes a body that is rejected."""
    from metricfold.sources.updates import parse_json_update
    one = parse_json_update(bodies.withColumn("_p", F.col("payload")), "_p")
    array = F.to_json(F.array(F.struct("id", F.col("mtype").alias("type"), "delta", "value")))
    return one.withColumn("payload", F.when(~F.col(single_col), F.col("payload")).when(
        F.col("reject_reason").isNull(), array).otherwise(F.lit("rejected"))).select(*bodies.columns)


def drop_resent(bodies: DataFrame, within: str = "10 minutes", ts_col: str = "ts",
                sender_col: str | None = "ip_address") -> DataFrame:
    """STR-4: one row for each request however often its sender sent it, as
    long as copies come within ``within`` of each other (of event time)."""
    sender = [F.col(sender_col).cast("string")] if sender_col in bodies.columns else []
    parts = [*sender, F.col(ts_col).cast("string"), F.col("payload")]
    digest = F.sha2(F.to_json(F.array(*[F.coalesce(p, F.lit("")) for p in parts])), 256)
    return bodies.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withColumn("_digest", digest) \
        .withWatermark(ts_col, within).dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")


def start_request_writer(bodies: DataFrame, root: str, name: str, order_col: str = "arrival",
                         every: str | None = None, key: str | None = None,
                         audit_sinks: dict[str, Sink] | None = None, resent_within: str | None = None,
                         ts_col: str = "ts", ip_col: str | None = "ip_address", replay_audit: bool = False,
                         on_batch: Callable[[int, dict], None] | None = None) -> StreamingQuery:
    """Decode, judge, fold and audit a stream of request bodies; the state is
    the table at ``root``, written by this stream alone. ``order_col`` is the
    order of arrival, unique per body. Each micro-batch's accounting goes to
    ``on_batch(batch_id, accounting)``."""
    spark = bodies.sparkSession
    stream = drop_resent(bodies, resent_within, ts_col) if resent_within else bodies

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        done = ingest_payloads(spark, batch, root, batch_id, order_col, key, audit_sinks, ts_col=ts_col,
                               ip_col=ip_col if ip_col in batch.columns else None, replay_audit=replay_audit)
        for sink, error in done["audit"].items():
            if error:
                log.warning("audit sink %s failed on batch %s: %s", sink, batch_id, error)
        if on_batch:
            on_batch(batch_id, done)

    w = stream.writeStream.option("checkpointLocation", checkpoint_for(spark, name)).foreachBatch(per_batch)
    return _trigger(w, every).start()


def request_events(bodies: DataFrame, order_col: str = "arrival", ts_col: str = "ts",
                   ip_col: str = "ip_address") -> DataFrame:
    """AGG-7 as a stateless stream: the audit event of every accepted body, for
    sinks that are stream writers themselves (see ``sinks.observer``)."""
    ok = payload_verdicts(bodies, keep_parsed=True).where("accepted")
    return payload_events(ok, order_col, payload_ids(), F.col(ts_col),
                          F.col(ip_col) if ip_col in bodies.columns else F.lit(""))
