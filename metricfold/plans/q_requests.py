"""Queries: request bodies and agents as streams (SRC-1, STR-3, STR-4, AGG-6,
AGG-7, SNK-5, SNK-6)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricfold.plans.catalog import register
from metricfold.plans.q_ingest import _BATCH_VERDICT_SQL, _READ_BATCH_SQL, _SINGLE_SQL
from metricfold.plans.q_samples import _REPORT_SQL
from metricfold.session import checkpoint_root
from metricfold.sinks import events as ev
from metricfold.sinks import observer
from metricfold.sinks import state_table as tbl
from metricfold.sinks.snapshot import delete_path, list_children
from metricfold.sources import fixtures as fx
from metricfold.streaming import agent, ingest, requests

# The state after all accepted bodies in their order of arrival.
_BODIES_SQL = f"""
SELECT id, type AS mtype, CAST(sum(CASE WHEN type = 'counter' THEN delta END) AS BIGINT) AS delta,
       arg_max(CASE WHEN type = 'gauge' THEN value END, batch_id * 100000 + pos) AS value
FROM ({_READ_BATCH_SQL}) r
WHERE (type = 'counter' AND delta IS NOT NULL) OR (type = 'gauge' AND value IS NOT NULL)
GROUP BY id, type"""

# One event for each accepted body, with its ids in order; none for an empty one.
_EVENTS_SQL = f"""
SELECT q.batch_id, to_json({{'ts': epoch_us(q.ts) // 1000, 'metrics': coalesce(m.ids, CAST([] AS VARCHAR[])),
                            'ip_address': q.ip_address}}) AS value
FROM ({fx.request_bodies_sql()}) q
JOIN ({_BATCH_VERDICT_SQL}) v ON v.batch_id = q.batch_id AND v.accepted
LEFT JOIN (SELECT batch_id, list(id ORDER BY pos) AS ids FROM ({_READ_BATCH_SQL}) r GROUP BY batch_id) m
  ON m.batch_id = q.batch_id"""


def _turns(spark, bodies, name: str, turns: int = 3):
    """Bodies arrive in turns, by their order of arrival: after each one, the
    stream over all that has landed. A turn is as many files as its rows fill
    (they are worked out once), and one micro-batch if the stream runs then."""
    tag, when = uuid.uuid4().hex, "_turn"
    sent, land = (f"{checkpoint_root(spark)}/{name}-{x}-{tag}" for x in ("sent", "in"))
    last = bodies.agg(F.max("arrival")).first()[0] or 0
    turn = F.floor(F.col("arrival") * turns / (last + 1))
    bodies.withColumn(when, turn.cast("int")).write.partitionBy(when).parquet(sent)
    kept = spark.read.schema(T.StructType([*bodies.schema.fields, T.StructField(when, T.IntegerType())])).parquet(sent)
    for i in range(turns):
        kept.where(F.col(when) == i).drop(when).write.mode("append").parquet(land)
        yield spark.readStream.schema(bodies.schema).parquet(land)


@register("stream_payloads", _BODIES_SQL)
def q_stream_payloads(spark, sf_dir):
    """SRC-1 as a stream: request bodies arrive in three micro-batches; each is
    decoded, judged as a whole, folded and upserted in one flow."""
    root, tag = f"{checkpoint_root(spark)}/bodies-state-{uuid.uuid4().hex}", uuid.uuid4().hex
    for stream in _turns(spark, fx.request_bodies(spark, sf_dir), "bodies"):
        requests.start_request_writer(stream, root, f"bodies-{tag}").awaitTermination()
    return tbl.read_state(spark, root)


@register("stream_singles", f"""
SELECT id, mtype, CAST(sum(CASE WHEN mtype = 'counter' THEN delta END) AS BIGINT) AS delta,
       arg_max(CASE WHEN mtype = 'gauge' THEN value END, seq) AS value
FROM ({_SINGLE_SQL}) s WHERE reject_reason IS NULL GROUP BY id, mtype""")
def q_stream_singles(spark, sf_dir):
    """SRC-2 as a stream: bodies of one update each, admitted by the
    single-update rule (kinds in any case, reasons for the rest)."""
    one = fx.json_payloads(spark, sf_dir).select(F.col("seq").alias("arrival"), "payload", F.lit(True).alias("single"),
                                                 F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"))
    root, tag = f"{checkpoint_root(spark)}/singles-state-{uuid.uuid4().hex}", uuid.uuid4().hex
    for stream in _turns(spark, one, "singles"):
        requests.start_request_writer(requests.as_batches(stream, "single"), root, f"singles-{tag}").awaitTermination()
    return tbl.read_state(spark, root)


@register("stream_audit", _EVENTS_SQL)
def q_stream_audit(spark, sf_dir):
    """STR-3 + AGG-7 + SNK-4: the audit lines that the request writer leaves
    after each state write: one event for each accepted request with its own
    ids, empty requests too, over three micro-batches."""
    base, tag = checkpoint_root(spark), uuid.uuid4().hex
    audit, outcomes = f"{base}/audit-lines-{tag}", {}
    for stream in _turns(spark, fx.request_bodies(spark, sf_dir), "audited"):
        requests.start_request_writer(stream, f"{base}/audit-state-{tag}", f"audited-{tag}",
                                      audit_sinks={"file": lambda df: ev.write_audit_batch(df, audit)},
                                      on_batch=outcomes.__setitem__).awaitTermination()
    if not outcomes or any(o["audit"] != {"file": None} for o in outcomes.values()):
        raise RuntimeError(f"audit failed: {outcomes}")
    lines = ev.read_audit_batches(spark, audit)
    if spark.read.text(audit).count() != lines.count():
        raise RuntimeError("the audit text and its table differ")
    return lines


@register("stream_resent", _BODIES_SQL)
def q_stream_resent(spark, sf_dir):
    """STR-4: every third request is sent again, with the next micro-batch or
    the one after, and folded once."""
    sent = fx.request_bodies(spark, sf_dir)
    last = sent.agg(F.max("arrival")).first()[0] or 0
    again = sent.where("arrival % 3 = 0").withColumn("arrival", F.col("arrival") + last + 1)
    both, land = sent.unionByName(again), f"{checkpoint_root(spark)}/resent-in-{uuid.uuid4().hex}"
    for part in (both.where(f"arrival <= {last // 2}"), both.where(f"arrival > {last // 2} AND arrival <= {last + last // 2}"),
                 both.where(f"arrival > {last + last // 2}")):
        part.coalesce(1).write.mode("append").parquet(land)
    stream = spark.readStream.schema(both.schema).option("maxFilesPerTrigger", 1).parquet(land)
    root, tag = f"{checkpoint_root(spark)}/resent-state-{uuid.uuid4().hex}", uuid.uuid4().hex
    requests.start_request_writer(stream, root, f"resent-{tag}", resent_within="60 days").awaitTermination()
    return tbl.read_state(spark, root)


@register("stream_observer", _EVENTS_SQL)
def q_stream_observer(spark, sf_dir):
    """SNK-5: events of the request stream go to an observer that is a stream
    writer itself. The stream is killed before Spark notes its last epoch and
    started again; the repeated epoch replaces its lines."""
    spark.dataSource.register(observer.AuditLines)
    base, name = checkpoint_root(spark), f"observer-{uuid.uuid4().hex}"
    lines, notes = f"{base}/lines-{name}", ingest.checkpoint_for(spark, name)

    def run(stream):
        requests.request_events(stream).select("line").writeStream.format("audit_lines").option("path", lines) \
            .option("checkpointLocation", notes).trigger(availableNow=True).start().awaitTermination()

    for stream in _turns(spark, fx.request_bodies(spark, sf_dir), "observed"):
        run(stream)
    done = [int(c) for c in list_children(spark, f"{notes}/commits") if c.isdigit()]
    for note in (f"{max(done)}", f".{max(done)}.crc"):
        delete_path(spark, f"{notes}/commits/{note}")
    run(stream)
    line = F.from_json("value", "ts bigint, metrics array<string>, ip_address string")
    sent = fx.request_bodies(spark, sf_dir).select(F.col("arrival").alias("batch_id"), F.unix_millis(
        F.col("ts").cast("timestamp")).alias("_ts"), F.col("ip_address").alias("_ip"))
    got = spark.read.text(f"{lines}/*.jsonl").withColumn("_l", line)
    return got.join(sent, (got["_l.ts"] == sent["_ts"]) & (got["_l.ip_address"] == sent["_ip"])).select("batch_id", "value")


@register("stream_reports", _REPORT_SQL + "\nSELECT * FROM rep")
def q_stream_reports(spark, sf_dir):
    """AGG-6 + SNK-6 live: samples arrive as a file stream, in no order within
    the watermark; each host's merged sample and poll count live in the state
    store and a timer sends the report as each window closes."""
    base, tag = checkpoint_root(spark), uuid.uuid4().hex
    land, out = f"{base}/agent-in-{tag}", f"{base}/agent-out-{tag}"
    w = fx.wide(spark, sf_dir)
    w.repartition("ord").write.parquet(land)
    ingest.closing_row(spark, w.schema).write.mode("append").parquet(land)
    stream = spark.readStream.schema(w.schema).parquet(land)
    agent.report_stream(stream, 86_400, "1 hour").writeStream.format("parquet").option("path", out) \
        .option("checkpointLocation", ingest.checkpoint_for(spark, f"agent-{tag}")) \
        .trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
