"""Queries: host samples and audit (SRC-6, FLT-8, PRJ-1/2, AGG-5/6/7,
SNK-4/6).

The merge oracles are *sequential*: a recursive CTE replays the collector
loop sample by sample, independent of the one-pass closed form Spark uses.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from metricfold.operators import audit, samples
from metricfold.plans.catalog import UPDATES, register, with_views
from metricfold.schemas import CPU_FIELD, HOST_FIELDS, RUNTIME_FIELDS, SAMPLE_FIELDS
from metricfold.sources import fixtures as fx

WIDE = fx.wide_sql()
FIELDS = list(SAMPLE_FIELDS)
REPORT_EVERY = "1 day"


def _seq_merge_sql() -> str:
    """Recursive replay of the collector merge over `s` (needs rn per host)."""
    zero = "m.Alloc = 0 AND m.Sys = 0 AND m.TotalAlloc = 0"
    step = ",\n    ".join(
        f"CASE WHEN {zero} THEN s.{c} WHEN s.{c} <> 0 THEN s.{c} ELSE m.{c} END AS {c}" for c in FIELDS)
    step += f""",
    CASE WHEN {zero} THEN s.{CPU_FIELD} WHEN len(s.{CPU_FIELD}) > 0 THEN s.{CPU_FIELD} ELSE m.{CPU_FIELD} END AS {CPU_FIELD}"""
    cols = ", ".join([*FIELDS, CPU_FIELD])
    return f"""m AS (
  SELECT host, rn, {cols} FROM s WHERE rn = 1
  UNION ALL
  SELECT s.host, s.rn, {step}
  FROM m JOIN s ON s.host = m.host AND s.rn = m.rn + 1)"""


@register("merge_samples", f"""
WITH RECURSIVE wide AS ({WIDE}),
s AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY ord) AS rn FROM wide),
{_seq_merge_sql()}
SELECT m.host, {', '.join('m.' + c for c in FIELDS)}, CAST(to_json(m.{CPU_FIELD}) AS VARCHAR) AS {CPU_FIELD}
FROM m JOIN (SELECT host, max(rn) AS rn FROM s GROUP BY host) e ON e.host = m.host AND e.rn = m.rn""")
def q_merge_samples(spark, sf_dir):
    """AGG-6: merged sample per host over all its samples, all fields and the
    CPU list (as JSON text)."""
    return samples.merge_samples(fx.wide(spark, sf_dir), FIELDS).withColumn(CPU_FIELD, F.to_json(CPU_FIELD))


@register("sample_summary", f"""
WITH RECURSIVE wide AS ({WIDE}),
s AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY ord) AS rn FROM wide),
{_seq_merge_sql()}
SELECT m.host, printf('MemoryMetrics{{Alloc: %.2f, HeapAlloc: %.2f, Sys: %.2f}}', m.Alloc, m.HeapAlloc, m.Sys)
         AS summary
FROM m JOIN (SELECT host, max(rn) AS rn FROM s GROUP BY host) e ON e.host = m.host AND e.rn = m.rn""")
def q_sample_summary(spark, sf_dir):
    """SCL-5: the two-decimal summary text of each host's merged sample."""
    merged = samples.merge_samples(fx.wide(spark, sf_dir), FIELDS)
    return merged.select("host", samples.summary_text(merged).alias("summary"))


@register("build_update_batch", f"""
WITH RECURSIVE wide AS ({WIDE}),
s AS (SELECT *, time_bucket(INTERVAL '{REPORT_EVERY}', ts) AS ws,
             row_number() OVER (PARTITION BY host ORDER BY ord) AS rn FROM wide),
{_seq_merge_sql()},
last AS (SELECT host, ws, max(rn) AS rn, count(*) AS polls FROM s GROUP BY host, ws),
st AS (SELECT l.host, l.ws, {', '.join('m.' + c for c in FIELDS)}, m.{CPU_FIELD}
       FROM last l JOIN m ON m.host = l.host AND m.rn = l.rn)
SELECT host, ws AS window_start, id, 'gauge' AS type, CAST(NULL AS BIGINT) AS delta, value
FROM (UNPIVOT (SELECT * EXCLUDE ({CPU_FIELD}) FROM st) ON {', '.join(FIELDS)} INTO NAME id VALUE value) u
UNION ALL
SELECT host, ws, '{CPU_FIELD}' || CAST(i AS VARCHAR), 'gauge', CAST(NULL AS BIGINT), {CPU_FIELD}[i]
FROM st, unnest(generate_series(1, len({CPU_FIELD}))) AS t(i)
UNION ALL
SELECT host, ws AS window_start, 'PollCount' AS id, 'counter' AS type, polls AS delta,
       CAST(NULL AS DOUBLE) AS value
FROM last WHERE polls <> 0""")
def q_build_update_batch(spark, sf_dir):
    """SNK-6: per host and report window, the merged gauges (long form) plus
    the PollCount counter -- the update batch the agent forwards."""
    return samples.report_batches(fx.wide(spark, sf_dir), FIELDS, every=REPORT_EVERY)


_REPORT_SQL = f"""
WITH RECURSIVE wide AS ({WIDE}),
s AS (SELECT *, time_bucket(INTERVAL '{REPORT_EVERY}', ts) AS ws,
             row_number() OVER (PARTITION BY host ORDER BY ord) AS rn FROM wide),
{_seq_merge_sql()},
last AS (SELECT host, ws, max(rn) AS rn, count(*) AS polls FROM s GROUP BY host, ws),
st AS (SELECT l.host, l.ws, {', '.join('m.' + c for c in FIELDS)}, m.{CPU_FIELD}
       FROM last l JOIN m ON m.host = l.host AND m.rn = l.rn),
rep AS (
  SELECT host, ws AS window_start, id, 'gauge' AS type, CAST(NULL AS BIGINT) AS delta, value
  FROM (UNPIVOT (SELECT * EXCLUDE ({CPU_FIELD}) FROM st) ON {', '.join(FIELDS)} INTO NAME id VALUE value) u
  UNION ALL
  SELECT host, ws, '{CPU_FIELD}' || CAST(i AS VARCHAR), 'gauge', CAST(NULL AS BIGINT), {CPU_FIELD}[i]
  FROM st, unnest(generate_series(1, len({CPU_FIELD}))) AS t(i)
  UNION ALL
  SELECT host, ws AS window_start, 'PollCount' AS id, 'counter' AS type, polls AS delta,
         CAST(NULL AS DOUBLE) AS value
  FROM last WHERE polls <> 0)"""


@register("forward_payloads", _REPORT_SQL + f"""
SELECT host, window_start, payload, sha256('{fx.TEST_KEY}' || payload) AS sig
FROM (SELECT host, window_start,
        '[' || string_agg('{{"id":"' || id || '","type":"' || type || '"'
              || CASE WHEN delta IS NULL THEN '' ELSE ',"delta":' || CAST(delta AS VARCHAR) END
              || CASE WHEN value IS NULL THEN '' ELSE ',"value":' || CAST(value AS VARCHAR) END
              || '}}', ',' ORDER BY id) || ']' AS payload
      FROM rep GROUP BY host, window_start) p""")
def q_forward_payloads(spark, sf_dir):
    """SNK-6: the report batches as the signed JSON payload the agent posts
    (one per host and report window; signature over the uncompressed text)."""
    from metricfold.sinks.events import forward_payloads
    rep = samples.report_batches(fx.wide(spark, sf_dir), FIELDS, every=REPORT_EVERY, packed=True)
    return forward_payloads(rep, key=fx.TEST_KEY)


@register("poll_count", with_views(f"""
SELECT host, time_bucket(INTERVAL '{REPORT_EVERY}', ts) AS window_start,
       time_bucket(INTERVAL '{REPORT_EVERY}', ts) + INTERVAL '{REPORT_EVERY}' AS window_end,
       count(*) AS poll_count
FROM wide GROUP BY 1, 2, 3""", wide=WIDE))
def q_poll_count(spark, sf_dir):
    """AGG-5: polls per host per report window."""
    return samples.poll_count(fx.wide(spark, sf_dir), every=REPORT_EVERY)


@register("is_zero_sample", with_views("""
SELECT host, ord, (Alloc = 0 AND Sys = 0 AND TotalAlloc = 0) AS is_zero FROM wide""", wide=WIDE))
def q_is_zero_sample(spark, sf_dir):
    """FLT-8: the empty-sample test on every sample."""
    w = fx.wide(spark, sf_dir)
    return w.select("host", "ord", samples.is_zero_sample(w).alias("is_zero"))


@register("unpivot_samples", with_views(f"""
SELECT host, ord, id, value FROM (UNPIVOT wide ON {', '.join(FIELDS)} INTO NAME id VALUE value) u""",
                                        wide=f"SELECT * EXCLUDE ({CPU_FIELD}) FROM ({WIDE}) w"))
def q_unpivot_samples(spark, sf_dir):
    """PRJ-1: wide samples to (id, value) rows, zeros included."""
    return samples.unpivot_samples(fx.wide(spark, sf_dir).drop("ts", CPU_FIELD), FIELDS)


@register("explode_cpu", """
SELECT vec_id AS host, 'CPUutilization' || CAST(i AS VARCHAR) AS id,
       CAST(embedding[i] AS DOUBLE) AS value
FROM (SELECT vec_id, embedding, generate_subscripts(embedding, 1) AS i FROM embeddings) e""")
def q_explode_cpu(spark, sf_dir):
    """PRJ-2: per-core lists (the embedding vectors) to numbered rows."""
    return samples.explode_cpu(fx.cpu_samples(spark, sf_dir), ids=["host"])


def _read_samples_sql() -> str:
    def sel(provider: int, present: tuple[str, ...], cpu: str) -> str:
        cols = ["host", "ord", f"{provider} AS provider", "ts"] + [
            (f"CAST({f} AS DOUBLE) AS {f}" if f in present else f"CAST(0.0 AS DOUBLE) AS {f}")
            for f in SAMPLE_FIELDS] + [f"{cpu} AS {CPU_FIELD}"]
        return f"SELECT {', '.join(cols)} FROM ({WIDE}) w"
    return sel(0, RUNTIME_FIELDS, "'[]'") + "\nUNION ALL\n" \
        + sel(1, HOST_FIELDS, f"CAST(to_json({CPU_FIELD}) AS VARCHAR)")


@register("read_samples", _read_samples_sql())
def q_read_samples(spark, sf_dir):
    """SRC-6: two providers (runtime fields; host fields and the CPU list) record
    their samples as files; each is read through the provider data source, and
    a third that cannot be read is skipped. They are unioned by name and
    conformed to the full SAMPLE schema; the list is shown as JSON text."""
    import uuid

    from metricfold.session import checkpoint_root
    from metricfold.sources.recorded import recorded
    base = f"{checkpoint_root(spark)}/recorded-{uuid.uuid4().hex}"
    w = fx.wide(spark, sf_dir)
    w.select("host", "ord", "ts", *RUNTIME_FIELDS).write.parquet(f"{base}/runtime")
    w.select("host", "ord", "ts", *HOST_FIELDS, CPU_FIELD).write.parquet(f"{base}/host")
    frames, errors = samples.collect_providers(spark, [
        recorded(f"{base}/runtime", 0, list(RUNTIME_FIELDS)), recorded(f"{base}/host", 1, [*HOST_FIELDS, CPU_FIELD]),
        recorded(f"{base}/gone", 2)])
    if list(errors) != [2]:
        raise RuntimeError(f"providers skipped: {errors}")
    return samples.read_samples(frames).withColumn(CPU_FIELD, F.to_json(CPU_FIELD))


_AUDIT_SQL = """
SELECT batch_id, epoch_us(max(ts)) // 1000 AS ts, count(*) AS n_metrics, arg_min(ip_address, seq) AS ip_address,
       to_json({'ts': epoch_us(max(ts)) // 1000, 'metrics': list(id ORDER BY seq),
                'ip_address': arg_min(ip_address, seq)}) AS line
FROM (SELECT * EXCLUDE (batch_id), (seq + 10) // 20 AS batch_id FROM updates) u GROUP BY batch_id"""


def _audited(spark, sf_dir):
    # Batches of 20 rows that begin anywhere, across round numbers too.
    return fx.updates(spark, sf_dir).withColumn("batch_id", F.expr("(seq + 10) div 20"))


@register("audit_events", with_views(_AUDIT_SQL, updates=UPDATES))
def q_audit_events(spark, sf_dir):
    """AGG-7 + SCL-8 + SNK-4: one audit record per update batch (ids in
    arrival order, skipped rows included), as the JSON line appended."""
    ev = audit.audit_events(_audited(spark, sf_dir))
    return ev.select("batch_id", "ts", "n_metrics", "ip_address", "line")


STREAM_WATERMARK = "1 hour"


@register("stream_poll_count", with_views(f"""
SELECT host, time_bucket(INTERVAL '{REPORT_EVERY}', ts) AS window_start,
       time_bucket(INTERVAL '{REPORT_EVERY}', ts) + INTERVAL '{REPORT_EVERY}' AS window_end,
       count(*) AS poll_count
FROM wide GROUP BY 1, 2, 3""", wide=WIDE))
def q_stream_poll_count(spark, sf_dir):
    """STR-2: samples of two providers, a row each for every poll, arrive as a
    file stream; distinct polls are counted per host and report window with a
    watermark, in append mode, through Spark's exactly-once Parquet file sink,
    then read back. A closing row lets every window close. The landed files form
    one micro-batch, so no sample is late; the multi-batch case is in
    tests/test_streaming.py."""
    import uuid

    from metricfold.session import checkpoint_root
    from metricfold.streaming import ingest
    tag = uuid.uuid4().hex
    land = f"{checkpoint_root(spark)}/samples-in-{tag}"
    out = f"{checkpoint_root(spark)}/polls-out-{tag}"
    w = fx.wide(spark, sf_dir).select("host", "ord", "ts", F.explode(F.array(F.lit(0), F.lit(1))).alias("provider"))
    w.write.parquet(land)
    ingest.closing_row(spark, w.schema).write.mode("append").parquet(land)
    stream = spark.readStream.schema(w.schema).parquet(land)
    counts = ingest.poll_count_stream(stream, every=REPORT_EVERY, watermark=STREAM_WATERMARK, poll_col="ord")
    q = counts.writeStream.format("parquet").outputMode("append").option("path", out) \
        .option("checkpointLocation", ingest.checkpoint_for(spark, f"polls-{tag}")) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out).select(
        "host", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "poll_count")


@register("audit_fanout", with_views("SELECT batch_id, line AS value FROM events_of_batches",
                                     updates=UPDATES, events_of_batches=_AUDIT_SQL))
def q_audit_fanout(spark, sf_dir):
    """SNK-5 + SNK-4: audit events handed to three observers (append file,
    idempotent per-batch file, one that fails); the failure is isolated and
    the per-batch file is read back."""
    import uuid

    from metricfold.session import checkpoint_root
    from metricfold.sinks import events as ev
    tag = uuid.uuid4().hex
    base = checkpoint_root(spark)

    def broken(df):
        raise OSError("observer unavailable")

    errors = ev.fanout(audit.audit_events(_audited(spark, sf_dir)), {
        "append": lambda df: ev.write_audit(df, f"{base}/audit-append-{tag}"),
        "batch": lambda df: ev.write_audit_batch(df, f"{base}/audit-batch-{tag}"),
        "broken": broken})
    if errors["append"] or errors["batch"] or not errors["broken"]:
        raise RuntimeError(f"fan-out isolation failed: {errors}")
    lines = ev.read_audit_batches(spark, f"{base}/audit-batch-{tag}")
    if spark.read.text(f"{base}/audit-batch-{tag}").count() != lines.count():
        raise RuntimeError("the text and the table of the per-batch file differ")
    return lines
