"""End-to-end: agent reports -> forwarded payloads -> server ingest ->
state, audit and read side."""

import json
import os

from pyspark.sql import functions as F

from metricfold.operators import samples
from metricfold.plans import flows
from metricfold.sinks import events as ev
from metricfold.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_agent_to_server_round_trip(spark, scratch):
    w = fx.wide(spark, SF_SMALL)
    fwd = os.path.join(scratch, "fwd")
    flows.forward_reports(w, fwd, every="1 day", key="test_key", fields=list(fx.WIDE_FIELDS))
    payloads = flows.read_forwarded(spark, fwd).withColumn(
        "arrival", F.unix_millis(F.col("window_start").cast("timestamp")) * 1000 + F.col("host"))
    # One tampered body: its signature no longer verifies.
    tampered = payloads.withColumn(
        "payload", F.when(F.col("window_start") == F.lit("2024-01-01").cast("timestamp_ntz"),
                          F.regexp_replace("payload", "PollCount", "PollCounts")).otherwise(F.col("payload")))
    n_tampered = payloads.where(F.col("window_start") == F.lit("2024-01-01").cast("timestamp_ntz")).count()
    root, audit_path = os.path.join(scratch, "state"), os.path.join(scratch, "audit")
    out = flows.ingest_payloads(spark, tampered, root, batch_id=0, order_col="arrival", key="test_key",
                                audit_sinks={"file": lambda d: ev.write_audit(d, audit_path)})
    assert out["refused_signature"] == n_tampered
    assert out["accepted"] == payloads.count() - n_tampered and out["rejected"] == 0
    assert out["version"] == 0
    # The stored PollCount is the number of polls outside the tampered day.
    kept = w.where(F.to_date("ts") != F.lit("2024-01-01").cast("date")).count()
    res = flows.read_side(spark, root, spark.createDataFrame(
        [(1, "PollCount", "counter"), (2, "Alloc", "GAUGE"), (3, "nope", "gauge")],
        "seq long, id string, type string"))
    hits = {r.seq: (r.delta_found, r.value_found) for r in res["hits"].collect()}
    assert hits[1] == (kept, None) and 2 in hits
    assert [r.seq for r in res["missing"].collect()] == [3]
    assert any(line.startswith("PollCount = ") for line in
               (r.line for r in res["listing"].collect()))
    events = [json.loads(r.value) for r in spark.read.text(audit_path).collect()]
    assert len(events) == out["accepted"]
    # Replay of the same batch id is a no-op.
    again = flows.ingest_payloads(spark, tampered, root, batch_id=0, order_col="arrival", key="test_key")
    assert again["version"] is None


def test_report_gauges_match_per_host_merge(spark):
    w = fx.wide(spark, SF_SMALL)
    rep = samples.report_batches(w, list(fx.WIDE_FIELDS), every="1 day")
    pay = ev.forward_payloads(rep)
    assert pay.count() == rep.select("host", "window_start").distinct().count()


def test_arrival_order_comes_from_the_order_column(spark, scratch):
    # The newer body lies in the larger file, which is read first.
    body = lambda v, pad: '[{"id":"g","type":"gauge","value":%s,"note":"%s"}]' % (v, pad)
    land = os.path.join(scratch, "in")
    for n, v, pad in ((2, 2.0, "x" * 100_000), (1, 1.0, "")):
        spark.createDataFrame([(n, body(v, pad))], "n long, payload string").coalesce(1).write.mode("append").parquet(land)
    root = os.path.join(scratch, "state")
    out = flows.ingest_payloads(spark, spark.read.parquet(land), root, 0, order_col="n",
                                audit_sinks={"ok": lambda d: d.collect(), "bad": lambda d: 1 / 0})
    from metricfold.sinks import state_table as tbl
    assert tbl.read_state(spark, root).first().value == 2.0
    assert out["audit"]["ok"] is None and "ZeroDivision" in out["audit"]["bad"]


def test_empty_body_is_an_audit_event(spark, scratch):
    d = spark.createDataFrame([(1, "[]"), (2, '[{"id":"a","type":"counter","delta":1}]')], "n long, payload string")
    path = os.path.join(scratch, "audit")
    flows.ingest_payloads(spark, d, os.path.join(scratch, "s"), 0, order_col="n",
                          audit_sinks={"f": lambda e: ev.write_audit(e, path)})
    assert sorted(len(json.loads(r.value)["metrics"]) for r in spark.read.text(path).collect()) == [0, 1]
