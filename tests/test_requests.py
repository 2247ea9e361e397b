"""Request bodies, observers, recorded samples and the live agent as streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from metricfold.operators import samples
from metricfold.schemas import CPU_FIELD, SAMPLE_FIELDS
from metricfold.sinks import events as ev
from metricfold.sinks import observer
from metricfold.sinks import state_table as tbl
from metricfold.sources import fixtures as fx
from metricfold.sources import recorded
from metricfold.streaming import agent, ingest, requests
from tests.conftest import SF_SMALL

SCHEMA = "arrival long, payload string, ts timestamp, ip_address string"


def _counter(name, n):
    return json.dumps([{"id": name, "type": "counter", "delta": n}])


def _feed(spark, scratch, *turns):
    land = os.path.join(scratch, "bodies")
    for rows in turns:
        spark.createDataFrame(rows, "arrival long, payload string, ts string, ip_address string") \
            .withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(land)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(land)


def _lines(spark, path):
    return sorted((json.loads(r.value) for r in spark.read.text(path).collect()), key=str)


def test_bodies_are_judged_whole_and_audited_apart(spark, scratch):
    day = "2024-01-01 00:00:0"
    feed = _feed(spark, scratch,
                 [(1, _counter("a", 1), day + "1", "h1"), (2, "[]", day + "2", "h2"), (3, "nope", day + "3", "h3"),
                  (4, '[{"id":"b","type":"gauge","value":1},{"id":5}]', day + "4", "h4"), (5, None, day + "5", "h5")],
                 [(6, '[{"id":"g","type":"gauge","value":2},{"id":"a","type":"counter","delta":4},{"id":"x","type":"no"}]',
                   day + "6", "h6")])
    root, audit, seen = os.path.join(scratch, "state"), os.path.join(scratch, "audit"), {}
    requests.start_request_writer(feed, root, "bodies-" + os.path.basename(scratch), on_batch=seen.__setitem__,
                                  audit_sinks={"f": lambda d: ev.write_audit_batch(d, audit), "bad": lambda d: 1 / 0}
                                  ).awaitTermination()
    assert {tuple(r) for r in tbl.read_state(spark, root).collect()} == {("a", "counter", 5, None), ("g", "gauge", None, 2.0)}
    assert [(s["accepted"], s["rejected"], s["version"]) for _, s in sorted(seen.items())] == [(2, 3, 0), (1, 0, 1)]
    assert all(s["audit"]["f"] is None and "ZeroDivision" in s["audit"]["bad"] for s in seen.values())
    assert sorted((e["ip_address"], tuple(e["metrics"])) for e in _lines(spark, audit)) == [
        ("h1", ("a",)), ("h2", ()), ("h6", ("g", "a", "x"))]


def test_resent_bodies_fold_once_equal_ones_twice(spark, scratch):
    one, t1, t2 = _counter("a", 1), "2024-01-01 00:00:01", "2024-01-01 00:00:09"
    feed = _feed(spark, scratch, [(1, one, t1, "h"), (2, one, t1, "h")],  # sent twice at once
                 [(3, one, t1, "h"),                                     # and again later
                  (4, one, t2, "h"), (5, one, t1, "other")])             # other time, other sender
    root = os.path.join(scratch, "state")
    requests.start_request_writer(feed, root, "resent-" + os.path.basename(scratch), resent_within="1 hour").awaitTermination()
    assert tbl.read_state(spark, root).first().delta == 3


def test_body_files_are_requests(spark, scratch):
    land, root = os.path.join(scratch, "files"), os.path.join(scratch, "state")
    os.makedirs(land)
    for i, body in enumerate((_counter("a", 2), "[]", "{")):
        with open(os.path.join(land, f"{i}.json"), "w") as f:
            f.write(body)
    seen = {}
    requests.start_request_writer(requests.body_stream(spark, land), root, "files-" + os.path.basename(scratch),
                                  on_batch=seen.__setitem__).awaitTermination()
    assert tbl.read_state(spark, root).first().delta == 2
    assert [(s["accepted"], s["rejected"]) for s in seen.values()] == [(2, 1)]


def test_single_updates_beside_batches(spark, scratch):
    rows = [(1, '{"id":"a","type":"COUNTER","delta":2}', True), (2, _counter("a", 3), False),
            (3, '{"id":"a","type":"counter"}', True), (4, '[{"id":"a","type":"COUNTER","delta":9}]', False),
            (5, '[{"id":"a","type":"counter","delta":9}]', True)]
    d = spark.createDataFrame(rows, "arrival long, payload string, single boolean")
    from metricfold.plans.flows import ingest_payloads
    root = os.path.join(scratch, "state")
    done = ingest_payloads(spark, requests.as_batches(d, "single"), root, 0, "arrival")
    assert (done["accepted"], done["rejected"]) == (3, 2)  # the batch's kind is compared as written
    assert tbl.read_state(spark, root).first().delta == 5


def test_observer_leaves_each_line_once(spark, scratch):
    spark.dataSource.register(observer.AuditLines)
    feed = _feed(spark, scratch, *[[(i, _counter(f"m{i}", 1), f"2024-01-01 00:00:0{i}", "h")] for i in range(4)])
    out, name = os.path.join(scratch, "lines"), "observer-" + os.path.basename(scratch)
    notes = ingest.checkpoint_for(spark, name).replace("file:", "")

    def run():
        requests.request_events(feed).select("line").writeStream.format("audit_lines").option("path", out) \
            .option("checkpointLocation", ingest.checkpoint_for(spark, name)).trigger(availableNow=True).start().awaitTermination()

    run()
    want = [e["metrics"] for e in _lines(spark, f"{out}/*.jsonl")]
    assert sorted(map(tuple, want)) == [(f"m{i}",) for i in range(4)]
    for f in ("3", ".3.crc"):  # killed before Spark noted the last epoch
        os.remove(os.path.join(notes, "commits", f))
    run()
    assert [e["metrics"] for e in _lines(spark, f"{out}/*.jsonl")] == want
    assert os.listdir(os.path.join(out, "_staged")) == []


def test_observer_abort_deletes_what_was_written(scratch):
    w = observer.LineWriter(scratch, 0, observer.AuditLines.deliver)
    a, b = w.write(iter([("x",), ("é",)])), w.write(iter([]))
    w.abort([a, None], 0)
    w.commit([b], 1)
    assert sorted(os.listdir(scratch)) == ["_staged", "epoch-000000000001-00000.jsonl"]
    c, d = w.write(iter([("y",)])), w.write(iter([("z",)]))
    w.commit([c, d], 1)  # a repeated epoch replaces its lines
    assert sorted(open(os.path.join(scratch, f)).read() for f in os.listdir(scratch) if f.endswith("l")) == ["y\n", "z\n"]


def test_recorded_samples_batch_and_stream(spark, scratch):
    spark.dataSource.register(recorded.RecordedSamples)
    w, land = fx.wide(spark, SF_SMALL), os.path.join(scratch, "rec")
    w.where("ord % 2 = 0").write.mode("append").parquet(land)
    read = spark.read.format("recorded_samples").load(land)
    assert read.columns == ["host", "ord", "provider", "ts", *SAMPLE_FIELDS, CPU_FIELD]
    cols = ["host", "ord", "ts", *SAMPLE_FIELDS, CPU_FIELD]
    key = lambda d: sorted(map(str, d.select(*cols).collect()))
    assert key(read) == key(w.where("ord % 2 = 0"))
    name = "recorded-" + os.path.basename(scratch)
    out = os.path.join(scratch, "out")

    def run():
        stream = spark.readStream.format("recorded_samples").option("provider", 7).load(land)
        stream.writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", ingest.checkpoint_for(spark, name)).trigger(availableNow=True).start().awaitTermination()

    run()
    w.where("ord % 2 = 1").write.mode("append").parquet(land)
    run()
    got = spark.read.parquet(out)
    assert key(got) == key(w) and got.select("provider").distinct().collect()[0][0] == 7


def test_recorded_samples_conform_and_fail(spark, scratch):
    land = os.path.join(scratch, "few")
    spark.createDataFrame([(1, 5, 2.5, "x")], "host long, ord long, Alloc double, extra string").write.parquet(land)
    spark.dataSource.register(recorded.RecordedSamples)
    r = spark.read.format("recorded_samples").option("fields", "Alloc, Sys").load(land).first()
    assert (r.host, r.ord, r.provider, r.ts, r.Alloc, r.Sys) == (1, 5, 0, None, 2.5, 0.0)
    frames, errors = samples.collect_providers(spark, [recorded.recorded(land, 0, ["Alloc"]),
                                                       recorded.recorded(os.path.join(scratch, "gone"), 1)])
    assert len(frames) == 1 and list(errors) == [1]
    with pytest.raises(ValueError, match="no such sample fields"):
        recorded.RecordedSamples({"path": land, "fields": "Nope"}).schema()


def test_live_agent_reports_equal_the_batch(spark, scratch):
    """Samples in three micro-batches, out of order inside the watermark, in windows of hours."""
    w = fx.wide(spark, SF_SMALL).where("host < 8")
    land, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    for part in (w.where("ord % 3 = 1"), w.where("ord % 3 = 0"), w.where("ord % 3 = 2"), ingest.closing_row(spark, w.schema)):
        part.coalesce(1).write.mode("append").parquet(land)
    stream = spark.readStream.schema(w.schema).option("maxFilesPerTrigger", 1).parquet(land)
    agent.report_stream(stream, 6 * 3600, "90 days").writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", ingest.checkpoint_for(spark, "agent-" + os.path.basename(scratch))) \
        .trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    want = samples.report_batches(w, every="6 hours")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_agent_parts_join_in_any_order():
    import pandas as pd
    fields = ["Alloc", "Sys", "TotalAlloc", "Frees"]
    rows = [(0, [0, 0, 0, 5.0], []), (1, [0, 0, 0, 0], [1.0]), (2, [0, 3.0, 0, 0], None), (3, [2.0, 0, 0, 7.0], [2.0, 3.0]),
            (4, [0, 0, 0, 0], [])]
    frame = pd.DataFrame([{"ord": o, **dict(zip(fields, x)), CPU_FIELD: c} for o, x, c in rows])
    one = lambda f: agent._part(f, fields, [0, 1, 2])
    whole = one(frame)
    for order in ([0, 1, 2, 3, 4], [4, 3, 2, 1, 0], [2, 0, 4, 1, 3]):
        part = None
        for i in order:
            part = agent._joined(part, one(frame.iloc[[i]]))
        assert part == whole
    assert whole[0] == 5 and whole[2] == 2 and whole[4] == [2.0, 3.0, 0.0, 7.0] and whole[6] == [2.0, 3.0]


class _Cell:
    """A state variable that counts its calls."""

    def __init__(self, calls, empty):
        self.calls, self.empty, self.value = calls, empty, empty

    def get(self):
        self.calls.append("get")
        return self.value if self.empty is None else iter(self.value)

    def update(self, value):
        self.calls.append("update")
        self.value = value

    put = update

    def appendValue(self, value):
        self.calls.append("append")
        self.value = [*self.value, value]

    def clear(self):
        self.calls.append("clear")
        self.value = self.empty


def test_agent_state_calls_do_not_grow_with_windows():
    """Many windows cost as many calls as one; merged lists lose nothing."""
    import types

    import pandas as pd

    def run(n, turns=1):
        calls, timers = [], []
        agent_ = agent.Reports(["Alloc", "Frees"], 1000, "host")
        agent_.init(types.SimpleNamespace(getListState=lambda *_: _Cell(calls, []), getValueState=lambda *_: _Cell(calls, None),
                                          registerTimer=lambda t: (calls.append("timer"), timers.append(t))))
        times = types.SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
        for turn in range(turns):
            rows = pd.DataFrame({"poll_ms": [i * 1000 for i in range(n)], "ord": [turn * n + i for i in range(n)],
                                 "fields": [[1.0 + turn, float(i)] for i in range(n)], CPU_FIELD: [[0.5]] * n})
            assert list(agent_.handleInputRows((7,), iter([rows]), times)) == []
        end = types.SimpleNamespace(getCurrentWatermarkInMs=lambda: 10 ** 9)
        out = [d for t in sorted(set(timers)) for d in agent_.handleExpiredTimer(
            (7,), end, types.SimpleNamespace(getExpiryTimeInMs=lambda: t))]
        assert len(out) == 1 and len(out[0]) == n and set(out[0]["polls"]) == {turns}
        assert out[0]["fields"].iloc[-1] == [float(turns), float(n - 1)]
        return len(calls)

    assert run(50) == run(1) and run(500) <= run(1) + 2
    run(40, turns=9)
