"""Sources and sinks: JSON batch files (plain and gzip), payload verdicts,
snapshots, versioned state, audit lines, fan-out, forward payloads."""

import gzip
import json
import os

import pytest

from pyspark.sql import functions as F

from metricfold.operators.fold import fold_state
from metricfold.operators import audit, fold, samples
from metricfold.operators.admission import filter_signed
from metricfold.sinks import events as ev
from metricfold.sinks import state_table as tbl
from metricfold.sinks.snapshot import latest_snapshot, save_snapshot
from metricfold.sources import fixtures as fx
from metricfold.sources import updates as src
from tests.conftest import SF_SMALL

PAYLOAD_CASES = {
    "ok": ('[{"id": "a", "type": "counter", "delta": 5}, {"id": "b", "type": "gauge", "value": 1}]',
           True),
    "frac_delta": ('[{"id": "a", "type": "counter", "delta": 1.5}]', False),
    "str_delta": ('[{"id": "a", "type": "counter", "delta": "5"}]', False),
    "exp_delta": ('[{"id": "a", "type": "counter", "delta": 1e3}]', False),
    "big_delta": ('[{"id": "a", "type": "counter", "delta": 9223372036854775808}]', False),
    "str_value": ('[{"id": "a", "type": "gauge", "value": "x"}]', False),
    "num_id": ('[{"id": 5, "type": "gauge", "value": 1}]', False),
    "not_json": ("not json", False),
    "object": ('{"id": "a", "type": "gauge", "value": 1}', False),
    "empty": ("[]", True),
    "null": ("null", True),
    "null_delta": ('[{"id": "a", "type": "counter", "delta": null}]', True),
}


def test_payload_verdicts(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in PAYLOAD_CASES.items()], "name string, payload string")
    got = {r.name: r.accepted for r in src.payload_verdicts(df).collect()}
    assert got == {k: v[1] for k, v in PAYLOAD_CASES.items()}
    rows = src.payload_updates(df, keep=["name"]).collect()
    assert sorted((r.name, r.pos, r.id, r.delta, r.value) for r in rows) == [
        ("null_delta", 0, "a", None, None), ("ok", 0, "a", 5, None), ("ok", 1, "b", None, 1.0)]


def test_read_update_batch_files_plain_and_gzip(spark, scratch):
    d = os.path.join(scratch, "in")
    os.makedirs(d)
    with open(os.path.join(d, "b1.json"), "w") as f:
        f.write(PAYLOAD_CASES["ok"][0])
    with gzip.open(os.path.join(d, "b2.json.gz"), "wt") as f:
        f.write('[{"id": "a", "type": "counter", "delta": 7}]')
    with open(os.path.join(d, "b3.json"), "w") as f:
        f.write(PAYLOAD_CASES["frac_delta"][0])
    ups, verdicts = src.read_update_batch(spark, d)
    v = {os.path.basename(r.batch): r.accepted for r in verdicts.collect()}
    assert v == {"b1.json": True, "b2.json.gz": True, "b3.json": False}
    state = fold.fold_state(ups.withColumnRenamed("pos", "seq"))
    assert {(r.id, r.mtype): (r.delta, r.value) for r in state.collect()} == {
        ("a", "counter"): (12, None), ("b", "gauge"): (None, 1.0)}


def test_gzip_identity(spark, scratch):
    # Codec round trip: empty, 1 byte, text, 1000 x 'a'.
    texts = ["", "a", "Hello, World!", "a" * 1000]
    d = os.path.join(scratch, "gz")
    os.makedirs(d)
    for i, t in enumerate(texts):
        with gzip.open(os.path.join(d, f"t{i}.txt.gz"), "wt") as f:
            f.write(t)
    got = spark.read.option("wholetext", True).text(d) \
        .select(F.col("_metadata.file_name").alias("n"), "value").collect()
    back = {r.n: r.value for r in got}
    assert [back.get(f"t{i}.txt.gz", "") for i in range(4)] == texts


def test_snapshot_roundtrip_and_restore_rules(spark, scratch):
    s = fold.fold_state(fx.updates(spark, SF_SMALL))
    root = os.path.join(scratch, "snap")
    p = save_snapshot(s, root, 1)
    assert latest_snapshot(spark, root) == p
    back = src.restore_snapshot(spark, p)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, s.collect()))
    # Reference-style array file: later duplicate wins (assign, not add),
    # unknown kinds and NULL values dropped, counters keep only delta.
    arr = os.path.join(scratch, "arr.json")
    with open(arr, "w") as f:
        json.dump([{"id": "c", "type": "counter", "delta": 5}, {"id": "c", "type": "counter", "delta": 2},
                   {"id": "g", "type": "gauge", "value": 1.5}, {"id": "x", "type": "histogram", "value": 1},
                   {"id": "n", "type": "gauge"}], f)
    got = {(r.id, r.mtype): (r.delta, r.value) for r in src.restore_snapshot(spark, arr).collect()}
    assert got == {("c", "counter"): (2, None), ("g", "gauge"): (None, 1.5)}
    assert src.restore_snapshot(spark, os.path.join(scratch, "missing")).count() == 0
    nul = os.path.join(scratch, "null.json")
    with open(nul, "w") as f:
        f.write("null")
    assert src.restore_snapshot(spark, nul).count() == 0


def test_state_table_versions_and_replay(spark, scratch):
    u = fx.updates(spark, SF_SMALL)
    root = os.path.join(scratch, "state")
    batches = sorted(r.batch_id for r in u.select("batch_id").distinct().collect())
    for b in batches:
        assert tbl.apply_batch(spark, root, u.where(F.col("batch_id") == b), b) is not None
    # A replayed batch is skipped: counters are not applied twice.
    assert tbl.apply_batch(spark, root, u.where(F.col("batch_id") == batches[-1]), batches[-1]) is None
    got = sorted(map(tuple, tbl.read_state(spark, root).collect()))
    assert got == sorted(map(tuple, fold.fold_state(u).select("id", "mtype", "delta", "value").collect()))
    # Point lookup on the stored table reaches the scan as pushed filters.
    plan = tbl.read_state(spark, root).where("id = 'click.u7' AND mtype = 'counter'") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mtype" in plan and "PushedFilters: [IsNotNull(id), EqualTo(id,click.u7)]" in plan


def test_strict_batch_rolls_back_on_conflict(spark, scratch):
    root, quarantine = os.path.join(scratch, "strict"), os.path.join(scratch, "q")
    mk = lambda rows: spark.createDataFrame(rows, "seq long, id string, type string, delta long, value double")
    assert tbl.apply_strict_batch(spark, root, mk([(1, "m", "counter", 3, None)]), 0) is not None
    # Gauge onto the counter: whole batch rejected, including the valid row.
    assert tbl.apply_strict_batch(spark, root, mk([(2, "x", "gauge", None, 1.0),
                                                   (3, "m", "gauge", None, 2.0)]), 1, quarantine=quarantine) is None
    assert spark.read.parquet(f"{quarantine}/batch_id=1").count() == 2
    # Counter onto a gauge: accepted, no effect.
    assert tbl.apply_strict_batch(spark, root, mk([(4, "g", "gauge", None, 9.0),
                                                   (5, "g", "Counter", 4, None),
                                                   (6, "m", "counter", 2, None)]), 2) is not None
    got = {r.id: (r.mtype, r.delta, r.value) for r in tbl.read_state(spark, root).collect()}
    assert got == {"m": ("counter", 5, None), "g": ("gauge", None, 9.0)}


def test_audit_lines_and_fanout(spark, scratch):
    u = fx.updates(spark, SF_SMALL)
    events = audit.audit_events(u)
    path = os.path.join(scratch, "audit")
    calls = []

    def broken(df):
        raise RuntimeError("observer down")

    errs = ev.fanout(events, {"file": lambda df: ev.write_audit(df, path), "broken": broken,
                              "count": lambda df: calls.append(df.count())})
    assert errs["file"] is None and errs["count"] is None and "observer down" in errs["broken"]
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert list(lines[0].keys()) == ["ts", "metrics", "ip_address"]
    assert sum(len(x["metrics"]) for x in lines) == u.count()
    assert calls == [len(lines)]
    # Ids inside one event keep arrival order, duplicates included.
    b0 = [r.id for r in u.where("batch_id = 0").orderBy("seq").collect()]
    first = [x for x in lines if x["ip_address"] == "10.0.0.7" and x["metrics"][0] == b0[0]][0]
    assert first["metrics"] == b0


def test_audit_one_event_per_batch(spark):
    # Order keys across a round number, and a batch of every row.
    u = fx.updates(spark, SF_SMALL)
    evs = audit.audit_events(u.withColumn("batch_id", F.lit(0))).collect()
    assert [r.n_metrics for r in evs] == [u.count()]
    assert evs[0].metrics == [r.id for r in u.orderBy("seq").collect()]
    few = spark.createDataFrame([(i, f"m{i}", 7, "ip") for i in range(9990, 10010)],
                                "seq long, id string, batch_id long, ip_address string") \
        .withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    ev = audit.audit_events(few).collect()
    assert len(ev) == 1 and ev[0].metrics == [f"m{i}" for i in range(9990, 10010)]
    assert audit.audit_rows(few).count() == 20


def _row(spark, i, d):
    return spark.createDataFrame([(i, "counter", d, None, 0)], "id string, type string, delta long, value double, seq long")


def test_batch_ids_alone_make_replay_safe(spark, scratch):
    root = os.path.join(scratch, "one")
    assert tbl.apply_batch(spark, root, _row(spark, "a", 1), 3) == 3
    assert tbl.apply_batch(spark, root, _row(spark, "a", 2), 4) == 4
    for old in (2, 3, 4):  # Spark's ids only grow: at or below the newest is a replay
        assert tbl.apply_batch(spark, root, _row(spark, "a", 9), old) is None and tbl.already_applied(spark, root, old)
    assert tbl.latest(spark, root) == 4 and not tbl.already_applied(spark, root, 5)
    assert [tuple(r) for r in tbl.read_state(spark, root).collect()] == [("a", "counter", 3, None)]


def test_unfinished_version_is_not_read_and_written_again(spark, scratch):
    root = os.path.join(scratch, "torn")
    tbl.apply_batch(spark, root, _row(spark, "a", 1), 0)
    tbl.apply_batch(spark, root, _row(spark, "a", 2), 1)
    mark = os.path.join(root, f"of={tbl.BUCKETS}", "batch=000000000001", "_SUCCESS")
    os.remove(mark)  # as if the job died before its commit
    assert tbl.read_state(spark, root).first().delta == 1 and tbl.latest(spark, root) == 0
    assert tbl.apply_batch(spark, root, _row(spark, "a", 2), 1) == 1
    assert tbl.read_state(spark, root).first().delta == 3


def test_empty_first_version_reads_back(spark, scratch):
    root = os.path.join(scratch, "empty")
    none = spark.createDataFrame([("x", "histogram", None, None, 0)],
                                 "id string, type string, delta long, value double, seq long")
    assert tbl.apply_batch(spark, root, none, 0) == 0
    assert tbl.read_state(spark, root).collect() == [] and tbl.already_applied(spark, root, 0)


def test_old_versions_go(spark, scratch):
    root = os.path.join(scratch, "short")
    for b in range(5):
        tbl.apply_batch(spark, root, _row(spark, "x", 1), b, buckets=2)
    assert tbl.read_state(spark, root).first().delta == 5
    assert [len(c) for c in tbl._copies(spark, root).values()] == [tbl.KEEP]
    assert tbl.versions(spark, root) == [3, 4]  # the listing does not grow with the batches


def test_buckets_bound_reads_and_writes(spark, scratch):
    """A point read opens its bucket's files; a batch rewrites touched buckets only."""
    root = os.path.join(scratch, "wide")
    u = fx.updates(spark, SF_SMALL)
    tbl.apply_batch(spark, root, u, 0, buckets=32)
    everything = tbl.read_state(spark, root)
    point = tbl.lookup_point(spark, root, [("click.u7", "counter")])
    assert 0 < len(point.inputFiles()) < len(everything.inputFiles()) / 8
    assert [r.id for r in point.collect()] == ["click.u7"]
    plan = point._jdf.queryExecution().executedPlan().toString()
    assert "mtype" in plan.split("PartitionFilters")[1].split("]")[0] and "EqualTo(id,click.u7)" in plan
    before = {b: c[-1] for b, c in tbl._copies(spark, root).items()}
    tbl.apply_batch(spark, root, _row(spark, "click.u7", 5), 1)  # the table keeps its 32 buckets
    changed = {b for b, c in tbl._copies(spark, root).items() if c[-1] != before.get(b)}
    assert len(changed) == 1 and len(before) > 8
    want = {(r.id, r.mtype): r.delta for r in fold.fold_state(u).collect()}
    want["click.u7", "counter"] += 5
    assert {(r.id, r.mtype): r.delta for r in tbl.read_state(spark, root).collect()} == want


def test_state_files_carry_bloom_filters(spark, scratch):
    import pyarrow.parquet as pq
    root = os.path.join(scratch, "bloom")
    tbl.apply_batch(spark, root, fx.updates(spark, SF_SMALL), 0, buckets=1)
    files = [f.replace("file:", "").replace("///", "/") for f in tbl.read_state(spark, root).inputFiles()]
    assert files and all(b"id" in open(f, "rb").read() and pq.ParquetFile(f).metadata.num_rows for f in files)
    # A block of filter bits lies between the pages and the footer of each file.
    for f in files:
        meta = pq.ParquetFile(f).metadata.row_group(0)
        end = max(meta.column(c).file_offset + meta.column(c).total_compressed_size for c in range(meta.num_columns))
        assert os.path.getsize(f) - end > 1024


def test_counter_sum_ignores_order(spark):
    top = (1 << 63) - 1
    for deltas in ((top, 1, -10), (top, -10, 1)):
        u = spark.createDataFrame([("a", "counter", d, None, i) for i, d in enumerate(deltas)],
                                  "id string, type string, delta long, value double, seq long").coalesce(1)
        assert fold_state(u).first().delta == top - 9


def test_strict_batch_compares_kinds_as_written(spark, scratch):
    u = spark.createDataFrame([("a", "Counter", 5, None, 0), ("b", "counter", 1, None, 1)],
                              "id string, type string, delta long, value double, seq long")
    root = os.path.join(scratch, "strict")
    tbl.apply_strict_batch(spark, root, u, 0)
    assert [(r.id, r.delta) for r in tbl.read_state(spark, root).collect()] == [("b", 1)]


def test_payload_keys_and_numbers(spark):
    rows = [(0, '[{"ID":"a","Type":"counter","Delta":1}]'), (1, '[{"id":"a","ID":"b"}]'), (2, '[{"id":"a","value":1e400}]'),
            (3, '[{"id":"a","id":"z","type":"gauge","value":2}]'), (4, "[]"), (5, '[{"note":{"id":5,"x":[1]},"id":"n"}]'),
            (6, '[{"ID":5}]'), (7, '[null]'), (8, '[{"a b":1,"id":"q"}]')]
    d = spark.createDataFrame(rows, "n int, payload string")
    ok = {r.n: r.accepted for r in src.payload_verdicts(d).collect()}
    assert ok == {0: True, 1: False, 2: False, 3: True, 4: True, 5: True, 6: False, 7: True, 8: True}
    got = {r.n: (r.id, r.type, r.delta, r.value) for r in src.payload_updates(d, keep=["n"]).collect()}
    assert got == {0: ("a", "counter", 1, None), 3: ("z", "gauge", None, 2.0), 5: ("n", "", None, None),
                   7: ("", "", None, None), 8: ("q", "", None, None)}


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf")])
def test_non_finite_gauges_do_not_encode(spark, bad):
    from metricfold.functions.scalars import encode_update
    d = spark.createDataFrame([("a", "gauge", None, bad)], "id string, type string, delta long, value double")
    with pytest.raises(Exception, match="not finite"):
        d.select(encode_update()).collect()


def test_forward_payloads_roundtrip(spark, scratch):
    w = fx.wide(spark, SF_SMALL)
    rep = samples.report_batches(w, list(fx.WIDE_FIELDS), every="1 day")
    pay = ev.forward_payloads(rep, key="test_key")
    out = os.path.join(scratch, "fwd")
    ev.write_payloads(pay, out)
    assert any(n.endswith(".json.gz") for n in os.listdir(out))
    back = spark.read.json(out)
    ok = filter_signed(back, "test_key", "payload", "sig", None)
    assert ok.count() == pay.count()
    ups = src.payload_updates(ok, keep=["host", "window_start"])
    assert ups.count() == rep.count()
    assert ups.where("id = 'PollCount'").agg(F.sum("delta")).collect()[0][0] == w.count()


def test_snapshot_save_fails_on_non_finite_gauge(spark, scratch):
    import pytest
    bad = spark.createDataFrame([("g", "gauge", None, float("nan")), ("c", "counter", 1, None)],
                                "id string, mtype string, delta long, value double")
    with pytest.raises(Exception, match="non-finite gauge"):
        save_snapshot(bad, os.path.join(scratch, "snap"), 1)
    assert latest_snapshot(spark, os.path.join(scratch, "snap")) is None


def test_set_replaces_values(spark, scratch):
    root = os.path.join(scratch, "sets")
    mk = lambda rows: spark.createDataFrame(rows, "id string, mtype string, delta long, value double")
    tbl.apply_set(spark, root, mk([("c", "counter", 5, None), ("g", "gauge", None, 1.0)]), 0)
    tbl.apply_set(spark, root, mk([("c", "counter", 9, None)]), 1)          # absolute, not added
    assert tbl.apply_set(spark, root, mk([("c", "counter", 99, None)]), 1) is None  # replay
    got = {r.id: (r.delta, r.value) for r in tbl.read_state(spark, root).collect()}
    assert got == {"c": (9, None), "g": (None, 1.0)}
    tbl.apply_set(spark, root, mk([("g", "gauge", None, 2.5)]), 2)
    got = {r.id: (r.delta, r.value) for r in tbl.read_state(spark, root).collect()}
    assert got == {"c": (9, None), "g": (None, 2.5)}


def test_missing_or_null_string_fields_decode_to_empty(spark):
    df = spark.createDataFrame([('[{"type": "gauge", "value": 1}, {"id": null, "type": "counter", "delta": 2}, null]',)],
                               "payload string")
    rows = sorted((r.pos, r.id, r.type) for r in src.payload_updates(df).collect())
    assert rows == [(0, "", "gauge"), (1, "", "counter"), (2, "", "")]


def test_audit_batches_replace_their_lines_in_few_files(spark, scratch):
    """Files follow the lines, not the batches; a batch that comes again replaces its line alone."""
    from metricfold.sinks import events as ev
    out = os.path.join(scratch, "audit")
    lines = lambda ids, v: spark.createDataFrame([(i, f"{v}{i}") for i in ids], "batch_id long, line string")
    ev.write_audit_batch(lines([None, *range(600)], "a"), out)
    ev.write_audit_batch(lines([None, 5, 7, 9000], "b"), out)
    want = sorted([(i, f"{'b' if i in (5, 7) else 'a'}{i}") for i in range(600)] + [(9000, "b9000")])
    got = [tuple(r) for r in ev.read_audit_batches(spark, out).collect()]
    assert sorted(r for r in got if r[0] is not None) == want and [r for r in got if r[0] is None] == [(None, "bNone")]
    assert sorted(r.value for r in spark.read.text(out).collect()) == sorted(v for _, v in got)
    assert len([f for _, _, files in os.walk(out) for f in files if f.startswith("part-")]) < 50


def test_packed_reports_give_the_same_payloads(spark):
    """Reports stay one row each up to their payload; samples that repeat a place still meet in one report."""
    from metricfold.sinks import events as ev
    w = spark.range(40).selectExpr("id % 3 AS host", "id AS ord", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, id % 5) AS ts",
                                   "CAST(id % 4 AS double) AS Alloc", "CAST(id % 2 AS double) AS Frees",
                                   "array_repeat(CAST(id AS double), CAST(id % 3 AS int)) AS CPUutilization")
    w = w.unionByName(w.where("ord = 38"))
    rows = samples.report_batches(w, every="1 day")
    packed = samples.report_batches(w, every="1 day", packed=True)
    assert "Generate" not in packed._jdf.queryExecution().executedPlan().toString()
    want = sorted(map(tuple, ev.forward_payloads(rows, "k").collect()), key=str)
    assert sorted(map(tuple, ev.forward_payloads(packed, "k").collect()), key=str) == want and len(want) == 15
