"""Streaming: stream equals batch, replay safety, strict batches, poll
windows with a watermark (all with ``availableNow`` and fresh checkpoints)."""

import os

from pyspark.sql import functions as F

from metricfold.operators import fold, samples
from metricfold.sinks import state_table as tbl
from metricfold.sources import fixtures as fx
from metricfold.streaming import ingest
from tests.conftest import SF_SMALL


def _land_batches(spark, df, root, col="batch_id"):
    """Write each batch as its own file set (arrival = file order)."""
    os.makedirs(root, exist_ok=True)
    for b in sorted(r[0] for r in df.select(col).distinct().collect()):
        df.where(F.col(col) == b).coalesce(1).write.parquet(f"{root}/part-{b:06d}")


def _stream_of(spark, root, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", True).parquet(root)


def test_stream_fold_equals_batch(spark, scratch):
    u = fx.updates(spark, SF_SMALL)
    land = os.path.join(scratch, "land")
    _land_batches(spark, u, land)
    seen = {}

    def keep(df, batch_id):
        for r in df.collect():  # tiny test sink: the changed keys of the batch
            seen[(r.id, r.mtype)] = (r.delta, r.value)

    q = ingest.start_fold(_stream_of(spark, land, u.schema), keep, "fold-test-" + os.path.basename(scratch))
    q.awaitTermination()
    expect = {(r.id, r.mtype): (r.delta, r.value) for r in fold.fold_state(u).collect()}
    assert seen == expect


def test_state_writer_replay_and_audit(spark, scratch):
    u = fx.updates(spark, SF_SMALL)
    land, root, audit = (os.path.join(scratch, n) for n in ("land", "state", "audit"))
    _land_batches(spark, u, land)
    name = "writer-" + os.path.basename(scratch)
    lines = []
    q = ingest.start_state_writer(_stream_of(spark, land, u.schema), root, name,
                                  audit_sinks={"n": lambda df: lines.append(df.count())})
    q.awaitTermination()
    n_batches = u.select("batch_id").distinct().count()
    last = tbl.latest(spark, root)
    assert last == n_batches - 1 and len(lines) == n_batches
    got = sorted(map(tuple, tbl.read_state(spark, root).collect()))
    assert got == sorted(map(tuple, fold.fold_state(u).collect()))
    # Replay: re-running a stored batch id changes nothing.
    assert tbl.apply_batch(spark, root, u.where("batch_id = 0"), last) is None
    assert sorted(map(tuple, tbl.read_state(spark, root).collect())) == got


def test_poll_count_stream_matches_batch(spark, scratch):
    w = fx.wide(spark, SF_SMALL).withColumn("day", F.to_date("ts"))
    land = os.path.join(scratch, "samples")
    _land_batches(spark, w.withColumn("d", F.dayofmonth("ts")), land, col="d")
    schema = w.withColumn("d", F.lit(0)).schema
    counts = ingest.poll_count_stream(_stream_of(spark, land, schema), every="1 day",
                                      watermark="1 hour")
    name = "polls_" + os.path.basename(scratch).replace("-", "_")
    q = counts.writeStream.outputMode("append").format("memory").queryName(name) \
        .option("checkpointLocation", ingest.checkpoint_for(spark, name)) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.sql(f"SELECT host, poll_count FROM {name}").collect()
    batch = samples.poll_count(w, "1 day").collect()
    # Append mode emits a window once the watermark passes it: every window
    # except those of the last day, which stay open at the end of input.
    last_day = w.agg(F.max("day")).collect()[0][0]
    closed = [r for r in batch if r.window_start.date() < last_day]
    assert sorted((r.host, r.poll_count) for r in got) == sorted((r.host, r.poll_count) for r in closed)


def test_periodic_snapshot_per_commit(spark, scratch):
    from metricfold.sinks.snapshot import latest_snapshot
    from metricfold.sources.updates import restore_snapshot
    u = fx.updates(spark, SF_SMALL)
    land, root, snaps = (os.path.join(scratch, n) for n in ("land", "state", "snaps"))
    _land_batches(spark, u, land)
    q = ingest.start_state_writer(_stream_of(spark, land, u.schema), root,
                                  "snap-" + os.path.basename(scratch), snapshot_root=snaps,
                                  snapshot_seconds=0)
    q.awaitTermination()
    last = latest_snapshot(spark, snaps)
    assert last is not None and last.endswith(f"{tbl.latest(spark, root):012d}")
    got = sorted(map(tuple, restore_snapshot(spark, last).collect()))
    assert got == sorted(map(tuple, fold.fold_state(u).collect()))


def test_strict_stream_quarantines_conflicting_batches(spark, scratch):
    u = fx.conflict_updates(spark, SF_SMALL)
    land, root, quarantine = (os.path.join(scratch, n) for n in ("land", "state", "q"))
    _land_batches(spark, u, land)
    q = ingest.start_state_writer(_stream_of(spark, land, u.schema), root,
                                  "strict-" + os.path.basename(scratch), strict=True,
                                  quarantine=quarantine)
    q.awaitTermination()
    state = tbl.read_state(spark, root)
    # Table semantics: one row per id, invariant holds, quarantined batches
    # left no trace.
    assert state.count() == state.select("id").distinct().count()
    from metricfold.operators.admission import state_violations
    assert state_violations(state).count() == 0
    assert os.path.isdir(quarantine)


def test_close_writes_final_snapshot(spark, scratch):
    from metricfold.sources.updates import restore_snapshot
    u = fx.updates(spark, SF_SMALL)
    land, root, snaps = (os.path.join(scratch, n) for n in ("land", "state", "snaps"))
    _land_batches(spark, u, land)
    q = ingest.start_state_writer(_stream_of(spark, land, u.schema), root, "close-" + os.path.basename(scratch))
    q.awaitTermination()
    path = ingest.close_state_writer(spark, q, root, snaps)
    assert path is not None
    got = sorted(map(tuple, restore_snapshot(spark, path).collect()))
    assert got == sorted(map(tuple, fold.fold_state(u).collect()))


def test_restart_after_crash_replays_without_double_counting(spark, scratch):
    u = fx.updates(spark, SF_SMALL)
    land, root = os.path.join(scratch, "land"), os.path.join(scratch, "state")
    _land_batches(spark, u.where("batch_id = 0"), land)
    name = "restart-" + os.path.basename(scratch)
    q = ingest.start_state_writer(_stream_of(spark, land, u.schema), root, name)
    q.awaitTermination()
    q.stop()
    # Crash window: our state commit landed, Spark's batch commit did not.
    ck = ingest.checkpoint_for(spark, name).replace("file:", "")
    last = max(int(f) for f in os.listdir(os.path.join(ck, "commits")) if f.isdigit())
    for f in (str(last), f".{last}.crc"):  # the commit file and its local checksum
        if os.path.exists(os.path.join(ck, "commits", f)):
            os.remove(os.path.join(ck, "commits", f))
    # More data arrives; the restarted query first replays the uncommitted batch.
    _land_batches(spark, u.where("batch_id > 0"), land)
    q = ingest.start_state_writer(_stream_of(spark, land, u.schema), root, name)
    q.awaitTermination()
    q.stop()
    got = sorted(map(tuple, tbl.read_state(spark, root).collect()))
    assert got == sorted(map(tuple, fold.fold_state(u).collect()))
    assert tbl.latest(spark, root) == u.select("batch_id").distinct().count() - 1


def _drop_last_stream_commit(spark, name):
    """Simulate a crash after our state commit but before Spark's batch commit."""
    ck = ingest.checkpoint_for(spark, name).replace("file:", "")
    last = max(int(f) for f in os.listdir(os.path.join(ck, "commits")) if f.isdigit())
    for f in (str(last), f".{last}.crc"):  # the commit file and its local checksum
        if os.path.exists(os.path.join(ck, "commits", f)):
            os.remove(os.path.join(ck, "commits", f))


def test_replayed_batch_reemits_audit_once_with_idempotent_sink(spark, scratch):
    from metricfold.operators.audit import audit_events
    from metricfold.sinks import events as ev
    u = fx.updates(spark, SF_SMALL)
    land, root, audit = (os.path.join(scratch, n) for n in ("land", "state", "audit"))
    _land_batches(spark, u.where("batch_id = 0"), land)
    name = "audit-" + os.path.basename(scratch)
    sinks = {"file": lambda df: ev.write_audit_batch(df, audit)}
    expected = audit_events(u.where("batch_id = 0")).count()

    def run(with_sinks):
        q = ingest.start_state_writer(_stream_of(spark, land, u.schema), root, name,
                                      audit_sinks=sinks if with_sinks else None, replay_audit=True)
        q.awaitTermination()
        q.stop()

    run(with_sinks=False)           # state committed, audit never written (crash)
    _drop_last_stream_commit(spark, name)
    run(with_sinks=True)            # replay: state skipped, audit re-emitted
    assert spark.read.text(audit).count() == expected
    _drop_last_stream_commit(spark, name)
    run(with_sinks=True)            # second replay: still exactly one copy
    assert spark.read.text(audit).count() == expected
    got = sorted(map(tuple, tbl.read_state(spark, root).collect()))
    assert got == sorted(map(tuple, fold.fold_state(u.where("batch_id = 0")).collect()))


def test_snapshot_interval_is_not_the_trigger(spark, scratch):
    from metricfold.sinks.snapshot import latest_snapshot
    u = fx.updates(spark, SF_SMALL)
    land, root, snaps = (os.path.join(scratch, n) for n in ("land", "state", "snaps"))
    _land_batches(spark, u, land)
    q = ingest.start_state_writer(_stream_of(spark, land, u.schema), root, "late-" + os.path.basename(scratch),
                                  snapshot_root=snaps)
    q.awaitTermination()
    assert latest_snapshot(spark, snaps) is None  # 300 s have not passed
    assert ingest.close_state_writer(spark, q, root, snaps) == latest_snapshot(spark, snaps)


def test_flush_counts_open_windows(spark):
    w = fx.wide(spark, SF_SMALL)
    every = samples.poll_count(w, "1 day")
    ts = lambda d: d.withColumns({c: F.col(c).cast("timestamp") for c in ("window_start", "window_end")})
    half = ts(every).where("window_end <= timestamp '2024-01-15'")
    rest = ingest.flush_poll_windows(w, half, "1 day")
    assert sorted(map(tuple, half.unionByName(rest).collect())) == sorted(map(tuple, ts(every).collect()))
    assert ingest.flush_poll_windows(w, half.limit(0), "1 day").count() == every.count()


def test_snapshots_need_no_data(spark, scratch):
    """An idle stream saves when the interval has passed, and once at close."""
    import time

    from metricfold.sinks.snapshot import latest_snapshot
    from metricfold.sources.updates import restore_snapshot
    u = fx.updates(spark, SF_SMALL)
    land, root, snaps = (os.path.join(scratch, n) for n in ("land", "state", "snaps"))
    _land_batches(spark, u, land)
    q = ingest.start_state_writer(spark.readStream.schema(u.schema).option("recursiveFileLookup", True).parquet(land), root,
                                  "idle-" + os.path.basename(scratch), every="1 second", snapshot_root=snaps,
                                  snapshot_seconds=2)
    q.processAllAvailable()
    batches, before = tbl.latest(spark, root), latest_snapshot(spark, snaps)
    for _ in range(60):
        if latest_snapshot(spark, snaps) not in (None, before):
            break
        time.sleep(0.5)
    saved = latest_snapshot(spark, snaps)
    assert saved not in (None, before) and tbl.latest(spark, root) == batches  # no batch in between
    want = sorted(map(tuple, fold.fold_state(u).collect()))
    assert sorted(map(tuple, restore_snapshot(spark, saved).collect())) == want
    closed = ingest.close_state_writer(spark, q, root, snaps)
    assert closed > saved and closed == latest_snapshot(spark, snaps)
    assert not spark.streams.active or q.id not in [x.id for x in spark.streams.active]
    assert sorted(map(tuple, restore_snapshot(spark, closed).collect())) == want


def test_polls_of_several_providers_count_once_across_batches(spark, scratch):
    """Rows of one poll that come in other micro-batches are not counted again."""
    w = fx.wide(spark, SF_SMALL).select("host", "ord", "ts")
    land = os.path.join(scratch, "polls")
    rows = w.withColumn("provider", F.lit(0)).unionByName(w.withColumn("provider", F.lit(1)))
    for part in (rows.where("provider = 0"), rows.where("provider = 1 AND ord % 2 = 0"), rows.where("provider = 1 AND ord % 2 = 1"),
                 ingest.closing_row(spark, rows.schema)):
        part.coalesce(1).write.mode("append").parquet(land)
    counts = ingest.poll_count_stream(_stream_of(spark, land, rows.schema), every="1 day", watermark="60 days", poll_col="ord")
    name = "distinct_" + os.path.basename(scratch).replace("-", "_")
    counts.writeStream.outputMode("append").format("memory").queryName(name) \
        .option("checkpointLocation", ingest.checkpoint_for(spark, name)).trigger(availableNow=True).start().awaitTermination()
    want = sorted((r.host, r.poll_count) for r in samples.poll_count(w, "1 day").collect())
    assert sorted((r.host, r.poll_count) for r in spark.sql(f"SELECT host, poll_count FROM {name}").collect()) == want
