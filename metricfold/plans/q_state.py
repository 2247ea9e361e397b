"""Queries: state upsert, lookups, listings, value texts (JOIN-1..3, FLT-5,
PRJ-4, SET-1, SCL-4/5/11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from metricfold.functions.scalars import encode_update, fixed_text
from metricfold.operators import fold
from metricfold.operators import state as st
from metricfold.plans.catalog import FOLD_STATE_SQL, UPDATES, register, with_views
from metricfold.sources import fixtures as fx

# Updates before this instant form the stored state; the rest arrive as the
# next batch. All rows are used on one side or the other.
UPSERT_CUTOFF = "2024-01-16 00:00:00"


def _split(spark, sf_dir):
    u = fx.updates(spark, sf_dir)
    cut = F.lit(UPSERT_CUTOFF).cast("timestamp_ntz")
    return u.where(F.col("ts") < cut), u.where(F.col("ts") >= cut)


@register("upsert_state", with_views(f"""
SELECT coalesce(s.id, b.id) AS id, coalesce(s.mtype, b.mtype) AS mtype,
       CASE WHEN coalesce(s.mtype, b.mtype) = 'counter'
            THEN CAST(coalesce(s.delta, 0) + coalesce(b.delta, 0) AS BIGINT) END AS delta,
       CASE WHEN coalesce(s.mtype, b.mtype) = 'gauge' THEN coalesce(b.value, s.value) END AS value
FROM s FULL OUTER JOIN b ON s.id = b.id AND s.mtype = b.mtype""",
    s=with_views(FOLD_STATE_SQL, updates=f"{UPDATES} WHERE ts < TIMESTAMP '{UPSERT_CUTOFF}'"),
    b=with_views(FOLD_STATE_SQL, updates=f"{UPDATES} WHERE ts >= TIMESTAMP '{UPSERT_CUTOFF}'")))
def q_upsert_state(spark, sf_dir):
    """JOIN-1: fold the earlier updates into state, then upsert the later
    ones as one batch (full outer join: counters add, gauges replace)."""
    before, after = _split(spark, sf_dir)
    return st.upsert_state(fold.fold_state(before), after)


# Lookup requests: every update row asks for the metric it names, kind as
# written (mixed case included); the JSON endpoint lower-cases it.
_REQ_SQL = f"SELECT seq, id, type FROM ({UPDATES}) u"


@register("lookup_many", with_views("""
SELECT r.seq, r.id, r.type,
       CASE WHEN lower(r.type) = 'counter' THEN s.delta END AS delta_found,
       CASE WHEN lower(r.type) = 'gauge' THEN s.value END AS value_found
FROM req r JOIN state s ON s.id = r.id AND s.mtype = lower(r.type)
WHERE lower(r.type) IN ('gauge', 'counter')""", updates=UPDATES, req=_REQ_SQL,
                                    state=FOLD_STATE_SQL))
def q_lookup_many(spark, sf_dir):
    """JOIN-2 + PRJ-4: bulk lookup; id and kind echoed as requested."""
    u = fx.updates(spark, sf_dir)
    return st.lookup(u.select("seq", "id", "type"), fold.fold_state(u))


# Only some users' metrics are stored; the others' requests find nothing.
_SOME = "CAST(split_part(id, '.u', 2) AS BIGINT) % 3 <> 0"


@register("lookup_missing", with_views("""
SELECT r.seq, r.id, r.type FROM req r
WHERE lower(r.type) IN ('gauge', 'counter')
  AND NOT EXISTS (SELECT 1 FROM state s WHERE s.id = r.id AND s.mtype = lower(r.type))""",
                                       updates=UPDATES, req=_REQ_SQL,
                                       state=FOLD_STATE_SQL.replace("FROM updates", f"FROM (SELECT * FROM updates WHERE {_SOME}) u")))
def q_lookup_missing(spark, sf_dir):
    """JOIN-3: valid lookups with no stored metric (not found); a third of
    the users have none."""
    u = fx.updates(spark, sf_dir)
    return st.lookup_missing(u.select("seq", "id", "type"), fold.fold_state(u.where(_SOME)))


@register("lookup_point", with_views("""
SELECT * FROM state WHERE (id = 'purchase.u7' AND mtype = 'gauge')
   OR (id = 'click.u7' AND mtype = 'counter')""", updates=UPDATES, state=FOLD_STATE_SQL))
def q_lookup_point(spark, sf_dir):
    """FLT-5: two point reads (one gauge, one counter) on a stored state table:
    only the files of the ids' buckets are opened, the kinds prune folders and
    the ids reach Parquet and its bloom filters."""
    import uuid

    from metricfold.session import checkpoint_root
    from metricfold.sinks import state_table as tbl
    root = f"{checkpoint_root(spark)}/state-point-{uuid.uuid4().hex}"
    tbl.apply_set(spark, root, fold.fold_state(fx.updates(spark, sf_dir)), 0)
    return tbl.lookup_point(spark, root, [("purchase.u7", "gauge"), ("click.u7", "counter")])


@register("union_kinds", with_views("""
SELECT id, 'counter' AS mtype, CAST(sum(delta) AS BIGINT) AS delta, CAST(NULL AS DOUBLE) AS value
FROM updates WHERE type = 'counter' AND delta IS NOT NULL GROUP BY id
UNION ALL
SELECT id, 'gauge' AS mtype, CAST(NULL AS BIGINT) AS delta, arg_max(value, seq) AS value
FROM updates WHERE type = 'gauge' AND value IS NOT NULL GROUP BY id""", updates=UPDATES))
def q_union_kinds(spark, sf_dir):
    """SET-1: counter map and gauge map concatenated."""
    return st.union_kinds(fx.updates(spark, sf_dir))


@register("list_lines", with_views("""
SELECT id, mtype,
       id || ' = ' || CASE WHEN mtype = 'counter' THEN CAST(delta AS VARCHAR)
                           ELSE printf('%f', value) END AS line
FROM state""", updates=UPDATES, state=FOLD_STATE_SQL))
def q_list_lines(spark, sf_dir):
    """SCL-11 + SCL-5: memory-store listing lines (`id = 3.140000`)."""
    return st.list_lines(fold.fold_state(fx.updates(spark, sf_dir)), 6)


@register("list_lines_table", with_views("""
SELECT id, mtype,
       id || ' = ' || CASE WHEN mtype = 'counter' THEN CAST(delta AS VARCHAR)
                           ELSE printf('%.2f', value) END AS line
FROM state""", updates=UPDATES, state=FOLD_STATE_SQL))
def q_list_lines_table(spark, sf_dir):
    """SCL-11 + SCL-5: table-store listing lines (two decimals)."""
    return st.list_lines(fold.fold_state(fx.updates(spark, sf_dir)), 2)


@register("format_value", with_views(r"""
SELECT id, mtype,
       CASE WHEN mtype = 'counter' THEN CAST(delta AS VARCHAR)
            ELSE regexp_replace(CAST(value AS VARCHAR), '\.0$', '') END AS text
FROM state""", updates=UPDATES, state=FOLD_STATE_SQL))
def q_format_value(spark, sf_dir):
    """SCL-4: value-lookup text of each metric (shortest gauge text)."""
    return st.value_texts(fold.fold_state(fx.updates(spark, sf_dir)))


@register("format_fixed", """
SELECT event_id AS seq, printf('%.2f', value) AS f2, printf('%f', value) AS f6,
       printf('%.2f', value / 8) AS f2_eighth, printf('%f', value * 1000003) AS f6_scaled
FROM events""")
def q_format_fixed(spark, sf_dir):
    """SCL-5: fixed-point texts (2 and 6 places, exact half-even rounding),
    on the event values, their eighths (exact binary ties) and a scaled copy."""
    e = fx.table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("seq"),
                    fixed_text("value", 2).alias("f2"), fixed_text("value", 6).alias("f6"),
                    fixed_text(F.col("value") / 8, 2).alias("f2_eighth"),
                    fixed_text(F.col("value") * 1000003, 6).alias("f6_scaled"))


@register("lookup_path", with_views("""
SELECT r.seq, r.id, r.type,
       CASE WHEN r.type = 'counter' THEN s.delta END AS delta_found,
       CASE WHEN r.type = 'gauge' THEN s.value END AS value_found
FROM req r JOIN state s ON s.id = r.id AND s.mtype = r.type
WHERE r.type IN ('gauge', 'counter')""", updates=UPDATES, req=_REQ_SQL, state=FOLD_STATE_SQL))
def q_lookup_path(spark, sf_dir):
    """JOIN-2, path policy: the kind is matched case-sensitively (mixed-case
    requests are refused instead of lower-cased)."""
    u = fx.updates(spark, sf_dir)
    return st.lookup(u.select("seq", "id", "type"), fold.fold_state(u), lower=False)


@register("encode_updates", with_views("""
SELECT seq, '{"id":' || to_json(id) || ',"type":' || to_json(type)
       || CASE WHEN delta IS NULL THEN '' ELSE ',"delta":' || CAST(delta AS VARCHAR) END
       || CASE WHEN value IS NULL THEN '' ELSE ',"value":' || CAST(value AS VARCHAR) END
       || '}' AS json
FROM updates""", updates=UPDATES))
def q_encode_updates(spark, sf_dir):
    """SCL-9: every update as its JSON record, NULL delta/value omitted."""
    u = fx.updates(spark, sf_dir)
    return u.select("seq", encode_update("id", "type", "delta", "value").alias("json"))


@register("lookup_text", with_views(r"""
SELECT r.seq, r.id, r.type,
       CASE WHEN r.type = 'counter' THEN CAST(s.delta AS VARCHAR)
            ELSE regexp_replace(CAST(s.value AS VARCHAR), '\.0$', '') END AS text
FROM req r JOIN state s ON s.id = r.id AND s.mtype = r.type
WHERE r.type IN ('gauge', 'counter')""", updates=UPDATES, req=_REQ_SQL, state=FOLD_STATE_SQL))
def q_lookup_text(spark, sf_dir):
    """PRJ-4 + SCL-4: path-form value lookups answered as text."""
    u = fx.updates(spark, sf_dir)
    return st.lookup_text(u.select("seq", "id", "type"), fold.fold_state(u))


@register("scan_state", with_views(FOLD_STATE_SQL, updates=UPDATES))
def q_scan_state(spark, sf_dir):
    """SNK-3 + SRC-5 through the stored table: the earlier updates are folded
    and stored, the later ones upserted as the next batch (which rewrites the
    buckets of its ids), and the state is read back."""
    import uuid

    from metricfold.session import checkpoint_root
    from metricfold.sinks import state_table as tbl
    root = f"{checkpoint_root(spark)}/state-scan-{uuid.uuid4().hex}"
    before, after = _split(spark, sf_dir)
    tbl.apply_set(spark, root, fold.fold_state(before), 0)
    tbl.apply_batch(spark, root, after, 1)
    return tbl.read_state(spark, root)


@register("snapshot_roundtrip", with_views(FOLD_STATE_SQL, updates=UPDATES))
def q_snapshot_roundtrip(spark, sf_dir):
    """SNK-1 + SRC-4: the folded state saved as a JSON snapshot (fresh folder
    under the checkpoint root) and restored from it."""
    import uuid

    from metricfold.session import checkpoint_root
    from metricfold.sinks.snapshot import save_snapshot
    from metricfold.sources.updates import restore_snapshot
    root = f"{checkpoint_root(spark)}/snapshot-{uuid.uuid4().hex}"
    path = save_snapshot(fold.fold_state(fx.updates(spark, sf_dir)), root, 1)
    return restore_snapshot(spark, path)


@register("stream_fold", with_views(FOLD_STATE_SQL, updates=UPDATES))
def q_stream_fold(spark, sf_dir):
    """STR-1: the updates arrive as a file stream (one file per trigger);
    Spark's state store keeps the fold; each micro-batch's changed keys
    replace those of a state table, which is read back."""
    import uuid

    from metricfold.session import checkpoint_root
    from metricfold.sinks import state_table as tbl
    from metricfold.streaming import ingest
    tag = uuid.uuid4().hex
    land = f"{checkpoint_root(spark)}/stream-in-{tag}"
    root = f"{checkpoint_root(spark)}/stream-state-{tag}"
    u = fx.updates(spark, sf_dir)
    u.repartition(4, "batch_id").write.parquet(land)
    stream = spark.readStream.schema(u.schema).option("maxFilesPerTrigger", 1).parquet(land)
    q = ingest.start_fold_table(stream, root, f"stream-fold-{tag}")
    q.awaitTermination()
    return tbl.read_state(spark, root)


@register("stream_upsert", with_views(FOLD_STATE_SQL, updates=UPDATES))
def q_stream_upsert(spark, sf_dir):
    """STR-1 + SNK-3: the updates arrive as a file stream and the state writer
    upserts each micro-batch into the state table, with an audit event for each
    request; the stored state is read back. (Across micro-batches arrival order
    decides gauges; that case is in tests/test_streaming.py.)"""
    import uuid

    from metricfold.session import checkpoint_root
    from metricfold.sinks import events as ev
    from metricfold.sinks import state_table as tbl
    from metricfold.streaming import ingest
    tag = uuid.uuid4().hex
    base = checkpoint_root(spark)
    land, root, audit = (f"{base}/{n}-{tag}" for n in ("upsert-in", "upsert-state", "upsert-audit"))
    u = fx.updates(spark, sf_dir)
    u.write.parquet(land)
    outcomes = {}
    q = ingest.start_state_writer(spark.readStream.schema(u.schema).parquet(land), root, f"upsert-{tag}",
                                  audit_sinks={"file": lambda df: ev.write_audit_batch(df, audit)},
                                  on_audit=outcomes.__setitem__)
    q.awaitTermination()
    failed = {b: o for b, o in outcomes.items() if any(o.values())}
    if failed or not outcomes:
        raise RuntimeError(f"audit failed: {failed}")
    return tbl.read_state(spark, root)


@register("stream_replay", with_views(f"""
{FOLD_STATE_SQL}
UNION ALL
SELECT id, 'counter' AS mtype, CAST(sum(delta) AS BIGINT) AS delta, CAST(NULL AS DOUBLE) AS value
FROM lines GROUP BY id""", updates=UPDATES, lines=fx.lineitem_counters_sql()))
def q_stream_replay(spark, sf_dir):
    """STR-4: two feeds, each with a state table of its own, are replayed from
    the start after their checkpoints are lost; the batch ids alone show that
    the state holds them, and nothing changes. Both states are listed."""
    import uuid

    from metricfold.session import checkpoint_root
    from metricfold.sinks import state_table as tbl
    from metricfold.streaming import ingest
    tag = uuid.uuid4().hex
    base = checkpoint_root(spark)
    fx.updates(spark, sf_dir).write.parquet(f"{base}/replay-updates-{tag}")
    fx.lineitem_counters(spark, sf_dir).withColumn("seq", F.monotonically_increasing_id()) \
        .write.parquet(f"{base}/replay-lines-{tag}")
    states = []
    for feed in ("updates", "lines"):
        land, root = f"{base}/replay-{feed}-{tag}", f"{base}/replay-state-{feed}-{tag}"
        schema = spark.read.parquet(land).schema
        for run in range(2):
            stream = spark.readStream.schema(schema).parquet(land)
            ingest.start_state_writer(stream, root, f"replay-{feed}-{run}-{tag}").awaitTermination()
        states.append(tbl.read_state(spark, root))
    return states[0].unionAll(states[1])


# Strict batches: counters of even users; gauges of all users, which conflict
# with them; gauges of odd users; then counters again, which change nothing
# where an id is a gauge; gauges of errors, which conflict; and all the rest.
_STRICT_BATCHES = ("event_type = 'click' AND user_id % 2 = 0", "event_type = 'purchase'",
                   "event_type = 'purchase' AND user_id % 2 = 1", "event_type = 'view'",
                   "event_type = 'click' AND user_id % 2 = 1", "event_type = 'error'",
                   "event_type IS NULL OR event_type NOT IN ('click', 'view', 'purchase', 'error')")
_STRICT_SQL = with_views("""
SELECT id, 'counter' AS mtype, CAST(sum(delta) AS BIGINT) AS delta, CAST(NULL AS DOUBLE) AS value FROM u
WHERE event_type IN ('click', 'view') AND type = 'counter' AND delta IS NOT NULL AND id NOT IN (SELECT id FROM gauges)
GROUP BY id
UNION ALL SELECT id, 'gauge', CAST(NULL AS BIGINT), last FROM gauges""",
    u=fx.updates_sql("untyped").replace("event_id AS seq", "event_id AS seq, event_type, user_id", 1),
    gauges="""SELECT id, arg_max(value, seq) AS last FROM u WHERE event_type = 'purchase' AND user_id % 2 = 1
              AND value IS NOT NULL GROUP BY id""")


@register("strict_batch", _STRICT_SQL)
def q_strict_batch(spark, sf_dir):
    """AGG-4b: all events as seven all-or-nothing strict batches on a fresh
    state table, then read back. The second and the sixth send gauges to
    counters and leave nothing; counters sent to gauges, and those whose kind is
    not spelled exactly, change nothing."""
    import uuid

    from metricfold.session import checkpoint_root
    from metricfold.sinks import state_table as tbl
    root = f"{checkpoint_root(spark)}/strict-{uuid.uuid4().hex}"
    rows = fx.conflict_updates(spark, sf_dir).join(
        fx.table(spark, sf_dir, "events").selectExpr("event_id AS seq", "event_type", "user_id"), "seq")
    done = [tbl.apply_strict_batch(spark, root, rows.where(which), i) is not None
            for i, which in enumerate(_STRICT_BATCHES)]
    if done != [True, False, True, True, True, False, True]:
        raise RuntimeError(f"strict batches committed: {done}")
    return tbl.read_state(spark, root)


@register("stream_snapshot", with_views(FOLD_STATE_SQL, updates=UPDATES))
def q_stream_snapshot(spark, sf_dir):
    """SNK-2: the streaming state writer saves a JSON snapshot at its interval
    (0 s here: with each commit); the newest complete snapshot is restored."""
    import uuid

    from metricfold.session import checkpoint_root
    from metricfold.sinks.snapshot import latest_snapshot
    from metricfold.sources.updates import restore_snapshot
    from metricfold.streaming import ingest
    tag = uuid.uuid4().hex
    base = checkpoint_root(spark)
    land, root, snaps = (f"{base}/{n}-{tag}" for n in ("snap-in", "snap-state", "snaps"))
    u = fx.updates(spark, sf_dir)
    u.write.parquet(land)
    stream = spark.readStream.schema(u.schema).parquet(land)
    q = ingest.start_state_writer(stream, root, f"snap-{tag}", snapshot_root=snaps, snapshot_seconds=0)
    q.awaitTermination()
    return restore_snapshot(spark, latest_snapshot(spark, snaps))


@register("listing_status", with_views("""
SELECT count(*) AS n_metrics, count(*) = 0 AS is_empty FROM state
UNION ALL SELECT count(*), count(*) = 0 FROM state WHERE mtype = 'histogram'""", updates=UPDATES,
                                       state=FOLD_STATE_SQL))
def q_listing_status(spark, sf_dir):
    """AGG-8: metric count and emptiness of the listing over the state, and
    over that of a kind that is never stored (an empty listing)."""
    state = fold.fold_state(fx.updates(spark, sf_dir))
    return st.listing_status(state).unionAll(st.listing_status(state.where("mtype = 'histogram'")))
