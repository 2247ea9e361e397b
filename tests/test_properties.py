"""Property tests: the fold does not depend on partitioning,
split-and-upsert equals one pass, the one-pass merge equals the collector's
sequential loop, and the text formatters are exact."""

import random
import struct
from decimal import Decimal

from pyspark.sql import functions as F

from metricfold.functions.scalars import fixed_text, shortest_text
from metricfold.operators import fold, samples
from metricfold.operators import state as st
from metricfold.schemas import HOST_FIELDS, RUNTIME_FIELDS
from metricfold.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fold_independent_of_partitioning(spark):
    u = fx.updates(spark, SF_SMALL)
    base = _rows(fold.fold_state(u))
    for n in (1, 3, 17):
        assert _rows(fold.fold_state(u.repartition(n))) == base
    # Order of arrival across partitions must not matter either.
    assert _rows(fold.fold_state(u.orderBy(F.rand(7)).repartition(5))) == base


def test_split_and_upsert_equals_one_pass(spark):
    u = fx.updates(spark, SF_SMALL)
    one = _rows(fold.fold_state(u))
    state = None
    for lo, hi in ((0, 3), (3, 5), (5, 10**9)):
        part = u.where((F.col("batch_id") >= lo) & (F.col("batch_id") < hi))
        state = fold.fold_state(part) if state is None else st.upsert_state(state, part)
    assert _rows(state) == one


def _sequential_merge(history, fields):
    cur = {f: 0.0 for f in fields}
    cpu = []
    for s in history:
        if cur["Alloc"] == 0 and cur["Sys"] == 0 and cur["TotalAlloc"] == 0:
            cur = {f: s[f] for f in fields}
            cpu = list(s["cpu"])
            continue
        for f in fields:
            if s[f] != 0:
                cur[f] = s[f]
        if len(s["cpu"]) > 0:
            cpu = list(s["cpu"])
    return cur, cpu


def test_merge_equals_sequential_fold(spark):
    fields = ["Alloc", "Sys", "TotalAlloc", "HeapAlloc"]
    rng = random.Random(3)
    rows, expect = [], {}
    for host in range(300):
        hist = []
        for o in range(rng.randint(1, 12)):
            s = {f: (0.0 if rng.random() < 0.6 else float(rng.randint(-3, 9))) for f in fields}
            s["cpu"] = [] if rng.random() < 0.5 else [float(rng.randint(0, 99))] * rng.randint(1, 3)
            hist.append(s)
            rows.append((host, o, *[s[f] for f in fields], s["cpu"]))
        expect[host] = _sequential_merge(hist, fields)
    schema = "host long, ord long, " + ", ".join(f"{f} double" for f in fields) + \
        ", CPUutilization array<double>"
    df = spark.createDataFrame(rows, schema).repartition(7)
    got = samples.merge_samples(df, fields, cpu="CPUutilization").collect()
    assert len(got) == 300
    for r in got:
        cur, cpu = expect[r.host]
        assert [r[f] for f in fields] == [cur[f] for f in fields], r.host
        assert list(r.CPUutilization or []) == cpu, r.host


def test_report_batches_follow_running_merge(spark):
    # Window-by-window reports equal the merge over each prefix of samples.
    w = fx.wide(spark, SF_SMALL)
    rep = samples.report_batches(w, list(fx.WIDE_FIELDS), every="1 day")
    last_window = rep.groupBy("host").agg(F.max("window_start").alias("window_start"))
    final = rep.join(last_window, ["host", "window_start"]).where(F.col("type") == "gauge") \
        .groupBy("host").pivot("id", list(fx.WIDE_FIELDS)).agg(F.first("value"))
    merged = samples.merge_samples(w, list(fx.WIDE_FIELDS)).drop("CPUutilization")
    assert _rows(final.select("host", *fx.WIDE_FIELDS)) == _rows(merged)
    polls = rep.where(F.col("type") == "counter").agg(F.sum("delta")).collect()[0][0]
    assert polls == w.count()


def _random_doubles(n, seed):
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        v = struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0]
        if v == v and abs(v) != float("inf"):
            out.append(v)
    return out + [rng.uniform(-1e4, 1e4) for _ in range(n)] + \
        [2.675, 0.125, 1e23, 2e-3, 1e7, 1e-3, 5e-324, -0.0, 0.0, 1.0, 0.1 + 0.2]


def _shortest_plain(x):
    # Shortest round-trip digits, no exponent.
    r = repr(float(x))
    if "e" in r:
        r = format(Decimal(r), "f")
    return r.rstrip("0").rstrip(".") if "." in r else r


def test_formatting_exact(spark):
    rng = random.Random(5)
    vals = _random_doubles(600, 11) + [rng.randint(0, 10 ** 6) / 8 for _ in range(500)] \
        + [2.0 ** k for k in range(-1074, 1024, 7)] + [float(f"1e{k}") for k in range(-323, 309, 5)] \
        + [rng.randint(1, 3000) * 5e-324 for _ in range(300)] + [0.5, 1.5, 2.5, 5e-7, 4.9999999e-7, 0.9999995, 0.995,
                                                                2.0 ** 63, 2.0 ** 63 - 1024, 9.892985009487028e17]
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(8)
    texts = df.select("v", shortest_text("v").alias("s"), fixed_text("v", 2).alias("f2"),
                      fixed_text("v", 6).alias("f6"), fixed_text("v", 0).alias("f0"))
    assert "Python" not in texts._jdf.queryExecution().executedPlan().toString()
    for r in texts.collect():
        assert float(r.s) == r.v and "e" not in r.s.lower()
        assert r.s == _shortest_plain(r.v)
        assert (r.f2, r.f6, r.f0) == ("%.2f" % r.v, "%f" % r.v, "%.0f" % r.v)


def test_formatting_special_values(spark):
    df = spark.createDataFrame([(0, float("nan")), (1, float("inf")), (2, float("-inf")), (3, None), (4, -0.0), (5, 1e23),
                                (6, 2.675), (7, 0.125)], "i int, v double")
    got = [tuple(r) for r in df.select(shortest_text("v"), fixed_text("v", 2)).orderBy("i").collect()]
    assert got == [("NaN", "NaN"), ("+Inf", "+Inf"), ("-Inf", "-Inf"), (None, None), ("-0", "-0.00"),
                   ("100000000000000000000000", "99999999999999991611392.00"), ("2.675", "2.67"), ("0.125", "0.12")]


def test_report_batches_is_lazy_and_reads_fields_once(spark):
    # No job runs while the plan is built; the fields are read once, and the
    # CPU lists by a scan of what they are made of only. Nothing wide is sorted.
    w = fx.wide(spark, SF_SMALL)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy-report", "plan only")
    rep = samples.report_batches(w, every="1 hour")
    assert list(tracker.getJobIdsForGroup("lazy-report")) == []
    spark.sparkContext.setJobGroup("rest", "")
    plan = rep._jdf.queryExecution().executedPlan().toString()
    reads = [x.split(">")[0] for x in plan.split("ReadSchema: ")[1:]]
    assert len(reads) == 2 and sum("ts:" in x for x in reads) == 1 and "SortAggregate" not in plan
    assert "SortAggregate" not in samples.merge_samples(w)._jdf.queryExecution().executedPlan().toString()
    # A list of two cores gives two rows of its own.
    cores = rep.where("id like 'CPUutilization%'").select("id").distinct()
    assert sorted(r.id for r in cores.collect()) == ["CPUutilization1", "CPUutilization2"]


def test_providers_merge_in_poll_then_provider_order(spark):
    # Two providers per poll; a failing provider is skipped and reported.
    w = fx.wide(spark, SF_SMALL)

    def runtime(s):
        return w.select("host", "ord", "ts", *RUNTIME_FIELDS)

    def host(s):
        return w.select("host", "ord", "ts", *HOST_FIELDS, "CPUutilization")

    def broken(s):
        raise OSError("sensor unavailable")

    frames, errors = samples.collect_providers(spark, [runtime, broken, host])
    assert list(errors) == [1] and "sensor unavailable" in errors[1]
    conformed = samples.read_samples(frames)
    merged = samples.merge_samples(conformed, list(fx.WIDE_FIELDS), order_cols=["ord", "provider"])
    # The runtime provider here reports only the three fields of the
    # emptiness test, so splitting each poll into (runtime, host) samples
    # merged in (ord, provider) order equals one merged row per poll.
    assert _rows(merged) == _rows(samples.merge_samples(w, list(fx.WIDE_FIELDS)))


def test_report_batches_do_not_depend_on_session_time_zone(spark):
    w = fx.wide(spark, SF_SMALL)
    utc = _rows(samples.report_batches(w, list(fx.WIDE_FIELDS), every="1 hour"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        local = _rows(samples.report_batches(w, list(fx.WIDE_FIELDS), every="1 hour"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert local == utc


def test_poll_counts_with_several_providers_per_poll(spark):
    fields = ["Alloc", "Sys", "TotalAlloc", "FreeMemory"]
    w = fx.wide(spark, SF_SMALL).select("host", "ord", "ts", *fields)
    frames, _ = samples.collect_providers(spark, [
        w.select("host", "ord", "ts", *fields[:3]),
        w.select("host", "ord", "ts", fields[3])])
    split = samples.read_samples(frames)
    assert _rows(samples.poll_count(split, "1 day", poll_col="ord")) == _rows(samples.poll_count(w, "1 day"))
    got = samples.report_batches(split, fields, every="1 day", order_cols=["ord", "provider"], poll_col="ord")
    assert _rows(got) == _rows(samples.report_batches(w, fields, every="1 day"))
