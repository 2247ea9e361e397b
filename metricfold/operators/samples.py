"""Host samples: conform, merge, reshape, poll windows and report batches.

A sample row is one collection (poll) of one provider on one host, ordered
per host by ``order_cols`` (poll sequence, then provider index). The
reference keeps one merged sample per agent process; here every host's
merge is a group of one aggregation, so many hosts run in parallel and a hot
host is pre-reduced map-side (all aggregates below are mergeable).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricfold.schemas import COUNTER, CPU_FIELD, GAUGE, POLL_COUNTER, SAMPLE_FIELDS, ZERO_TEST_FIELDS


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _order(df: DataFrame, order_cols: list[str]) -> Column:
    """The order as one fixed-width value, so that aggregates over it stay hash
    aggregates: whole numbers of several columns become one decimal (the first
    counts most; the others lie within 32 bits)."""
    if len(order_cols) == 1:
        return F.col(order_cols[0])
    if len(order_cols) > 2 or any(df.schema[c].dataType.simpleString() not in _WHOLE for c in order_cols):
        return F.struct(*order_cols)
    return F.col(order_cols[0]).cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)") + F.col(order_cols[1])


Provider = Callable[[SparkSession], DataFrame]


def collect_providers(spark: SparkSession, providers: list[DataFrame | Provider]
                      ) -> tuple[list[DataFrame], dict[int, str]]:
    """SRC-6 extension point: each provider is a frame or a callable that
    builds one. Providers are tried in order; one that fails is skipped and
    reported (as the collector logs and goes on). Each kept frame gets its
    ``provider`` index, the tie-break of the merge order."""
    frames, errors = [], {}
    for i, p in enumerate(providers):
        try:
            df = p(spark) if callable(p) else p
            frames.append(df if "provider" in df.columns else df.withColumn("provider", F.lit(i)))
        except Exception as exc:  # a failing provider does not stop the others
            errors[i] = f"{type(exc).__name__}: {exc}"
    return frames, errors


def read_samples(frames: list[DataFrame]) -> DataFrame:
    """SRC-6: union recorded samples of any providers by column name and
    conform them to the SAMPLE schema. A field a provider does not report is
    0 (the Go zero value), a missing CPU list is empty."""
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    cols = [c for c in ("host", "ord", "provider", "ts") if c in df.columns]
    out = [F.col(c) for c in cols]
    for name in SAMPLE_FIELDS:
        v = F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in df.columns else F.lit(0.0)
        out.append(v.alias(name))
    cpu = F.col(CPU_FIELD) if CPU_FIELD in df.columns else F.lit(None)
    out.append(F.coalesce(cpu.cast("array<double>"), F.array().cast("array<double>")).alias(CPU_FIELD))
    return df.select(*out)


def is_zero_sample(df: DataFrame | None = None) -> Column:
    """FLT-8: Alloc, Sys and TotalAlloc all zero (a missing field counts 0)."""
    cols = df.columns if df is not None else ZERO_TEST_FIELDS
    parts = [F.coalesce(F.col(f), F.lit(0.0)) == 0 for f in ZERO_TEST_FIELDS if f in cols]
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def _merge_parts(df: DataFrame, fields: list[str], o: Column, cpu: str | None) -> list[Column]:
    """Mergeable pieces of the sample merge for one group (see merge_samples),
    all of fixed width: ``_k`` the first place with a non-empty sample, ``_last``
    the last place, for each field the last non-zero value and its place, and
    the place of the last non-empty CPU list (the list itself is fetched later)."""
    parts = [F.min(F.when(~is_zero_sample(df), o)).alias("_k"), F.max(o).alias("_last")]
    for c in fields:
        x = F.coalesce(F.col(c), F.lit(0.0))
        held = F.when(x != 0, o)
        parts += [F.max_by(x, held).alias(f"_v_{c}"), F.max(held).alias(f"_vo_{c}")]
    if cpu:
        parts.append(F.max(F.when(F.size(cpu) > 0, o)).alias(f"_vo_{cpu}"))
    return parts


def _since() -> Column:
    # While all samples are empty each replaces the one before: the last counts.
    return F.coalesce("_k", "_last")


def _merged(c: str) -> Column:
    return F.when(F.col(f"_vo_{c}") >= _since(), F.col(f"_v_{c}")).otherwise(F.lit(0.0)).alias(c)


def _with_cpu(state: DataFrame, samples: DataFrame, key: str, o: Column, cpu: str) -> DataFrame:
    """Late materialisation: ``state`` knows the place of each CPU list
    (``_cpu_at``); the lists are fetched by an equi-join on host and place."""
    lists = samples.where(F.size(cpu) > 0).select(F.col(key).alias("_h"), o.alias("_o"), F.col(cpu).alias("_list"))
    none = F.array().cast("array<double>")
    return state.join(lists, F.col(key).eqNullSafe(F.col("_h")) & (F.col("_cpu_at") == F.col("_o")), "left") \
        .withColumn(cpu, F.coalesce("_list", none)).drop("_h", "_o", "_list", "_cpu_at")


def _cpu_at(cpu: str) -> Column:
    return F.when(F.col(f"_vo_{cpu}") >= _since(), F.col(f"_vo_{cpu}")).alias("_cpu_at")


def merge_samples(samples: DataFrame, fields: list[str] | None = None, key: str = "host",
                  order_cols: list[str] | None = None, cpu: str | None = CPU_FIELD) -> DataFrame:
    """AGG-6: the collector's merge of successive samples, per host.

    Sequentially: while the merged sample is "empty" (FLT-8) a new sample
    replaces it whole; afterwards a field takes the new value only when it
    is non-zero (the CPU list only when non-empty). Closed form, one pass:
    ``k`` = first position with a non-empty sample (the last position if there
    is none); per field the last non-zero value at or after ``k``, else 0. The
    order is unique per host.
    """
    order_cols = order_cols or ["ord"]
    fields = fields or [f for f in SAMPLE_FIELDS if f in samples.columns]
    cpu = cpu if cpu in samples.columns else None
    o = _order(samples, order_cols)
    agg = samples.groupBy(key).agg(*_merge_parts(samples, fields, o, cpu))
    out = agg.select(key, *[_merged(c) for c in fields], *([_cpu_at(cpu)] if cpu else []))
    return _with_cpu(out, samples, key, o, cpu) if cpu else out


# Fixed value: layout of the sample summary text (fields Alloc, HeapAlloc, Sys).
SUMMARY_FIELDS = ("Alloc", "HeapAlloc", "Sys")


def summary_text(samples: DataFrame) -> Column:
    """SCL-5: ``MemoryMetrics{Alloc: a, HeapAlloc: h, Sys: s}`` with two
    decimals (exact, half-even); a field the sample lacks prints as 0.00."""
    from metricfold.functions.scalars import fixed_text
    parts = []
    for i, f in enumerate(SUMMARY_FIELDS):
        v = F.coalesce(F.col(f), F.lit(0.0)) if f in samples.columns else F.lit(0.0)
        parts += [F.lit(("MemoryMetrics{" if i == 0 else ", ") + f + ": "), fixed_text(v, 2)]
    return F.concat(*parts, F.lit("}"))


def unpivot_samples(samples: DataFrame, fields: list[str] | None = None,
                    ids: list[str] | None = None) -> DataFrame:
    """PRJ-1: wide -> long (ids..., id, value); zero fields are emitted."""
    ids = ids or [c for c in ("host", "ord") if c in samples.columns]
    fields = fields or [f for f in SAMPLE_FIELDS if f in samples.columns]
    return samples.unpivot(ids, fields, "id", "value")


def explode_cpu(samples: DataFrame, ids: list[str] | None = None, cpu: str = CPU_FIELD) -> DataFrame:
    """PRJ-2: per-core list -> rows ``CPUutilization{i}``, i from 1."""
    ids = ids or [c for c in ("host", "ord") if c in samples.columns]
    ex = samples.select(*ids, F.posexplode(cpu).alias("_pos", "value"))
    return ex.select(*ids, F.concat(F.lit(cpu), (F.col("_pos") + 1).cast("string")).alias("id"),
                     F.col("value").cast("double").alias("value"))


def _polls(poll_col: str | None) -> Column:
    # One row per poll by default; with several providers per poll, count
    # the distinct poll ids instead (the reference counts ticks, not samples).
    return F.count_distinct(poll_col) if poll_col else F.count(F.lit(1))


def poll_count(samples: DataFrame, every: str = "10 seconds", key: str = "host",
               ts_col: str = "ts", start_time: str | None = None,
               poll_col: str | None = None) -> DataFrame:
    """AGG-5: polls per host per tumbling report window (epoch-aligned; use
    ``start_time`` for an offset). ``poll_col`` counts distinct polls when a
    poll has several sample rows (one per provider)."""
    w = F.window(ts_col, every, every, start_time) if start_time else F.window(ts_col, every)
    return samples.groupBy(key, w.alias("w")).agg(_polls(poll_col).alias("poll_count")) \
        .select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "poll_count")


def _update(id_: Column, kind: str, delta: Column, value: Column) -> Column:
    return F.struct(id_.alias("id"), F.lit(kind).alias("type"), delta.cast("bigint").alias("delta"),
                    value.cast("double").alias("value"))


def report_items(fields: list[str], values: list[Column], polls: Column, cpu: Column | None) -> Column:
    """The updates of one report as an array: a gauge for each field and core,
    and the poll counter (its delta is null if there were no polls)."""
    def gauge(id_: Column, value: Column) -> Column:
        return _update(id_, GAUGE, F.lit(None), value)

    items = F.array(*[gauge(F.lit(f), v) for f, v in zip(fields, values)],
                    _update(F.lit(POLL_COUNTER), COUNTER, F.when(polls != 0, polls), F.lit(None)))
    if cpu is None:
        return items
    return F.concat(items, F.transform(cpu, lambda x, i: gauge(F.concat(F.lit(CPU_FIELD), (i + 1).cast("string")), x)))


def report_batches(samples: DataFrame, fields: list[str] | None = None, every: str = "10 seconds",
                   key: str = "host", ts_col: str = "ts",
                   order_cols: list[str] | None = None, poll_col: str | None = None,
                   cpu: str | None = CPU_FIELD, packed: bool = False) -> DataFrame:
    """SNK-6 / PRJ-2 / PRJ-3 / SET-2 / FLT-9: the update batch an agent sends at
    the end of each report window: every merged field as a gauge (the merge runs
    over all samples so far, it is never reset), a gauge per core of the merged
    CPU list, and the ``PollCount`` counter of that window when non-zero.

    The samples are reduced to mergeable pieces per (host, window) first, in a
    partial aggregate; the merge state after each window is a running
    combination of a host's pieces. A host has one row for each report interval
    at most, however many samples it sends, and the running frame spills. Nothing
    is written; the fields are read once, the CPU lists of the chosen samples by
    a narrow second scan. Windows without samples send nothing. ``packed`` gives
    one row per report with its updates as an array, so that nothing has to
    gather the rows of a report again.
    """
    order_cols = order_cols or ["ord"]
    fields = fields or [f for f in SAMPLE_FIELDS if f in samples.columns]
    cpu = cpu if cpu in samples.columns else None
    o = _order(samples, order_cols)
    per_window = samples.groupBy(key, F.window(ts_col, every).alias("w")).agg(
        _polls(poll_col).alias("_polls"), *_merge_parts(samples, fields, o, cpu)) \
        .withColumn("window_start", F.col("w.start")).drop("w")
    run = Window.partitionBy(key).orderBy("window_start") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = per_window.select(
        key, "window_start", "_polls", F.min("_k").over(run).alias("_k"), F.max("_last").over(run).alias("_last"),
        *[x for c in fields for x in (F.max_by(f"_v_{c}", f"_vo_{c}").over(run).alias(f"_v_{c}"),
                                      F.max(f"_vo_{c}").over(run).alias(f"_vo_{c}"))],
        *([F.max(f"_vo_{cpu}").over(run).alias(f"_vo_{cpu}")] if cpu else []))
    state = running.select(key, "window_start", "_polls", *[_merged(c) for c in fields],
                           *([_cpu_at(cpu)] if cpu else []))
    if cpu:
        state = _with_cpu(state, samples, key, o, cpu)

    def sent(x: Column) -> Column:
        return (x["type"] == GAUGE) | x["delta"].isNotNull()

    if packed:  # samples that repeat a place can leave several states of a report
        wide = F.collect_list(F.struct("_polls", *fields, *([cpu] if cpu else []))).alias("_s")
        updates = F.transform("_s", lambda s: report_items(fields, [s[c] for c in fields], s["_polls"], s[cpu] if cpu else None))
        # Encoding costs far more than the bytes of a report show: no coalescing by bytes here.
        parts = int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return state.repartition(parts, key, "window_start").groupBy(key, "window_start").agg(wide) \
            .select(key, "window_start", F.filter(F.flatten(updates), sent).alias("updates"))
    # Gauges and the poll counter leave in one pass (no second aggregation).
    items = report_items(fields, [F.col(c) for c in fields], F.col("_polls"), F.col(cpu) if cpu else None)
    rows = state.select(key, "window_start", F.inline(items))
    return rows.where(sent(F.struct("type", "delta")))
