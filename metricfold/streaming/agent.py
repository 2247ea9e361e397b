"""The live agent (AGG-6, AGG-5, SNK-6): arbitrary state with timers.

``report_stream`` keeps, for each host, the merged sample and the polls of each
open report window in Spark's state store, and emits the window's update batch
when the watermark passes its end: every merged field as a gauge, one gauge for
each core, and the poll counter. It is the stream form of
``operators.samples.report_batches`` and gives the same rows.

State stays small whatever a host sends: a window is kept as its poll count,
the first place with a sample that is not empty, and for each field the last
value that is not zero with its place. Such parts combine in any order, so
late and reordered samples inside the watermark change nothing. A sample that
comes after its window was reported counts for the window open at the
watermark, as polls after a report count for the next one. Windows without
samples report nothing.

The state is called a few times for each host and micro-batch, not for each
window: the parts of all windows are appended to one list in one call (which is
merged when it has twice the parts it had after the last merge), a host has one
timer, that of its first open window, and each report leaves Python as one row
that Spark spreads over its fields.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from metricfold.operators.samples import report_items
from metricfold.schemas import CPU_FIELD, SAMPLE_FIELDS, ZERO_TEST_FIELDS
from metricfold.streaming.ingest import hosted

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Parts of some windows as one row: arrays of 8-byte numbers.
_PARTS = ", ".join(f"{c} binary" for c in ("starts", "polls", "last", "first", "at", "value", "cpu_at", "cpu_n", "cpu"))
_NONE = -(1 << 62)  # no place yet
_NEVER = 1 << 62  # no timer
_LEAST = 64  # parts of a host that may stay unmerged


def _parts(starts: np.ndarray, place: np.ndarray, x: np.ndarray, cpus: list, tested: list[int]) -> dict[int, tuple]:
    """The mergeable part of one host's samples for each window start."""
    order = np.lexsort((place, starts))
    starts, place, x = starts[order], place[order], np.where(np.isnan(x), 0.0, x)[order]
    cut = np.flatnonzero(np.append(True, starts[1:] != starts[:-1]))
    here, none = np.arange(len(place)), len(place)
    held = x != 0
    row = np.maximum.reduceat(np.where(held, here[:, None], -1), cut)
    at = np.where(row >= 0, place[row], _NONE).tolist()
    value = np.where(row >= 0, x[row, np.arange(x.shape[1])], 0.0).tolist()
    some = np.minimum.reduceat(np.where(held[:, tested].any(axis=1), here, none), cut)
    listed = np.array([cpus[i] is not None and len(cpus[i]) > 0 for i in order])
    core = np.maximum.reduceat(np.where(listed, here, -1), cut)
    stop = np.append(cut[1:], none)
    return {int(starts[a]): (int(b - a), int(place[b - 1]), int(place[some[i]]) if some[i] < none else None, at[i], value[i],
                             int(place[core[i]]) if core[i] >= 0 else _NONE,
                             [float(v) for v in cpus[order[core[i]]]] if core[i] >= 0 else [])
            for i, (a, b) in enumerate(zip(cut, stop))}


def _part(g: pd.DataFrame, fields: list[str], tested: list[int]) -> tuple:
    """The mergeable part of some samples of one host."""
    return _parts(np.zeros(len(g), np.int64), g["ord"].to_numpy(np.int64), g[fields].to_numpy(float),
                  g[CPU_FIELD].tolist(), tested)[0]


def _stored(parts: dict[int, tuple]) -> tuple:
    """Parts by window start as a row of _PARTS."""
    polls, last, first, at, value, cpu_at, cpu = zip(*parts.values())
    first = [_NEVER if f is None else f for f in first]
    wide = (list(parts), polls, last, first, at, value, cpu_at, [len(c) for c in cpu], [v for c in cpu for v in c])
    return tuple(np.array(x, float if i in (5, 8) else np.int64).tobytes() for i, x in enumerate(wide))


def _loaded(row: tuple) -> dict[int, tuple]:
    starts, polls, last, first, at, value, cpu_at, cpu_n, cpu = (
        np.frombuffer(x, float if i in (5, 8) else np.int64) for i, x in enumerate(row))
    n, ends = len(starts), np.cumsum(cpu_n)
    at, value = at.reshape(n, -1).tolist(), value.reshape(n, -1).tolist()
    return {int(s): (int(polls[i]), int(last[i]), None if first[i] == _NEVER else int(first[i]), at[i], value[i], int(cpu_at[i]),
                     cpu[ends[i] - cpu_n[i]:ends[i]].tolist()) for i, s in enumerate(starts)}


def _joined(a: tuple | None, b: tuple) -> tuple:
    """Two parts as one."""
    if a is None:
        return b
    newer = np.asarray(b[3]) >= np.asarray(a[3])
    firsts = [f for f in (a[2], b[2]) if f is not None]
    cpu = b if b[5] >= a[5] else a
    return (a[0] + b[0], max(a[1], b[1]), min(firsts) if firsts else None, np.where(newer, b[3], a[3]).tolist(),
            np.where(newer, b[4], a[4]).tolist(), cpu[5], list(cpu[6]))


class Reports(StatefulProcessor):
    """State of one host: parts of its open windows, and its merged sample."""

    def __init__(self, fields: list[str], every_ms: int, host: str):
        self.fields, self.every, self.host = fields, every_ms, host
        self.tested = [i for i, f in enumerate(fields) if f in ZERO_TEST_FIELDS]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getListState("windows", _PARTS)
        # Parts in the list, parts at which it is merged, and the next timer.
        self.note = handle.getValueState("note", "n bigint, most bigint, timer bigint")
        self.merged = handle.getValueState("merged", _PARTS)

    def _open(self, parts: dict[int, tuple]) -> dict[int, tuple]:
        """``parts`` joined with those in the list."""
        for row in self.windows.get():
            for start, part in _loaded(row).items():
                parts[start] = _joined(part, parts[start]) if start in parts else part
        return parts

    def _keep(self, parts: dict[int, tuple]) -> None:
        self.windows.put([_stored(parts)])

    def _wake(self, timer: int) -> int:
        self.handle.registerTimer(timer)
        return timer

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, parts = timerValues.getCurrentWatermarkInMs(), {}
        for batch in rows:
            at = np.maximum(batch["poll_ms"].to_numpy(np.int64), now)
            found = _parts(at // self.every * self.every, batch["ord"].to_numpy(np.int64),
                           np.stack(batch["fields"].tolist()).astype(float), batch[CPU_FIELD].tolist(), self.tested)
            for start, part in found.items():
                parts[start] = _joined(parts.get(start), part)
        n, most, timer = self.note.get() or (0, _LEAST, _NEVER)
        first = min(parts) + self.every
        n += len(parts)
        if n > most:
            parts = self._open(parts)
            self._keep(parts)
            n, most = len(parts), 2 * len(parts) + _LEAST
        else:
            self.windows.appendValue(_stored(parts))
        self.note.update((n, most, self._wake(first) if first < timer else timer))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if expiredTimerInfo.getExpiryTimeInMs() != self.note.get()[2]:
            return  # an earlier timer reported its windows
        now, parts = timerValues.getCurrentWatermarkInMs(), self._open({})
        due = sorted(start for start in parts if start + self.every <= now)
        old = self.merged.get()
        merged, out = old and _loaded(tuple(old))[0], []
        for start in due:
            part = parts.pop(start)
            merged = _joined(merged, part)
            _, last, first, at, value, cpu_at, cpu = merged
            since = last if first is None else first  # no sample yet but empty ones: the last one whole
            out.append((start, part[0], [v if p >= since else 0.0 for p, v in zip(at, value)], cpu if cpu_at >= since else []))
        self.merged.update(_stored({0: merged}))
        if parts:
            self._keep(parts)
            self.note.update((len(parts), 2 * len(parts) + _LEAST, self._wake(min(parts) + self.every)))
        else:
            self.windows.clear()
            self.note.update((0, _LEAST, _NEVER))
        starts, polls, values, cpus = zip(*out)
        yield pd.DataFrame({self.host: [key[0]] * len(out), "window_start": pd.to_datetime(list(starts), unit="ms"),
                            "polls": polls, "fields": values, CPU_FIELD: cpus})


def report_stream(samples: DataFrame, every_seconds: int = 10, watermark: str = "30 seconds", key: str = "host",
                  ts_col: str = "ts", order_col: str = "ord", fields: list[str] | None = None) -> DataFrame:
    """(host, window_start, id, type, delta, value) of every report, as windows
    close (append mode). Rows without a host only move the watermark. Needs the
    RocksDB state store, which is chosen here where the session names none."""
    spark = samples.sparkSession
    if spark.conf.get(PROVIDER, None) in (None, "", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"):
        spark.conf.set(PROVIDER, ROCKSDB)
    fields = fields or [f for f in SAMPLE_FIELDS if f in samples.columns]
    host = samples.schema[key].dataType.simpleString()
    cpu = F.col(CPU_FIELD) if CPU_FIELD in samples.columns else F.lit(None)
    held = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in fields])
    s = samples.select(F.col(key), F.col(order_col).cast("bigint").alias("ord"), F.col(ts_col).cast("timestamp").alias("poll_time"),
                       held.alias("fields"), cpu.cast("array<double>").alias(CPU_FIELD)) \
        .withWatermark("poll_time", watermark).where(hosted(key, "poll_time")) \
        .where(F.col("poll_time").isNotNull()).withColumn("poll_ms", F.unix_millis("poll_time"))
    reports = s.groupBy(key).transformWithStateInPandas(
        Reports(fields, every_seconds * 1000, key),
        f"{key} {host}, window_start timestamp, polls bigint, fields array<double>, {CPU_FIELD} array<double>", "Append", "EventTime")
    return reports.select(key, "window_start", F.inline(report_items(
        fields, [F.col("fields")[i] for i in range(len(fields))], F.col("polls"), F.col(CPU_FIELD))))
