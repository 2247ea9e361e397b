"""Keyed folds of updates into current state.

gauge  = last write wins (``max_by(value, order)``);
counter = sum of deltas (summed as decimal, so that only a total beyond int64
is an error, whatever the order of the rows: the table semantics of the reference).

Both are declarative, mergeable aggregates, so Spark runs them as
partial (map-side) + final hash aggregation: one shuffle on the key, and a
hot key -- even one holding a third of all rows -- is pre-reduced to one row
per map task before the shuffle. ``order_col`` must be unique per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricfold.functions.scalars import normalize_kind
from metricfold.operators.admission import admit_batch, applies
from metricfold.schemas import COUNTER, GAUGE


def checked_long(total):
    """A decimal sum as bigint; ANSI mode makes an overflow an error. Summing
    in decimals makes the result independent of the order of the rows."""
    return total.cast("bigint")


def _long_sum(delta):
    return F.sum(delta.cast("decimal(38,0)"))


def fold_gauges(updates: DataFrame, order_col: str = "seq") -> DataFrame:
    """AGG-1: last value per gauge id -> (id, value)."""
    g = updates.where((F.col("type") == GAUGE) & F.col("value").isNotNull())
    return g.groupBy("id").agg(F.max_by("value", order_col).alias("value"))


def fold_counters(updates: DataFrame) -> DataFrame:
    """AGG-2: sum of deltas per counter id -> (id, delta)."""
    c = updates.where((F.col("type") == COUNTER) & F.col("delta").isNotNull())
    return c.groupBy("id").agg(checked_long(_long_sum(F.col("delta"))).alias("delta"))


def fold_state(updates: DataFrame, order_col: str = "seq", kind_col: str = "type") -> DataFrame:
    """AGG-3 (flagship): batch policy, then one aggregation keyed (id, mtype)
    -> (id, mtype, delta, value). Counter rows keep only delta, gauge rows
    only value, so the state invariant holds by construction."""
    k = F.col(kind_col)
    rows = admit_batch(updates, kind_col).select(
        "id", k.alias("mtype"),
        F.when(k == COUNTER, F.col("delta")).alias("delta"),
        F.when(k == GAUGE, F.col("value")).alias("value"),
        F.col(order_col).alias("_ord"))
    return rows.groupBy("id", "mtype").agg(
        checked_long(_long_sum(F.col("delta"))).alias("delta"),
        F.max_by("value", "_ord").alias("value"))


def fold_kinds(updates: DataFrame, kind: Column, order_col: str = "seq") -> DataFrame:
    """One row per id over the rows whose ``kind`` applies: first (0 counter,
    1 gauge: the kind of the first row), total, last, counters, gauges. The
    code of the first kind is fixed-width, so this stays a hash aggregation."""
    rows = updates.select("id", kind.alias("_k"), "delta", "value", F.col(order_col).alias("_ord")) \
        .where(applies("_k", "delta", "value"))
    counter, gauge = F.col("_k") == COUNTER, F.col("_k") == GAUGE
    return rows.groupBy("id").agg(
        F.min_by(F.when(counter, F.lit(0)).otherwise(F.lit(1)), "_ord").alias("first"),
        checked_long(_long_sum(F.when(counter, F.col("delta")))).alias("total"),
        F.max_by("value", F.when(gauge, F.col("_ord"))).alias("last"),
        F.count_if(counter).alias("counters"), F.count_if(gauge).alias("gauges"))


def fold_state_strict(updates: DataFrame, order_col: str = "seq",
                      kind_col: str = "type") -> DataFrame:
    """AGG-4: table semantics, keyed by id alone, single-update policy.

    The first valid update of an id fixes its kind. Later gauges sent to a
    counter are rejected (``type_conflicts``); later counters sent to a gauge
    are accepted but change nothing (``ignored``). Everything is one
    aggregation per id -- no window, no join -- so hot ids stay map-side
    reduced:
    ``established = min_by(kind, order)`` (kind coded 0/1 so the buffer
    stays fixed-width); the counter sum and the last gauge are computed for
    both kinds and the established one is kept.
    """
    agg = fold_kinds(updates, normalize_kind(kind_col), order_col)
    is_counter = F.col("first") == 0
    return agg.select(
        "id", F.when(is_counter, F.lit(COUNTER)).otherwise(F.lit(GAUGE)).alias("mtype"),
        F.when(is_counter, F.col("total")).alias("delta"),
        F.when(~is_counter, F.col("last")).alias("value"),
        F.when(is_counter, F.col("gauges")).otherwise(F.lit(0)).alias("type_conflicts"),
        F.when(~is_counter, F.col("counters")).otherwise(F.lit(0)).alias("ignored"),
    )
