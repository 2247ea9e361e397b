"""Queries: admission rules and keyed folds (FLT-1..4, AGG-1..4, AGG-9)."""

from __future__ import annotations

from metricfold.functions.scalars import is_valid_kind
from metricfold.operators import admission as adm
from metricfold.operators import fold
from metricfold.plans.catalog import (CONFLICT_UPDATES, FOLD_STATE_SQL, UPDATES, register,
                                      with_views)
from metricfold.sources import fixtures as fx


@register("fold_state", with_views(FOLD_STATE_SQL, updates=UPDATES))
def q_fold_state(spark, sf_dir):
    """AGG-3: batch policy then (id, mtype) fold of the whole `updates` view."""
    return fold.fold_state(fx.updates(spark, sf_dir))


@register("gauge_last", with_views("""
SELECT id, arg_max(value, seq) AS value FROM updates
WHERE type = 'gauge' AND value IS NOT NULL GROUP BY id""", updates=UPDATES))
def q_gauge_last(spark, sf_dir):
    """AGG-1: last write wins per gauge id."""
    return fold.fold_gauges(fx.updates(spark, sf_dir))


@register("counter_sum", with_views("""
SELECT id, CAST(sum(delta) AS BIGINT) AS delta FROM li
WHERE type = 'counter' AND delta IS NOT NULL GROUP BY id""", li=fx.lineitem_counters_sql()))
def q_counter_sum(spark, sf_dir):
    """AGG-2: counter fold over one update per lineitem row (scale input)."""
    return fold.fold_counters(fx.lineitem_counters(spark, sf_dir))


_STRICT_SQL = """
SELECT id, mtype,
       CASE WHEN mtype = 'counter' THEN s END AS delta,
       CASE WHEN mtype = 'gauge' THEN g END AS value,
       CASE WHEN mtype = 'counter' THEN n_gauge ELSE 0 END AS type_conflicts,
       CASE WHEN mtype = 'gauge' THEN n_counter ELSE 0 END AS ignored
FROM (
  SELECT id, arg_min(k, seq) AS mtype,
         CAST(sum(CASE WHEN k = 'counter' THEN delta END) AS BIGINT) AS s,
         arg_max(value, CASE WHEN k = 'gauge' THEN seq END) AS g,
         count(*) FILTER (WHERE k = 'counter') AS n_counter,
         count(*) FILTER (WHERE k = 'gauge') AS n_gauge
  FROM (SELECT id, lower(type) AS k, delta, value, seq FROM updates) r
  WHERE (k = 'counter' AND delta IS NOT NULL) OR (k = 'gauge' AND value IS NOT NULL)
  GROUP BY id) a"""


@register("fold_state_strict", with_views(_STRICT_SQL, updates=CONFLICT_UPDATES))
def q_fold_state_strict(spark, sf_dir):
    """AGG-4: id-keyed fold where the first valid kind wins (conflict view)."""
    return fold.fold_state_strict(fx.conflict_updates(spark, sf_dir))


@register("valid_type", with_views("""
SELECT seq, type, coalesce(type IN ('gauge', 'counter'), false) AS is_valid
FROM updates""", updates=UPDATES))
def q_valid_type(spark, sf_dir):
    """FLT-1: kind predicate on every update."""
    u = fx.updates(spark, sf_dir)
    return u.select("seq", "type", is_valid_kind("type").alias("is_valid"))


@register("admit_batch", with_views("""
SELECT seq, id, type, delta, value FROM updates
WHERE (type = 'counter' AND delta IS NOT NULL) OR (type = 'gauge' AND value IS NOT NULL)""",
                                    updates=UPDATES))
def q_admit_batch(spark, sf_dir):
    """FLT-3: rows the batch endpoint applies (case-sensitive kinds)."""
    return adm.admit_batch(fx.updates(spark, sf_dir)).select("seq", "id", "type", "delta", "value")


_SINGLE_REASON = """
CASE WHEN lower(type) IS NULL OR lower(type) NOT IN ('gauge', 'counter') THEN 'unknown_type'
     WHEN lower(type) = 'gauge' AND value IS NULL THEN 'gauge_without_value'
     WHEN lower(type) = 'counter' AND delta IS NULL THEN 'counter_without_delta' END"""


@register("admit_single", with_views(f"""
SELECT seq, id, lower(type) AS mtype, delta, value, {_SINGLE_REASON} AS reject_reason
FROM updates""", updates=UPDATES))
def q_admit_single(spark, sf_dir):
    """FLT-2: lower-cased kind and a reject reason for every update."""
    return adm.admit_single(fx.updates(spark, sf_dir)) \
        .select("seq", "id", "mtype", "delta", "value", "reject_reason")


@register("admission_stats", with_views(f"""
SELECT 'single' AS policy, coalesce({_SINGLE_REASON}, 'accepted') AS outcome, count(*) AS n
FROM updates GROUP BY 2
UNION ALL
SELECT 'batch' AS policy,
       CASE WHEN (type = 'counter' AND delta IS NOT NULL) OR (type = 'gauge' AND value IS NOT NULL)
            THEN 'accepted' ELSE 'skipped' END AS outcome, count(*) AS n
FROM updates GROUP BY 2""", updates=UPDATES))
def q_admission_stats(spark, sf_dir):
    """AGG-9: per-policy accounting of applied / rejected / skipped rows."""
    return adm.policy_stats(fx.updates(spark, sf_dir))


@register("check_state", with_views("""
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE NOT coalesce((mtype = 'counter' AND delta IS NOT NULL AND value IS NULL)
                                 OR (mtype = 'gauge' AND delta IS NULL AND value IS NOT NULL), false))
         AS n_violations
FROM state""", updates=UPDATES, state=FOLD_STATE_SQL))
def q_check_state(spark, sf_dir):
    """FLT-4: invariant check over the folded state (violations must be 0)."""
    return adm.check_state(fold.fold_state(fx.updates(spark, sf_dir)))
