"""Admission rules: which updates are applied, which are rejected and why.

Two policies exist side by side, as in the reference service:

* batch policy (FLT-3): kinds compared case-sensitively; rows with an unknown
  kind or a missing value are skipped silently, the rest applied;
* single policy (FLT-2): the kind is lower-cased first; an unknown kind, a
  gauge without value or a counter without delta is rejected with a reason.

All rules are row-local Column expressions: no shuffle, filters push into
the scan where Catalyst can.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricfold.functions.scalars import (ColumnOrName, _c, is_valid_kind, normalize_kind,
                                          parse_counter, parse_gauge, sign_payload)
from metricfold.schemas import COUNTER, GAUGE

# Reject reasons (our own codes; one per rejection path of the reference).
UNKNOWN_TYPE = "unknown_type"
GAUGE_WITHOUT_VALUE = "gauge_without_value"
COUNTER_WITHOUT_DELTA = "counter_without_delta"
BAD_GAUGE_VALUE = "bad_gauge_value"
BAD_COUNTER_VALUE = "bad_counter_value"
BAD_PATH = "bad_path"
MALFORMED_JSON = "malformed_json"
EMPTY_BODY = "empty_body"


def update_reason(kind: ColumnOrName, delta: ColumnOrName, value: ColumnOrName) -> Column:
    """Reason a (kind, delta, value) update cannot apply, NULL if it can.
    ``kind`` is taken as given: pass ``normalize_kind(...)`` for FLT-2."""
    k = _c(kind)
    return (F.when(~is_valid_kind(k), F.lit(UNKNOWN_TYPE))
            .when((k == GAUGE) & _c(value).isNull(), F.lit(GAUGE_WITHOUT_VALUE))
            .when((k == COUNTER) & _c(delta).isNull(), F.lit(COUNTER_WITHOUT_DELTA)))


def applies(kind: ColumnOrName, delta: ColumnOrName, value: ColumnOrName) -> Column:
    """FLT-3 predicate: counter with delta or gauge with value (exact kind)."""
    k = _c(kind)
    return (((k == COUNTER) & _c(delta).isNotNull())
            | ((k == GAUGE) & _c(value).isNotNull()))


def admit_batch(updates: DataFrame, kind_col: str = "type") -> DataFrame:
    """FLT-3: keep only the rows the batch endpoint applies."""
    return updates.where(applies(kind_col, "delta", "value"))


def admit_single(updates: DataFrame, kind_col: str = "type") -> DataFrame:
    """FLT-2: lower-case the kind into ``mtype`` and attach ``reject_reason``
    (NULL = accepted). Use ``split_admitted`` to route the two outcomes."""
    mtype = normalize_kind(kind_col)
    return updates.withColumn("mtype", mtype) \
        .withColumn("reject_reason", update_reason("mtype", "delta", "value"))


def split_admitted(df: DataFrame, reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantine) by the reason column; both stay lazy."""
    return df.where(F.col(reason_col).isNull()), df.where(F.col(reason_col).isNotNull())


def path_reason(kind: ColumnOrName, delta: ColumnOrName, value: ColumnOrName) -> Column:
    """FLT-6: unknown kind (exact compare), unparsable gauge, unparsable counter."""
    k = _c(kind)
    return (F.when(~is_valid_kind(k), F.lit(UNKNOWN_TYPE))
            .when((k == GAUGE) & _c(value).isNull(), F.lit(BAD_GAUGE_VALUE))
            .when((k == COUNTER) & _c(delta).isNull(), F.lit(BAD_COUNTER_VALUE)))


def admit_path(parsed: DataFrame) -> DataFrame:
    """FLT-6 over tokenised paths (``parse_path_update`` output): parse the
    value text by kind and attach ``reject_reason``."""
    kind, raw = F.col("mtype"), F.col("raw_value")
    out = parsed.withColumn("delta", F.when(kind == COUNTER, parse_counter(raw))) \
        .withColumn("value", F.when(kind == GAUGE, parse_gauge(raw)))
    return out.withColumn(
        "reject_reason",
        F.coalesce(F.col("reject_reason"), path_reason("mtype", "delta", "value")))


def state_invariant(mtype: ColumnOrName = "mtype", delta: ColumnOrName = "delta",
                    value: ColumnOrName = "value") -> Column:
    """FLT-4: counter rows carry only delta, gauge rows only value."""
    m, d, v = _c(mtype), _c(delta), _c(value)
    return F.coalesce(((m == COUNTER) & d.isNotNull() & v.isNull())
                      | ((m == GAUGE) & d.isNull() & v.isNotNull()), F.lit(False))


def state_violations(state: DataFrame) -> DataFrame:
    """Rows of ``state`` breaking the invariant; must be empty."""
    return state.where(~state_invariant())


def check_state(state: DataFrame) -> DataFrame:
    """One-row summary of FLT-4: rows checked and rows violating."""
    return state.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.count_if(~state_invariant()).alias("n_violations"))


def chosen_signature(sig: ColumnOrName, alt_sig: ColumnOrName | None = None) -> Column:
    """The signature field, falling back to the alternate one when empty."""
    s = F.nullif(_c(sig), F.lit(""))
    return s if alt_sig is None else F.coalesce(s, F.nullif(_c(alt_sig), F.lit("")))


def signature_ok(payload: ColumnOrName, sig: ColumnOrName, key: str,
                 alt_sig: ColumnOrName | None = None) -> Column:
    """FLT-7: absent or literal 'none' passes; otherwise it must verify."""
    s = chosen_signature(sig, alt_sig)
    return s.isNull() | (s == "none") | F.coalesce(sign_payload(payload, key) == s, F.lit(False))


def filter_signed(df: DataFrame, key: str | None, payload_col: str = "payload",
                  sig_col: str = "sig", alt_sig_col: str | None = "alt_sig") -> DataFrame:
    """FLT-7 as a filter. With no key configured every row passes."""
    if key is None:
        return df
    alt = alt_sig_col if alt_sig_col and alt_sig_col in df.columns else None
    return df.where(signature_ok(payload_col, sig_col, key, alt))


def admission_stats(df: DataFrame, reason_col: str = "reject_reason",
                    by: list[str] | None = None) -> DataFrame:
    """AGG-9: rows per outcome ('accepted' or the reject reason)."""
    outcome = F.coalesce(F.col(reason_col), F.lit("accepted")).alias("outcome")
    keys = [F.col(c) for c in (by or [])] + [outcome]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def policy_stats(updates: DataFrame, kind_col: str = "type") -> DataFrame:
    """AGG-9 for both policies in one pass: each row yields its single-policy
    outcome and its batch-policy outcome (applied / skipped), then one
    aggregation counts (policy, outcome)."""
    single = F.coalesce(update_reason(normalize_kind(kind_col), "delta", "value"), F.lit("accepted"))
    batch = F.when(applies(kind_col, "delta", "value"), F.lit("accepted")).otherwise(F.lit("skipped"))
    tagged = updates.select(F.inline(F.array(
        F.struct(F.lit("single").alias("policy"), single.alias("outcome")),
        F.struct(F.lit("batch").alias("policy"), batch.alias("outcome")))))
    return tagged.groupBy("policy", "outcome").agg(F.count(F.lit(1)).alias("n"))
