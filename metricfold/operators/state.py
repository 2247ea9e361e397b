"""Operations on folded state: upsert, lookups, listings.

State is a DataFrame (id, mtype, delta, value) with one row per (id, mtype).
Joins are equi-joins. With the metricfold session defaults nothing is
broadcast from plan estimates; AQE broadcasts a side only when its measured
shuffle output is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``. The
keys that many requests ask for are counted first (HOT_KEYS at most, so that
list is small by construction); their requests are dealt over SPREAD tasks and
only their state rows are replicated. Nothing relies on AQE to split them, which
it cannot do where the state is an aggregate whose partitioning the join reuses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricfold.functions.scalars import (is_valid_kind, listing_line, normalize_kind,
                                          value_text)
from metricfold.operators.fold import fold_counters, fold_gauges, fold_kinds, fold_state
from metricfold.schemas import COUNTER, GAUGE


def upsert_state(state: DataFrame, batch: DataFrame, order_col: str = "seq") -> DataFrame:
    """JOIN-1: apply one update batch to stored state.

    The batch is folded first (one row per key, partial aggregation), then
    full-outer joined with the state on (id, mtype): counters add, gauges
    take the batch value. Both join sides are unique per key, so the join has
    no skew even when one id dominates the batch. Splitting updates into
    state + batch gives the same result as one fold over all of them.
    """
    return upsert_folded(state, fold_state(batch, order_col))


def upsert_folded(state: DataFrame, folded: DataFrame) -> DataFrame:
    """JOIN-1 with a batch that is folded already (one row per key)."""
    b = folded.select("id", "mtype", F.col("delta").alias("_bd"), F.col("value").alias("_bv"))
    s = state.select("id", "mtype", F.col("delta").alias("_sd"), F.col("value").alias("_sv"))
    j = s.join(b, ["id", "mtype"], "full_outer")
    delta = (F.when(F.col("mtype") != COUNTER, F.lit(None).cast("bigint"))
             .when(F.col("_sd").isNull(), F.col("_bd"))
             .when(F.col("_bd").isNull(), F.col("_sd"))
             .otherwise(F.col("_sd") + F.col("_bd")))
    value = F.when(F.col("mtype") == GAUGE, F.coalesce(F.col("_bv"), F.col("_sv")))
    return j.select("id", "mtype", delta.alias("delta"), value.alias("value"))


def strict_batch_plan(state: DataFrame, batch: DataFrame, order_col: str = "seq",
                      kind_col: str = "type") -> DataFrame:
    """AGG-4b, table semantics for one batch, one row per id: id, mtype, delta,
    value to apply, and ``conflicts``, the gauges sent to a counter (any
    rolls the whole batch back). The batch policy holds: kinds are compared
    as written, and rows of unknown kind or without a value are skipped.

    An id's kind is the stored one, else that of its first row in the batch; a
    counter sent to a gauge changes nothing. The batch is folded once per id
    and only the folded rows meet the state.
    """
    b = fold_kinds(batch, F.col(kind_col), order_col)
    # Table semantics: the stored state holds one row per id.
    stored = state.select("id", F.col("mtype").alias("_stored"))
    first = F.when(F.col("first") == 0, F.lit(COUNTER)).otherwise(F.lit(GAUGE))
    j = b.join(stored, "id", "left").withColumn("mtype", F.coalesce("_stored", first))
    counter = F.col("mtype") == COUNTER
    return j.select(
        "id", "mtype", F.when(counter, F.col("total")).alias("delta"), F.when(~counter, F.col("last")).alias("value"),
        F.when(counter, F.col("gauges")).otherwise(F.lit(0)).alias("conflicts"),
        (F.when(counter, F.col("counters")).otherwise(F.col("gauges")) > 0).alias("effective"))


def _requests(requests: DataFrame, kind_col: str, lower: bool) -> DataFrame:
    kind = normalize_kind(kind_col) if lower else F.col(kind_col)
    return requests.withColumn("_kind", kind).where(is_valid_kind("_kind"))


def _state_side(state: DataFrame) -> DataFrame:
    return state.select("id", F.col("mtype").alias("_kind"),
                        F.col("delta").alias("_sd"), F.col("value").alias("_sv"))


HOT_KEYS = 64  # keys with the most requests that may be spread
HOT_REQUESTS = 10_000  # requests from which a key counts as hot
SPREAD = 32  # tasks for a hot key's requests


def _spread(req: DataFrame, side: DataFrame, spread: int, hot_requests: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with ``_salt``: hot requests get one of ``spread`` numbers by
    their place in the input, hot state rows are there once for each."""
    keys = ["id", "_kind"]
    hot = F.broadcast(req.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= hot_requests)
                      .orderBy(F.desc("_n"), *keys).limit(HOT_KEYS).select(*keys, F.lit(True).alias("_hot")))
    deal = F.pmod(F.monotonically_increasing_id(), F.lit(spread)).cast("int")
    every = F.sequence(F.lit(0), F.lit(spread - 1))
    req = req.withColumn("_deal", deal).join(hot, keys, "left") \
        .withColumn("_salt", F.when(F.col("_hot"), F.col("_deal")).otherwise(0)).drop("_hot", "_deal")
    side = side.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))).drop("_hot")
    return req, side, [*keys, "_salt"]


def lookup(requests: DataFrame, state: DataFrame, kind_col: str = "type",
           lower: bool = True, spread: int = SPREAD, hot_requests: int = HOT_REQUESTS) -> DataFrame:
    """JOIN-2 + PRJ-4: answer many lookups at once.

    Requests with an invalid kind are dropped (see ``lookup_rejected``); the
    JSON endpoint lower-cases the kind (``lower=True``), the path endpoint
    does not. Hits echo id and kind exactly as requested and carry the delta
    (counter) or value (gauge). Hot keys are spread (see the module text).
    """
    req, side, keys = _spread(_requests(requests, kind_col, lower), _state_side(state), spread, hot_requests)
    hit = req.join(side, keys, "inner")
    return hit.select(
        *[c for c in requests.columns],
        F.when(F.col("_kind") == COUNTER, F.col("_sd")).alias("delta_found"),
        F.when(F.col("_kind") == GAUGE, F.col("_sv")).alias("value_found"),
    )


def lookup_text(requests: DataFrame, state: DataFrame, kind_col: str = "type",
                lower: bool = False) -> DataFrame:
    """PRJ-4 + SCL-4, path form: each hit answered with its value text
    (counter as integer, gauge as shortest float text)."""
    hits = lookup(requests, state, kind_col, lower)
    kind = normalize_kind(kind_col) if lower else F.col(kind_col)
    return hits.select(*requests.columns,
                       value_text(kind, "delta_found", "value_found").alias("text"))


def lookup_missing(requests: DataFrame, state: DataFrame, kind_col: str = "type",
                   lower: bool = True, spread: int = SPREAD, hot_requests: int = HOT_REQUESTS) -> DataFrame:
    """JOIN-3: valid requests with no state row ("not found"); hot keys are
    spread as in ``lookup``."""
    req, side, keys = _spread(_requests(requests, kind_col, lower),
                              _state_side(state).select("id", "_kind"), spread, hot_requests)
    return req.join(side, keys, "left_anti").select(*requests.columns)


def lookup_rejected(requests: DataFrame, kind_col: str = "type", lower: bool = True) -> DataFrame:
    """Requests refused before the lookup (unknown kind)."""
    kind = normalize_kind(kind_col) if lower else F.col(kind_col)
    return requests.where(~is_valid_kind(kind))


def lookup_point(state: DataFrame, id_: str | None = None, mtype: str | None = None,
                 points: list[tuple[str, str]] | None = None) -> DataFrame:
    """FLT-5: ``id = ? AND mtype = ?`` (one point, or several as one OR
    filter over a single scan). On a stored state table the predicates reach
    the Parquet scan and ``mtype`` prunes partitions."""
    pts = list(points or []) + ([(id_, mtype)] if id_ is not None else [])
    cond = None
    for i, k in pts:
        c = (F.col("id") == i) & (F.col("mtype") == k)
        cond = c if cond is None else cond | c
    return state.where(cond if cond is not None else F.lit(False))


def union_kinds(updates: DataFrame, order_col: str = "seq") -> DataFrame:
    """SET-1: counters and gauges folded separately (the two maps of the
    in-memory store), then concatenated into one listing."""
    c = fold_counters(updates).select("id", F.lit(COUNTER).alias("mtype"), "delta",
                                      F.lit(None).cast("double").alias("value"))
    g = fold_gauges(updates, order_col).select("id", F.lit(GAUGE).alias("mtype"),
                                               F.lit(None).cast("bigint").alias("delta"), "value")
    return c.unionByName(g)


def list_lines(state: DataFrame, decimals: int = 6) -> DataFrame:
    """SCL-11: one ``id = value`` line per metric (6 decimals: memory
    listing; 2: table listing). Stays one row per metric -- no single
    giant string is assembled."""
    return state.select("id", "mtype",
                        listing_line("id", "mtype", "delta", "value", decimals).alias("line"))


def value_texts(state: DataFrame) -> DataFrame:
    """SCL-4: the text a value lookup returns for each metric."""
    return state.select("id", "mtype", value_text("mtype", "delta", "value").alias("text"))


def is_empty(state: DataFrame) -> bool:
    """AGG-8: the listing of an empty store is an error in the reference; we
    expose the test (one-row probe, no full count)."""
    return state.isEmpty()


def listing_status(state: DataFrame) -> DataFrame:
    """AGG-8 as a report row: number of metrics and whether the listing is
    empty (the reference answers an empty listing with an error)."""
    return state.agg(F.count(F.lit(1)).alias("n_metrics")) \
        .withColumn("is_empty", F.col("n_metrics") == 0)
