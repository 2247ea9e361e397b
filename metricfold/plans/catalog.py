"""Registered queries: one per operator of the inventory, each paired with an
equivalent DuckDB SQL oracle over the same parquet tables.

Every query reads the given tables (or views Spark derives from them) in
full; nothing is sampled, capped or sub-set. Column names are aliased
identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from metricfold.session import tune
from metricfold.sources import fixtures as fx

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def _tuned(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def queries() -> dict[str, QueryFn]:
    """Registered queries; each applies the metricfold session defaults
    (only options the session leaves unset) before building its plan."""
    _load()
    return {name: _tuned(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    # Importing the query modules fills the registry.
    from metricfold.plans import q_fold, q_ingest, q_requests, q_samples, q_state  # noqa: F401


# Shared oracle fragments -----------------------------------------------------
def with_views(body: str, **views: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in views.items())
    return f"WITH {ctes}\n{body}" if ctes else body


UPDATES = fx.updates_sql()
CONFLICT_UPDATES = fx.updates_sql("untyped")

# FLT-3 batch policy + AGG-3 fold, as SQL.
FOLD_STATE_SQL = """
SELECT id, type AS mtype,
       CAST(sum(CASE WHEN type = 'counter' THEN delta END) AS BIGINT) AS delta,
       arg_max(CASE WHEN type = 'gauge' THEN value END, seq) AS value
FROM updates
WHERE (type = 'counter' AND delta IS NOT NULL) OR (type = 'gauge' AND value IS NOT NULL)
GROUP BY id, type"""
