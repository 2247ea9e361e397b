"""Stand-in inputs built from the read-only test tables (FIXTURES.md).

Each view only reshapes rows of a test table into the schema an operator
expects (updates, paths, wide samples, signed payloads, JSON payloads); it
does none of an operator's work. Every view is written once as a list of SQL
expressions and rendered for two dialects: Spark (``selectExpr``) and DuckDB
(the oracle), so both sides always see the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metricfold.schemas import CPU_FIELD, SAMPLE_FIELDS

# Key used by the reference's known-answer signature tests (fixed value).
TEST_KEY = "test_key"

_DIALECT = {
    "spark": {"k": "get_json_object(props, '$.k')", "div": "{a} div {b}"},
    "duckdb": {"k": "(props->>'k')", "div": "({a} // {b})"},
}


def _div(dialect: str, a: str, b: int) -> str:
    return _DIALECT[dialect]["div"].format(a=a, b=b)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------- updates -----
def _update_exprs(dialect: str, id_expr: str) -> list[str]:
    k = _DIALECT[dialect]["k"]
    return [
        "event_id AS seq",
        "ts",
        f"{id_expr} AS id",
        """CASE event_type WHEN 'click' THEN 'counter'
             WHEN 'view' THEN CASE WHEN event_id % 3 = 0 THEN 'Counter' ELSE 'counter' END
             WHEN 'purchase' THEN 'gauge'
             WHEN 'error' THEN CASE WHEN event_id % 5 = 0 THEN 'GAUGE' ELSE 'gauge' END
             ELSE 'histogram' END AS type""",
        f"""CASE WHEN event_type IN ('click', 'view') AND event_id % 11 <> 0
             THEN CAST({k} AS BIGINT) END AS delta""",
        """CASE WHEN event_type IN ('purchase', 'error') AND event_id % 13 <> 0
             THEN value END AS value""",
        "CAST(NULL AS STRING) AS hash",
        f"{_div(dialect, 'event_id', 500)} AS batch_id",
        f"'10.0.' || CAST({_div(dialect, 'event_id', 500)} % 250 AS STRING) || '.7' AS ip_address",
    ]


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`updates`: valid rows, mixed-case kinds, unknown kind, missing values."""
    return table(spark, sf_dir, "events").selectExpr(
        *_update_exprs("spark", "concat(event_type, '.u', CAST(user_id AS STRING))"))


def conflict_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`conflict_updates`: as `updates`, but one id receives both kinds."""
    return table(spark, sf_dir, "events").selectExpr(
        *_update_exprs("spark", "concat('u', CAST(user_id AS STRING))"))


def updates_sql(id_kind: str = "typed") -> str:
    id_expr = ("event_type || '.u' || CAST(user_id AS STRING)" if id_kind == "typed"
               else "'u' || CAST(user_id AS STRING)")
    return "SELECT " + ",\n  ".join(_update_exprs("duckdb", id_expr)) + "\nFROM events"


def lineitem_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale input for the counter fold: one counter update per lineitem."""
    return table(spark, sf_dir, "lineitem").selectExpr(*_lineitem_exprs())


def _lineitem_exprs() -> list[str]:
    return ["'p' || CAST(l_partkey AS STRING) AS id", "'counter' AS type",
            "CAST(l_quantity AS BIGINT) AS delta", "CAST(NULL AS DOUBLE) AS value"]


def lineitem_counters_sql() -> str:
    return "SELECT " + ", ".join(_lineitem_exprs()) + " FROM lineitem"


# --------------------------------------------------------------- paths -----
_PATH_FROM_UPDATES = [
    "seq",
    """'/update/' || type || '/' || id || '/' ||
       CASE WHEN seq % 17 = 0 THEN 'invalid'
            WHEN delta IS NOT NULL THEN CAST(delta AS STRING)
            ELSE coalesce(CAST(value AS STRING), '') END AS path""",
]


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`paths`: one `/update/{type}/{name}/{value}` text per update; an update
    without a value has an empty last part."""
    return updates(spark, sf_dir).selectExpr(*_PATH_FROM_UPDATES)


def paths_sql() -> str:
    return f"SELECT {', '.join(_PATH_FROM_UPDATES)} FROM ({updates_sql()}) u"


# ---------------------------------------------------------------- wide -----
_BY_TYPE = {"Alloc": "click", "Sys": "view", "TotalAlloc": "signup", "FreeMemory": "purchase"}
WIDE_FIELDS = SAMPLE_FIELDS
_CPU = {"spark": "slice(array(value, value / 2.0D), 1, CAST(event_id % 3 AS INT))",
        "duckdb": "list_slice([value, value / 2.0::DOUBLE], 1, event_id % 3)"}


def _wide_exprs(dialect: str) -> list[str]:
    fields = [f"CASE event_type WHEN '{_BY_TYPE[f]}' THEN value ELSE 0 END AS {f}" if f in _BY_TYPE
              else f"CASE WHEN (event_id * 7 + {j}) % 4 = 0 THEN value + {j} ELSE 0 END AS {f}"
              for j, f in enumerate(SAMPLE_FIELDS)]
    return ["user_id AS host", "event_id AS ord", "ts", *fields, f"{_CPU[dialect]} AS {CPU_FIELD}"]


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`wide`: host samples with all fields and a list of 0 to 2 cores."""
    return table(spark, sf_dir, "events").selectExpr(*_wide_exprs("spark"))


def wide_sql() -> str:
    return "SELECT " + ", ".join(_wide_exprs("duckdb")) + " FROM events"


# -------------------------------------------------------------- signed -----
def _signed_exprs(dialect: str) -> list[str]:
    sha = ("sha2(concat('{k}', props), 256)" if dialect == "spark"
           else "sha256('{k}' || props)").format(k=TEST_KEY)
    return [
        "event_id AS seq", "props AS payload",
        f"""CASE event_id % 4 WHEN 0 THEN {sha} WHEN 1 THEN repeat('a', 64)
             WHEN 2 THEN 'none' END AS sig""",
        f"CASE WHEN event_id % 8 = 3 THEN {sha} END AS alt_sig",
    ]


def signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`signed`: right, wrong, absent, 'none' and fallback signatures."""
    return table(spark, sf_dir, "events").selectExpr(*_signed_exprs("spark"))


def signed_sql() -> str:
    return "SELECT " + ", ".join(_signed_exprs("duckdb")) + " FROM events"


# ------------------------------------------------------- JSON payloads -----
# One JSON object per update; some payloads are made malformed so that every
# rejection path of the single-update endpoint is exercised.
_PAYLOAD = [
    "seq",
    """CASE WHEN seq % 31 = 0 THEN ''
            WHEN seq % 19 = 0 THEN '{"id": "' || id || '", "type": '
            WHEN seq % 23 = 0 THEN '{"id": "' || id || '", "type": "counter", "delta": "5"}'
            WHEN seq % 29 = 0 THEN '{"id": "' || id || '", "type": "counter", "delta": 1.5}'
            WHEN seq % 37 = 0 THEN '[{"id": "' || id || '"}]'
            WHEN seq % 41 = 0 THEN '{"id": "' || id || '", "type": "gauge", "value": -1e999}'
            ELSE '{"id": "' || id || '", "type": "' || type || '"'
                 || CASE WHEN delta IS NULL THEN '' ELSE ', "delta": ' || CAST(delta AS STRING) END
                 || CASE WHEN value IS NULL THEN '' ELSE ', "value": ' || CAST(value AS STRING) END
                 || ', "note": "x"}' END AS payload""",
]


def json_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One single-update JSON text per update (SRC-2 input)."""
    return updates(spark, sf_dir).selectExpr(*_PAYLOAD)


def json_payloads_sql() -> str:
    return f"SELECT {', '.join(_PAYLOAD)} FROM ({updates_sql()}) u"


# Batch payloads: the elements of each batch_id joined into one JSON array.
# A few batches get one bad element (a fractional delta, a numeric id, a
# string delta, an out-of-range delta) or are not JSON at all.
_ELEMENT = """'{"id": "' || id || '", "type": "' || type || '"'
     || CASE WHEN delta IS NULL THEN ''
             WHEN batch_id % 7 = 3 AND seq % 500 = 250 THEN ', "delta": 1.5'
             WHEN batch_id % 7 = 5 AND seq % 500 = 250 THEN ', "delta": "5"'
             WHEN batch_id % 9 = 4 AND seq % 500 = 250 THEN ', "delta": 9223372036854775808'
             ELSE ', "delta": ' || CAST(delta AS STRING) END
     || CASE WHEN batch_id % 13 = 8 AND seq % 500 = 251 THEN ', "value": 1e400'
             WHEN value IS NULL THEN '' ELSE ', "value": ' || CAST(value AS STRING) END
     || '}'"""
_ELEMENT_ID5 = """CASE WHEN batch_id % 7 = 6 AND seq % 500 = 100
                  THEN '{"id": 5, "type": "gauge", "value": 1}' ELSE {el} END"""


def _element_expr() -> str:
    return _ELEMENT_ID5.replace("{el}", _ELEMENT)


def batch_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON-array payload per batch_id of `updates` (SRC-1 input).

    Built by the fixture only: each batch holds at most 500 updates by the
    `batch_id` rule, so the per-batch text stays small.
    """
    from pyspark.sql import functions as F
    el = updates(spark, sf_dir).selectExpr("batch_id", "seq", f"{_element_expr()} AS el")
    arr = el.groupBy("batch_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "el"))),
                                 lambda x: x["el"]), ", ").alias("body"))
    return arr.selectExpr(
        "batch_id",
        "CASE WHEN batch_id % 11 = 4 THEN 'not json' WHEN batch_id % 11 = 9 THEN '[]' "
        "ELSE '[' || body || ']' END AS payload")


def batch_payloads_sql() -> str:
    return f"""SELECT batch_id,
      CASE WHEN batch_id % 11 = 4 THEN 'not json' WHEN batch_id % 11 = 9 THEN '[]'
           ELSE '[' || string_agg(el, ', ' ORDER BY seq) || ']' END AS payload
    FROM (SELECT batch_id, seq, {_element_expr()} AS el FROM ({updates_sql()}) u) e
    GROUP BY batch_id"""


def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch payloads as requests: ``arrival`` (the batch id), ``payload``,
    ``ts`` and ``ip_address``."""
    from pyspark.sql import functions as F
    sent = updates(spark, sf_dir).groupBy("batch_id").agg(F.max("ts").alias("ts"), F.min("ip_address").alias("ip_address"))
    return batch_payloads(spark, sf_dir).join(sent, "batch_id") \
        .select(F.col("batch_id").alias("arrival"), "payload", "ts", "ip_address")


def request_bodies_sql() -> str:
    return f"""SELECT p.batch_id, p.payload, s.ts, s.ip_address FROM ({batch_payloads_sql()}) p
    JOIN (SELECT batch_id, max(ts) AS ts, min(ip_address) AS ip_address FROM ({updates_sql()}) u GROUP BY batch_id) s
      ON s.batch_id = p.batch_id"""


# ---------------------------------------------------------- CPU arrays -----
def cpu_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-core utilisation arrays: the `embeddings` vectors as samples."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id AS host", "transform(embedding, x -> CAST(x AS DOUBLE)) AS CPUutilization")
