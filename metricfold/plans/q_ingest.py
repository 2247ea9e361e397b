"""Queries: update sources, parsing, signatures (SRC-1..3, SCL-2/3/6/7,
FLT-6/7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from metricfold.functions.scalars import parse_counter, parse_gauge, sign_payload, verify_signature
from metricfold.operators import admission as adm
from metricfold.plans.catalog import register, with_views
from metricfold.sources import fixtures as fx
from metricfold.sources import updates as src

# SQL spelling of the strict numeric-text rules (same regexes as Spark side).
_INT_RE = r"^[+-]?[0-9]+$"
_DEC_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_COUNTER_SQL = f"CASE WHEN regexp_matches({{x}}, '{_INT_RE}') THEN TRY_CAST({{x}} AS BIGINT) END"
_GAUGE_SQL = (f"CASE WHEN regexp_matches({{x}}, '^[+-]?(inf|infinity)$', 'i') "
              f"THEN CASE WHEN starts_with({{x}}, '-') THEN -'inf'::DOUBLE ELSE 'inf'::DOUBLE END "
              f"WHEN regexp_matches({{x}}, '^nan$', 'i') THEN 'nan'::DOUBLE "
              f"WHEN regexp_matches({{x}}, '{_DEC_RE}') AND NOT isinf(TRY_CAST({{x}} AS DOUBLE)) "
              f"THEN TRY_CAST({{x}} AS DOUBLE) END")

_TOKENS_SQL = f"""
SELECT seq, path,
  CASE WHEN ok THEN p[3] END AS mtype, CASE WHEN ok THEN p[4] END AS id,
  CASE WHEN ok THEN p[5] END AS raw_value, CASE WHEN NOT ok THEN 'bad_path' END AS reject_reason
FROM (SELECT seq, path, p,
        len(p) = 5 AND p[1] = '' AND p[2] = 'update' AND p[3] <> '' AND p[4] <> '' AS ok
      FROM (SELECT seq, path, string_split(path, '/') AS p FROM ({fx.paths_sql()}) x) a) b"""


@register("parse_path_update", _TOKENS_SQL)
def q_parse_path_update(spark, sf_dir):
    """SRC-3: tokenise `/update/{type}/{name}/{value}` texts."""
    return src.parse_path_update(fx.paths(spark, sf_dir))


@register("admit_path", f"""
SELECT seq, path, mtype, id, raw_value, delta, value,
  coalesce(reject_reason,
    CASE WHEN mtype IS NULL OR mtype NOT IN ('gauge', 'counter') THEN 'unknown_type'
         WHEN mtype = 'gauge' AND value IS NULL THEN 'bad_gauge_value'
         WHEN mtype = 'counter' AND delta IS NULL THEN 'bad_counter_value' END) AS reject_reason
FROM (SELECT *, CASE WHEN mtype = 'counter' THEN {_COUNTER_SQL.format(x='raw_value')} END AS delta,
             CASE WHEN mtype = 'gauge' THEN {_GAUGE_SQL.format(x='raw_value')} END AS value
      FROM ({_TOKENS_SQL}) t) v""")
def q_admit_path(spark, sf_dir):
    """FLT-6 + SCL-2/3: typed parse of the path value and its reject reason."""
    return adm.admit_path(src.parse_path_update(fx.paths(spark, sf_dir)))


@register("parse_counter", f"""
SELECT seq, raw_value, {_COUNTER_SQL.format(x='raw_value')} AS delta FROM ({_TOKENS_SQL}) t""")
def q_parse_counter(spark, sf_dir):
    """SCL-2: strict int64 parse of every path value text (decimals and
    'invalid' give NULL)."""
    t = src.parse_path_update(fx.paths(spark, sf_dir))
    return t.select("seq", "raw_value", parse_counter("raw_value").alias("delta"))


@register("parse_gauge", f"""
SELECT seq, raw_value, {_GAUGE_SQL.format(x='raw_value')} AS value FROM ({_TOKENS_SQL}) t""")
def q_parse_gauge(spark, sf_dir):
    """SCL-3: strict float64 parse of every path value text."""
    t = src.parse_path_update(fx.paths(spark, sf_dir))
    return t.select("seq", "raw_value", parse_gauge("raw_value").alias("value"))


@register("sign_payload", f"""
SELECT event_id AS seq, sha256('{fx.TEST_KEY}' || props) AS hash FROM events""")
def q_sign_payload(spark, sf_dir):
    """SCL-6: SHA-256(key ++ payload) of every event payload."""
    e = fx.table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("seq"), sign_payload("props", fx.TEST_KEY).alias("hash"))


@register("verify_payload", with_views(f"""
SELECT seq, coalesce(sha256('{fx.TEST_KEY}' || payload) = sig, false) AS verified FROM signed""",
                                       signed=fx.signed_sql()))
def q_verify_payload(spark, sf_dir):
    """SCL-7: exact hex comparison of the given signature."""
    s = fx.signed(spark, sf_dir)
    return s.select("seq", verify_signature("payload", "sig", fx.TEST_KEY).alias("verified"))


@register("filter_signed", with_views(f"""
SELECT seq, payload FROM (
  SELECT seq, payload, coalesce(nullif(sig, ''), nullif(alt_sig, '')) AS s FROM signed) x
WHERE s IS NULL OR s = 'none' OR coalesce(sha256('{fx.TEST_KEY}' || payload) = s, false)""",
                                      signed=fx.signed_sql()))
def q_filter_signed(spark, sf_dir):
    """FLT-7: drop payloads whose (fallback) signature does not verify."""
    return adm.filter_signed(fx.signed(spark, sf_dir), fx.TEST_KEY).select("seq", "payload")


def _elem_ok_sql(e: str) -> str:
    def t(f):
        return f"json_type({e}, '$.{f}')"
    return f"""(json_type({e}) = 'NULL' OR (json_type({e}) = 'OBJECT'
       AND coalesce({t('id')}, 'NULL') IN ('VARCHAR', 'NULL')
       AND coalesce({t('type')}, 'NULL') IN ('VARCHAR', 'NULL')
       AND coalesce({t('hash')}, 'NULL') IN ('VARCHAR', 'NULL')
       AND (coalesce({t('delta')}, 'NULL') IN ('BIGINT', 'NULL')
            OR ({t('delta')} = 'UBIGINT'
                AND TRY_CAST(json_extract_string({e}, '$.delta') AS BIGINT) IS NOT NULL))
       AND coalesce({t('value')}, 'NULL') IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'NULL')
       AND coalesce(NOT isinf(TRY_CAST(json_extract_string({e}, '$.value') AS DOUBLE)), true)))"""


_SINGLE_SQL = f"""
SELECT seq, payload, id, delta, value, lower(type) AS mtype,
  CASE WHEN coalesce(length(payload), 0) = 0 THEN 'empty_body'
       WHEN NOT ok THEN 'malformed_json'
       WHEN lower(type) IS NULL OR lower(type) NOT IN ('gauge', 'counter') THEN 'unknown_type'
       WHEN lower(type) = 'gauge' AND value IS NULL THEN 'gauge_without_value'
       WHEN lower(type) = 'counter' AND delta IS NULL THEN 'counter_without_delta' END
    AS reject_reason
FROM (SELECT seq, payload, ok,
        CASE WHEN ok THEN coalesce(json_extract_string(pj, '$.id'), '') END AS id,
        CASE WHEN ok THEN coalesce(json_extract_string(pj, '$.type'), '') END AS type,
        CASE WHEN ok THEN TRY_CAST(json_extract_string(pj, '$.delta') AS BIGINT) END AS delta,
        CASE WHEN ok THEN TRY_CAST(json_extract_string(pj, '$.value') AS DOUBLE) END AS value
      FROM (SELECT seq, payload, pj,
              coalesce(json_type(pj) = 'OBJECT' AND {_elem_ok_sql('pj')}, false) AS ok
            FROM (SELECT seq, payload, CASE WHEN json_valid(payload) THEN payload END AS pj
                  FROM ({fx.json_payloads_sql()}) p0) p) q) r"""


@register("parse_json_update", _SINGLE_SQL)
def q_parse_json_update(spark, sf_dir):
    """SRC-2 + FLT-2: single JSON updates decoded, typed and admitted."""
    return src.parse_json_update(fx.json_payloads(spark, sf_dir))


_BATCH_VERDICT_SQL = f"""
SELECT batch_id,
  ok AS accepted,
  CASE WHEN ok THEN CAST(n AS BIGINT) ELSE NULL END AS n_elements_ok,
  CASE WHEN NOT ok THEN 'malformed_json' END AS reject_reason
FROM (
  SELECT batch_id,
    coalesce(json_type(pj) = 'ARRAY'
      AND coalesce(list_bool_and(list_transform(json_extract(pj, '$[*]'), lambda e: {_elem_ok_sql('e')})),
                   true), false) AS ok,
    json_array_length(pj) AS n
  FROM (SELECT batch_id, CASE WHEN json_valid(payload) THEN payload END AS pj
        FROM ({fx.batch_payloads_sql()}) b0) b) v"""


@register("batch_verdicts", _BATCH_VERDICT_SQL)
def q_batch_verdicts(spark, sf_dir):
    """SRC-1: whole-payload verdict for every batch payload (one ill-typed
    element or a non-JSON text rejects the whole batch)."""
    v = src.payload_verdicts(fx.batch_payloads(spark, sf_dir))
    return v.select("batch_id", "accepted",
                    F.when(F.col("accepted"), F.col("n_elements")).alias("n_elements_ok"),
                    "reject_reason")


_READ_BATCH_SQL = f"""
SELECT batch_id, CAST(pos AS INTEGER) AS pos,
       coalesce(json_extract_string(e, '$.id'), '') AS id,
       coalesce(json_extract_string(e, '$.type'), '') AS type,
       TRY_CAST(json_extract_string(e, '$.delta') AS BIGINT) AS delta,
       TRY_CAST(json_extract_string(e, '$.value') AS DOUBLE) AS value
FROM (SELECT batch_id, pos, json_extract(payload, '$[' || pos || ']') AS e
      FROM (SELECT b.batch_id, b.payload, unnest(range(CAST(json_array_length(b.payload) AS BIGINT))) AS pos
            FROM ({fx.batch_payloads_sql()}) b
            JOIN ({_BATCH_VERDICT_SQL}) v ON v.batch_id = b.batch_id AND v.accepted) x) y"""


@register("read_update_batch", _READ_BATCH_SQL)
def q_read_update_batch(spark, sf_dir):
    """SRC-1: update rows of the accepted batch payloads, in array order."""
    ups = src.payload_updates(fx.batch_payloads(spark, sf_dir), keep=["batch_id"])
    return ups.select("batch_id", "pos", "id", "type", "delta", "value")


@register("read_update_batch_gz", _READ_BATCH_SQL)
def q_read_update_batch_gz(spark, sf_dir):
    """SRC-7 + SRC-1 on files: each batch payload is written as its own gzip
    text file (one folder per batch), then read back with
    ``read_update_batch`` (the reader's codec decodes .gz; a file is one
    payload). Batch ids come from the folder names."""
    import uuid

    from metricfold.session import checkpoint_root
    root = f"{checkpoint_root(spark)}/payload-files-{uuid.uuid4().hex}"
    fx.batch_payloads(spark, sf_dir).select("batch_id", F.col("payload").alias("value")) \
        .write.option("compression", "gzip").partitionBy("batch_id").text(root)
    ups, _ = src.read_update_batch(spark, root)
    bid = F.regexp_extract("batch", r"batch_id=([0-9]+)", 1).cast("bigint")
    return ups.select(bid.alias("batch_id"), "pos", "id", "type", "delta", "value")


@register("ingest_flow", f"""
SELECT id, type AS mtype, CAST(sum(CASE WHEN type = 'counter' THEN delta END) AS BIGINT) AS delta,
       arg_max(CASE WHEN type = 'gauge' THEN value END, batch_id * 100000 + pos) AS value
FROM ({_READ_BATCH_SQL}) r
WHERE (type = 'counter' AND delta IS NOT NULL) OR (type = 'gauge' AND value IS NOT NULL)
GROUP BY id, type""")
def q_ingest_flow(spark, sf_dir):
    """Flow A: the batch payloads, dealt over files of any order, go through
    verdicts, batch policy, fold and state commit; later bodies win by their
    order column. Each accepted body, empty ones too, is one audit event."""
    import uuid

    from metricfold.plans.flows import ingest_payloads
    from metricfold.session import checkpoint_root
    from metricfold.sinks import events as ev
    from metricfold.sinks import state_table as tbl
    tag = uuid.uuid4().hex
    base = checkpoint_root(spark)
    land, root, audit = (f"{base}/{n}-{tag}" for n in ("flow-in", "flow-state", "flow-audit"))
    fx.batch_payloads(spark, sf_dir).repartition(3, F.xxhash64("payload")).write.parquet(land)
    done = ingest_payloads(spark, spark.read.parquet(land), root, 0, order_col="batch_id",
                           audit_sinks={"file": lambda df: ev.write_audit(df, audit)})
    events = spark.read.text(audit).count()
    if done["audit"] != {"file": None} or events != done["accepted"]:
        raise RuntimeError(f"{events} audit events: {done}")
    return tbl.read_state(spark, root)
