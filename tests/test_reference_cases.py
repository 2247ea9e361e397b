"""Literal cases pinned by the reference's own tests (FIXTURES.md table)."""

from pyspark.sql import functions as F

from metricfold.functions.scalars import (is_valid_kind, parse_counter, parse_gauge,
                                          sign_payload, verify_signature)
from metricfold.operators import admission as adm
from metricfold.operators import fold
from metricfold.operators import state as st
from metricfold.sources import updates as src

UPD = "seq long, id string, type string, delta long, value double"


def _state(spark, rows):
    return fold.fold_state(spark.createDataFrame(rows, UPD))


def test_gauge_set_and_counter_adds(spark):
    s = _state(spark, [(1, "test_gauge", "gauge", None, 42.5),
                       (2, "test_counter", "counter", 100, None),
                       (3, "c", "counter", 10, None), (4, "c", "counter", 5, None)])
    got = {(r.id, r.mtype): (r.delta, r.value) for r in s.collect()}
    assert got[("test_gauge", "gauge")] == (None, 42.5)
    assert got[("test_counter", "counter")] == (100, None)
    assert got[("c", "counter")] == (15, None)


def test_concurrent_adds_equal_1000(spark):
    # 10 workers x 100 increments of 1 -> 1000, spread over many partitions.
    rows = [(w * 100 + i, "hits", "counter", 1, None) for w in range(10) for i in range(100)]
    df = spark.createDataFrame(rows, UPD).repartition(37)
    assert fold.fold_state(df).collect()[0].delta == 1000


def test_missing_keys_not_found(spark):
    s = _state(spark, [(1, "g", "gauge", None, 1.0)])
    req = spark.createDataFrame([(1, "nonexistent", "gauge"), (2, "nonexistent", "counter")],
                                "seq long, id string, type string")
    assert st.lookup(req, s).count() == 0
    assert st.lookup_missing(req, s).count() == 2


def test_listing_lines(spark):
    s = _state(spark, [(1, "gauge1", "gauge", None, 3.14), (2, "counter1", "counter", 42, None)])
    lines = {r.line for r in st.list_lines(s, 6).collect()}
    assert lines == {"gauge1 = 3.140000", "counter1 = 42"}
    lines2 = {r.line for r in st.list_lines(s, 2).collect()}
    assert lines2 == {"gauge1 = 3.14", "counter1 = 42"}


def test_lookup_text(spark):
    s = _state(spark, [(1, "g", "gauge", None, 123.45), (2, "c", "counter", 42, None)])
    texts = {(r.id, r.text) for r in st.value_texts(s).collect()}
    assert texts == {("g", "123.45"), ("c", "42")}
    req = spark.createDataFrame([(1, "g", "invalid")], "seq long, id string, type string")
    assert st.lookup(req, s).count() == 0
    assert st.lookup_rejected(req).count() == 1


def test_path_admission(spark):
    paths = spark.createDataFrame(
        [(1, "/update/gauge/m/123.45"), (2, "/update/counter/m/42"), (3, "/update/gauge/m/invalid"),
         (4, "/update/counter/m/invalid"), (5, "/update/invalid/m/123"), (6, "/update/gauge/m")],
        "seq long, path string")
    got = {r.seq: r.reject_reason for r in adm.admit_path(src.parse_path_update(paths)).collect()}
    assert got == {1: None, 2: None, 3: "bad_gauge_value", 4: "bad_counter_value",
                   5: "unknown_type", 6: "bad_path"}


def test_json_admission(spark):
    p = spark.createDataFrame(
        [(1, '{"id": "m", "type": "gauge"'), (2, '{"id": "m", "type": "invalid", "value": 1}'),
         (3, '{"id": "m", "type": "gauge"}'), (4, '{"id": "m", "type": "counter"}'),
         (5, ""), (6, '{"id": "m", "type": "GAUGE", "value": 2.5}')], "seq long, payload string")
    got = {r.seq: r.reject_reason for r in src.parse_json_update(p).collect()}
    assert got == {1: "malformed_json", 2: "unknown_type", 3: "gauge_without_value",
                   4: "counter_without_delta", 5: "empty_body", 6: None}


def test_kind_predicate(spark):
    df = spark.createDataFrame([("gauge",), ("counter",), ("invalid",), ("",), (None,)], "k string")
    assert [r.v for r in df.select(is_valid_kind("k").alias("v")).collect()] == \
        [True, True, False, False, False]


def test_signature_known_answers(spark):
    df = spark.createDataFrame([("",), ("Hello, World!",)], "p string")
    got = [r.h for r in df.select(sign_payload("p", "test_key").alias("h")).collect()]
    assert got == ["92488e1e3eeecdf99f3ed2ce59233efb4b4fb612d5655c0ce9ea52b5a502e655",
                   "0774f2b9a63c4abc12a829b3fdb46c24c13b9da4e81d42b67df9f60447914a10"]


def test_verify(spark):
    good = "0774f2b9a63c4abc12a829b3fdb46c24c13b9da4e81d42b67df9f60447914a10"
    df = spark.createDataFrame(
        [("Hello, World!", good, "test_key"), ("Hello, World!", "0" * 64, "test_key"),
         ("other", good, "test_key"), ("Hello, World!", good, "other_key")],
        "p string, h string, k string")
    out = [df.where(F.col("k") == k).select(verify_signature("p", "h", k).alias("v")).collect()
           for k in ("test_key", "other_key")]
    assert [r.v for r in out[0]] == [True, False, False]
    assert [r.v for r in out[1]] == [False]


def test_parse_counter_strict(spark):
    cases = ["42", "+42", "-7", " 42 ", "42.7", "1e3", "", "9223372036854775807",
             "9223372036854775808", "4_2", "0x10"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r.v for r in df.select(parse_counter("t").alias("v")).collect()]
    assert got == [42, 42, -7, None, None, None, None, 9223372036854775807, None, None, None]


def test_parse_gauge_strict(spark):
    cases = ["1.5", "-2", ".5", "5.", "1e3", "inf", "-Infinity", "NaN", "1.5d", " 1 ", "1e400",
             "0x1p-2", "abc"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r.v for r in df.select(parse_gauge("t").alias("v")).collect()]
    assert got[:5] == [1.5, -2.0, 0.5, 5.0, 1000.0]
    assert got[5] == float("inf") and got[6] == float("-inf") and got[7] != got[7]
    assert got[8:11] == [None, None, None]
    assert got[11] == 0.25 and got[12] is None


def test_encode_update_omits_nulls(spark):
    from metricfold.functions.scalars import encode_update
    df = spark.createDataFrame([("a", "counter", 5, None, None), ("b", "gauge", None, 1.5, ""),
                                ("c", "gauge", None, 2.0, "h")],
                               "id string, type string, delta long, value double, hash string")
    got = [r.j for r in df.select(encode_update("id", "type", "delta", "value", "hash").alias("j")).collect()]
    assert got == ['{"id":"a","type":"counter","delta":5}', '{"id":"b","type":"gauge","value":1.5}',
                   '{"id":"c","type":"gauge","value":2.0,"hash":"h"}']


def test_empty_listing_is_detected(spark):
    empty = spark.createDataFrame([], UPD)
    assert st.is_empty(fold.fold_state(empty))
    assert not st.is_empty(_state(spark, [(1, "g", "gauge", None, 1.0)]))


def test_path_lookup_is_case_sensitive(spark):
    s = _state(spark, [(1, "g", "gauge", None, 1.0)])
    req = spark.createDataFrame([(1, "g", "Gauge"), (2, "g", "gauge")], "seq long, id string, type string")
    assert [r.seq for r in st.lookup(req, s, lower=False).collect()] == [2]
    assert sorted(r.seq for r in st.lookup(req, s, lower=True).collect()) == [1, 2]


def test_sample_summary_text(spark):
    from metricfold.operators.samples import summary_text
    df = spark.createDataFrame([(1.0, 2.675, 1234.5)], "Alloc double, HeapAlloc double, Sys double")
    assert df.select(summary_text(df).alias("s")).collect()[0].s == \
        "MemoryMetrics{Alloc: 1.00, HeapAlloc: 2.67, Sys: 1234.50}"
    only = spark.createDataFrame([(3.0,)], "Sys double")
    assert only.select(summary_text(only).alias("s")).collect()[0].s == \
        "MemoryMetrics{Alloc: 0.00, HeapAlloc: 0.00, Sys: 3.00}"


def test_counter_overflow_is_an_error(spark):
    import pytest
    df = spark.createDataFrame([(1, "c", "counter", 2**63 - 1, None), (2, "c", "counter", 1, None)], UPD)
    with pytest.raises(Exception, match="(?i)overflow"):
        fold.fold_state(df).collect()


def test_state_invariant_detects_bad_rows(spark):
    bad = spark.createDataFrame(
        [("a", "counter", 1, None), ("b", "counter", None, 1.0), ("c", "gauge", 1, 1.0),
         ("d", "gauge", None, 2.0), ("e", "histogram", None, 1.0)],
        "id string, mtype string, delta long, value double")
    assert sorted(r.id for r in adm.state_violations(bad).collect()) == ["b", "c", "e"]
    r = adm.check_state(bad).collect()[0]
    assert (r.n_rows, r.n_violations) == (5, 3)


def test_listing_status_reports_empty_store(spark):
    empty = fold.fold_state(spark.createDataFrame([], UPD))
    r = st.listing_status(empty).collect()[0]
    assert (r.n_metrics, r.is_empty) == (0, True)
