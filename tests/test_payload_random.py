"""Randomised batch payloads: the VARIANT verdict rule against a small
Python model of the decoder (json module + the field type rules)."""

import json
import random

from metricfold.sources import updates as src

FIELDS = ("id", "type", "hash", "delta", "value", "note")
VALUES = ['"m1"', '"gauge"', "5", "-7", "1.5", "1e3", "9223372036854775807",
          "9223372036854775808", "true", "null", '{"a": 1}', "[1]", '"5"', "0", "2.0"]


def _model(text):
    try:
        doc = json.loads(text)
    except ValueError:
        return False
    if doc is None:
        return True
    if not isinstance(doc, list):
        return False
    for el in doc:
        if el is None:
            continue
        if not isinstance(el, dict):
            return False
        for k in ("id", "type", "hash"):
            if k in el and el[k] is not None and not isinstance(el[k], str):
                return False
        d = el.get("delta")
        if d is not None and (isinstance(d, bool) or not isinstance(d, int) or not -2**63 <= d < 2**63):
            return False
        v = el.get("value")
        if v is not None and (isinstance(v, bool) or not isinstance(v, (int, float))):
            return False
    return True


def _payloads(n, seed):
    rng = random.Random(seed)
    out = ["null", "[]", "[null]", "not json", "{}", "5", '"x"', "[1]"]
    for _ in range(n):
        elems = []
        for _ in range(rng.randint(0, 3)):
            if rng.random() < 0.1:
                elems.append("null")
                continue
            keys = rng.sample(FIELDS, rng.randint(0, 4))  # distinct keys only
            elems.append("{" + ", ".join(f'"{k}": {rng.choice(VALUES)}' for k in keys) + "}")
        out.append("[" + ", ".join(elems) + "]")
    return out


def test_payload_verdicts_match_model(spark):
    cases = _payloads(600, 21)
    df = spark.createDataFrame(list(enumerate(cases)), "i int, payload string")
    got = {r.i: r.accepted for r in src.payload_verdicts(df).collect()}
    bad = [(cases[i], got[i], _model(cases[i])) for i in range(len(cases)) if got[i] != _model(cases[i])]
    assert bad == []


def _model_single(text):
    if not text:
        return "empty_body"
    if not text.lstrip().startswith("{") or not _model("[" + text + "]"):
        return "malformed_json"
    try:
        el = json.loads(text)
    except ValueError:
        return "malformed_json"
    kind = (el.get("type") or "").lower()
    if kind not in ("gauge", "counter"):
        return "unknown_type"
    if kind == "gauge" and el.get("value") is None:
        return "gauge_without_value"
    if kind == "counter" and el.get("delta") is None:
        return "counter_without_delta"
    return None


def test_single_updates_match_model(spark):
    rng = random.Random(5)
    kinds = ['"gauge"', '"counter"', '"Gauge"', '"COUNTER"', '"histogram"', "null", "3"]
    cases = ["", "null", "[]", "not json", "{"]
    for _ in range(500):
        keys = rng.sample(("id", "delta", "value", "hash", "note"), rng.randint(0, 3))
        fields = [f'"{k}": {rng.choice(VALUES)}' for k in keys]
        if rng.random() < 0.9:
            fields.append(f'"type": {rng.choice(kinds)}')
        rng.shuffle(fields)
        cases.append("{" + ", ".join(fields) + "}")
    df = spark.createDataFrame(list(enumerate(cases)), "i int, payload string")
    got = {r.i: r.reject_reason for r in src.parse_json_update(df).collect()}
    bad = [(cases[i], got[i], _model_single(cases[i])) for i in range(len(cases))
           if got[i] != _model_single(cases[i])]
    assert bad == []
