"""Randomised strict parsing against small Python models of the rules
(base-10 int64 without blanks/underscores; float64 decimal forms, NaN/Inf
spellings, overflow to infinity rejected)."""

import math
import random
import re

from metricfold.functions.scalars import parse_counter, parse_gauge

ALPHABET = "0123456789+-.eE xabINnfity_"


def _int_model(s):
    if not re.fullmatch(r"[+-]?[0-9]+", s):
        return None
    v = int(s)
    return v if -2**63 <= v < 2**63 else None


def _float_model(s):
    if re.fullmatch(r"[+-]?(inf|infinity)", s, re.I):
        return -math.inf if s.startswith("-") else math.inf
    if re.fullmatch(r"nan", s, re.I):
        return math.nan
    if re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", s):
        v = float(s)
        return None if math.isinf(v) else v
    return None


def _strings(n, seed):
    rng = random.Random(seed)
    out = ["0", "-0", "+0", "00012", "9223372036854775807", "-9223372036854775808",
           "9223372036854775808", "1e308", "1e309", "-1e309", "2.5e-3", "Infinity", "-inf", "nan",
           "+nan", "1_000", " 7", "7 ", ".", "e5", "1e", "1.e5", ".5e-2"]
    for _ in range(n):
        k = rng.randint(1, 8)
        out.append("".join(rng.choice(ALPHABET) for _ in range(k)))
        out.append(str(rng.randint(-10**20, 10**20)))
        out.append(repr(rng.uniform(-1e6, 1e6)))
    return out


def _same(a, b):
    if a is None or b is None:
        return a is b
    if isinstance(b, float) and math.isnan(b):
        return isinstance(a, float) and math.isnan(a)
    return a == b


def test_parse_counter_matches_model(spark):
    cases = _strings(700, 5)
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r.v for r in df.select("t", parse_counter("t").alias("v")).collect()]
    bad = [(c, g, _int_model(c)) for c, g in zip(cases, got) if not _same(g, _int_model(c))]
    assert bad == []


def test_parse_gauge_matches_model(spark):
    cases = _strings(700, 9)
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r.v for r in df.select("t", parse_gauge("t").alias("v")).collect()]
    bad = [(c, g, _float_model(c)) for c, g in zip(cases, got) if not _same(g, _float_model(c))]
    assert bad == []
