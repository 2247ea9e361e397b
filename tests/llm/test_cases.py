"""Very long texts, nulls, repeated rows and extra columns with the operators' own inner names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from metricfold.llm import (alignment, hnsw, langid, linededup, maxent, minhash, mixing, potential, segments, transducer,
                            urlrank, warc, wumanber)

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(120_000))
ROWS = [(1, LONG, "en", "a"), (2, "A short Text. " * 9, "en", None), (3, None, None, "a"), (4, "", "de", "b"),
        (5, "one line\nanother line that is long enough", "de", "b"), (5, "one line\nanother line that is long enough", "de", "b"),
        (None, "no id at all " * 7, "en", ""), (6, "\x00\x0b ▁ é 😀", None, "c"), (7, LONG + " tail", "en", "a")]

#: Names that columns inside the operators have.
NAMES = ("doc key body row h n at link g copies near links first_doc start stop words edge d1 d2 held_out train digest part "
         "mask good toxic first pairs docs planes block ids n_a n_b best size target weight slot rank k chunk cell low high "
         "line line_no h1 h2 halves v pos other score base_score component_id node component sig band shard name records "
         "page host path rule ruled verdict trust distrust kind mass moving a b e u index value task side").split()

OPERATORS = {
    "maxent": lambda d: maxent.score_texts(d).drop("score"),  # sums of floats in another order
    "segments": segments.repeated_spans, "linededup": linededup.repeated_lines, "langid": langid.identify,
    "minhash": minhash.near_duplicates, "mixing": mixing.mix,
    "wumanber": lambda d: wumanber.contamination(d, d.sparkSession.createDataFrame(
        [("i1", " ".join(LONG.split()[5000:5020])), ("i2", None)], "item_id string, text string")),
    "transducer": lambda d: transducer.count_tokens(d, MODEL, chunk=10_000, fan=4),
    "potential": lambda d: potential.audit(d, d.sparkSession.createDataFrame(
        [(1, 1, 0), (7, 0, 1)], "doc_id long, quality int, toxic int")),
    "alignment": lambda d: alignment.align(d, BYTES, MODEL),
}


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").repartition(3).cache()


def _rows(df):
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted(map(repr, map(tuple, df.select(*rounded).collect())))


@pytest.mark.parametrize("name", OPERATORS)
def test_long_texts_and_clashing_columns(table, name):
    plain = _rows(OPERATORS[name](table))
    own = {c.lower() for c in table.columns}
    crowded = table.select("*", *[F.lit("x").alias(n) for n in NAMES if n not in own])
    assert _rows(OPERATORS[name](crowded)) == plain
    if name in ("langid", "mixing", "minhash", "wumanber", "transducer", "alignment"):
        assert len(plain) == len(ROWS)


def test_long_text_results(table):
    got = {r.doc_id: r for r in OPERATORS["transducer"](table).where("doc_id IN (1, 7)").collect()}
    assert got[1].n_bytes == len(LONG) and got[1].n_tokens > 120_000 and got[7].n_tokens > got[1].n_tokens
    found = {r.doc_id: r for r in OPERATORS["wumanber"](table).collect()}
    assert found[1].n_hit >= 20 and found[1].n_words == 120_000 and not found[1].contaminated
    spans = [r for r in segments.repeated_spans(table).collect() if r.doc_id == 7]
    assert sum(r.n_words for r in spans) >= 119_000
    assert {r.doc_id: r.size for r in mixing.mix(table).collect() if r.doc_id == 1} == {1: 120_000}


def test_long_pages_and_vectors(spark):
    html = "<p>" + LONG + '</p><a href="http://bad.net/">'
    pages = spark.createDataFrame([(1, "http://a.io/", html), (2, "http://a.io/x", html), (None, None, None), (3, "http://c.io", "")],
                                  "page_id long, url string, html string")
    crowded = pages.select("*", *[F.lit("x").alias(n) for n in NAMES])
    assert _rows(urlrank.verdicts(crowded)) == _rows(urlrank.verdicts(pages))
    assert {r.page_id: r.verdict for r in urlrank.verdicts(pages).collect()} == {1: "block", 2: "block", None: "allow", 3: "allow"}
    assert _rows(warc.round_trip(crowded)) == _rows(warc.round_trip(pages))
    vectors = spark.createDataFrame([(i, [float(i % 3)] * 4000 + [1.0]) for i in range(12)], "vec_id long, embedding array<double>")
    assert _rows(hnsw.near_duplicates(vectors.select("*", *[F.lit("x").alias(n) for n in NAMES]))) == \
        _rows(hnsw.near_duplicates(vectors))
