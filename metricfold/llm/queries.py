"""Registered queries of the operators in this subpackage, one each, over
their whole tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession

from metricfold.llm import (alignment, hnsw, langid, linededup, maxent, minhash, mixing, potential, segments,
                            transducer, urlrank, warc, wumanber)
from metricfold.llm.common import read


def tokenizer_file(name: str) -> str:
    """Where the cluster's public tokenizer files are."""
    return importlib.import_module("public_tokenizers").path(name)


def op1_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by the hashed maximum-entropy model; see ``maxent``."""
    return maxent.score_texts(read(spark, sf_dir, "documents"))


def op2_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all documents that repeat an earlier one; see ``segments``."""
    return segments.repeated_spans(read(spark, sf_dir, "documents"))


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents within one edit of an earlier line; see ``linededup``."""
    return linededup.repeated_lines(read(spark, sf_dir, "documents"))


def op4_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-dedup of all embeddings over navigable small-world graphs; see ``hnsw``."""
    return hnsw.near_duplicates(read(spark, sf_dir, "embeddings"))


def op5_wumanber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents by Wu-Manber search; see ``wumanber``."""
    return wumanber.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, family first; see ``langid``."""
    return langid.identify(read(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC files and read back; see ``warc``."""
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash near-dedup of all documents; see ``minhash``."""
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by a low-discrepancy schedule; see ``mixing``."""
    return mixing.mix(read(spark, sf_dir, "documents"))


def op10_urlrank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages by rules and link-graph propagation; see ``urlrank``."""
    return urlrank.verdicts(read(spark, sf_dir, "pages"))


def op11_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents by a compiled transducer; see ``transducer``."""
    return transducer.count_tokens(read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op12_potential(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction of five filters over all documents; see ``potential``."""
    return potential.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tokenizers aligned over all documents; see ``alignment``."""
    return alignment.align(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                           tokenizer_file("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_maxent, op2_segments, op3_lines, op4_hnsw, op5_wumanber, op6_langid,
                                   op7_warc, op8_minhash, op9_mixing, op10_urlrank, op11_transducer,
                                   op12_potential, op13_alignment)}
ORACLES = {"op3_lines": linededup.LINES_SQL, "op4_hnsw": hnsw.LINKS_SQL,
           "op5_wumanber": wumanber.CONTAMINATION_SQL, "op7_warc": warc.RECORDS_SQL,
           "op8_minhash": minhash.COMPONENTS_SQL, "op9_mixing": mixing.MIX_SQL, "op10_urlrank": urlrank.verdicts_sql(),
           "op12_potential": potential.AUDIT_SQL}
