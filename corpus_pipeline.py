"""A corpus pipeline of five stages over the documents table.

Each stage works on all that the one before kept, is written as Parquet in the
shared folder and read again. The first four return the columns of documents:
language identification drops texts without a language that is clear, line dedup
takes repeated lines out (and documents of which nothing is left), near-dedup
keeps one document of each group, and decontamination drops documents that hold
benchmark passages. The last returns what the mix takes of each document.

Rows are matched by doc_id; rows that share one are judged together by the
stages that compare documents. Extra columns are passed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricfold.llm import langid, linededup, minhash, mixing, wumanber
from metricfold.llm.common import Scratch, fresh_name, prepare, read


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found with a score of 0.5 or more."""
    prepare(spark)
    return langid.keep_identified(docs, min_score=0.5)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines. A document that loses lines and keeps
    no word goes; n_chars follows the text."""
    prepare(spark)
    before = fresh_name(docs, "_before")
    clean = linededup.remove_lines(docs.withColumn(before, F.col("text")))
    kept = clean.where(F.col(before).eqNullSafe(F.col("text")) | F.col("text").rlike(r"[^\x20\x09-\x0D]")) \
        .drop(before)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.length("text").cast(kind))
    return kept


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    prepare(spark)
    gone = minhash.near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    prepare(spark)
    found = wumanber.contamination(docs, read(spark, sf_dir, "benchmark"))
    gone = found.where("contaminated").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every document."""
    prepare(spark)
    return mixing.mix(docs)


STAGES = [("language_id", identify_language), ("line_dedup", dedup_lines), ("near_dedup", dedup_documents),
          ("decontaminate", decontaminate), ("mix", mix_sources)]

#: The first stage's support vector machines have no SQL form; tests compare
#: run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
