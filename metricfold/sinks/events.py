"""Event sinks: audit lines (SNK-4), fan-out to observers (SNK-5) and the
agent's forward payloads (SNK-6)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricfold.functions.scalars import sign_payload
from metricfold.sinks.snapshot import path_exists

Sink = Callable[[DataFrame], None]


def write_audit(events: DataFrame, path: str) -> None:
    """SNK-4: append one JSON line per audit event (the ``line`` column of
    ``audit_events``) to the text table at ``path``."""
    events.select(F.col("line").alias("value")).write.mode("append").text(path)


SPAN = 4096  # batch ids of one folder


def write_audit_batch(events: DataFrame, path: str) -> None:
    """SNK-4, idempotent form: a re-emitted (replayed) batch replaces its own
    lines, so that exactly one copy is left. ``path`` reads back as one text
    table; ``read_audit_batches`` gives the lines with their batches.

    Lines lie in a folder for every SPAN batch ids, so that the number of files
    follows the lines and not the batches. Beside them (in a folder that Spark's
    readers leave out) lies a table of batches and lines. A write joins its events
    with the batches that it leaves in the folders it touches, and both forms of
    these folders are replaced by dynamic partition overwrite.
    """
    spark, table = events.sparkSession, f"{path.rstrip('/')}/_batches"
    new = events.select("batch_id", "line").withColumn("span", F.expr(f"try_cast(batch_id AS bigint) div {SPAN}"))
    touched = [r[0] for r in new.select("span").distinct().collect()]  # one number for SPAN batches

    def stored() -> DataFrame:
        of = F.col("span").isin([s for s in touched if s is not None])
        t = spark.read.schema(new.schema).parquet(table)
        return t.where(of | F.col("span").isNull() if None in touched else of)

    def replace(df: DataFrame):
        return df.hint("rebalance", "span").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("span")

    if path_exists(spark, table):
        old, ids = stored(), new.select(F.col("batch_id").alias("_new")).distinct()
        new = old.join(ids, F.col("batch_id").eqNullSafe(F.col("_new")), "left_anti").unionByName(new)
    replace(new).parquet(table)
    replace(stored().select(F.col("line").alias("value"), "span")).text(path)


def read_audit_batches(spark: SparkSession, path: str) -> DataFrame:
    """The lines of ``write_audit_batch`` with their batches (batch_id, value)."""
    return spark.read.parquet(f"{path.rstrip('/')}/_batches").select("batch_id", F.col("line").alias("value"))


def fanout(df: DataFrame, sinks: dict[str, Sink]) -> dict[str, str | None]:
    """SNK-5: hand the same events to every registered sink, independently.

    The frame is computed once (persisted, spilling to disk if needed) and
    every sink gets it; a failing sink is reported, not raised, so it affects
    neither the other sinks nor the state write that came before.
    """
    df.persist(StorageLevel.MEMORY_AND_DISK)
    errors: dict[str, str | None] = {}
    try:
        for name, sink in sinks.items():
            try:
                sink(df)
                errors[name] = None
            except Exception as exc:  # observer failures are isolated
                errors[name] = f"{type(exc).__name__}: {exc}"
    finally:
        df.unpersist()
    return errors


def forward_payloads(batches: DataFrame, key: str | None = None,
                     group: tuple[str, ...] = ("host", "window_start")) -> DataFrame:
    """SNK-6: one JSON-array payload per report (host, window) of
    ``report_batches``, signed over the uncompressed text when a key is set.
    Packed reports are encoded as they are, rows are gathered by report first.

    A report holds at most one row per sample field plus the poll counter,
    so each group is small by construction (the SAMPLE schema bounds it).
    """
    def item(u: Column) -> Column:
        v = u["value"]
        value = F.when(F.isnan(v) | (F.abs(v) == float("inf")),
                       F.raise_error(F.lit("a gauge that is not finite cannot be encoded")).cast("double")).otherwise(v)
        return F.struct(u["id"].alias("id"), u["type"].alias("type"), u["delta"].alias("delta"), value.alias("value"))

    if "updates" not in batches.columns:
        batches = batches.groupBy(*group).agg(
            F.collect_list(F.struct("id", "type", "delta", "value")).alias("updates"))
    p = batches.select(*group, F.to_json(F.sort_array(F.transform("updates", item))).alias("payload"))
    sig = sign_payload("payload", key) if key else F.lit(None).cast("string")
    return p.withColumn("sig", sig)


def write_payloads(payloads: DataFrame, path: str) -> None:
    """Write forward payloads as gzip JSON lines ({payload, sig, ...})."""
    payloads.write.mode("append").option("compression", "gzip").json(path)
