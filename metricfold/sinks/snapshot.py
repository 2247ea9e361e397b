"""Snapshots of state as JSON update records (SNK-1) and file-system probes.

A snapshot is written to a fresh versioned directory and never over the
path being read; the reader picks the newest complete one. Paths are
resolved through the cluster's Hadoop file system, so they may be any shared
store the session can reach.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricfold.schemas import COUNTER, GAUGE


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def list_children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p))


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file exclusively; False if it already exists."""
    fs, p = _fs_path(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as exc:
        if fs.exists(p):
            return False
        raise exc
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        data = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
        return bytes(data).decode()
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def snapshot_records(state: DataFrame) -> DataFrame:
    """State as update records: counters carry only delta, gauges only value."""
    return state.select(
        "id", F.col("mtype").alias("type"),
        F.when(F.col("mtype") == COUNTER, F.col("delta")).alias("delta"),
        F.when(F.col("mtype") == GAUGE, F.col("value")).alias("value"))


def save_snapshot(state: DataFrame, root: str, version: int) -> str:
    """SNK-1: write ``state`` as JSON lines under ``root/snapshot-<version>``.

    JSON lines (one record per line) keep the write parallel; NULL fields are
    omitted like the reference's ``omitempty``. A non-finite gauge fails the
    save, as ``json.Marshal`` does in the reference. Returns the path.
    """
    target = f"{root.rstrip('/')}/snapshot-{version:012d}"
    rec = snapshot_records(state)
    bad = F.col("value").isNotNull() & (F.isnan("value") | (F.abs("value") == float("inf")))
    checked = rec.withColumn(
        "value", F.when(bad, F.raise_error(F.lit("non-finite gauge in snapshot")))
        .otherwise(F.col("value")))
    checked.write.mode("overwrite").json(target)
    return target


def latest_snapshot(spark: SparkSession, root: str) -> str | None:
    """Newest complete snapshot directory under ``root`` (has _SUCCESS)."""
    names = [n for n in list_children(spark, root) if n.startswith("snapshot-")]
    for name in sorted(names, reverse=True):
        path = f"{root.rstrip('/')}/{name}"
        if path_exists(spark, f"{path}/_SUCCESS"):
            return path
    return None
