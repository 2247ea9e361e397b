"""Stored state: one Parquet version for each batch of one writer (SNK-3,
SRC-5, AGG-4b, STR-4).

The state lies in buckets by a hash of the id. A batch reads and writes the
buckets of its ids only, as ``<root>/of=<buckets>/batch=<id>/bucket=<b>/mtype=<kind>``;
the newest version of every bucket is the state. A version counts once Spark has
written its ``_SUCCESS``, so no reader sees half of one and a failed attempt is
written again. The batch id is Spark's own (``foreachBatch``), which only grows,
and a table has one writer: a batch is part of the state, and skipped, if its
version or a later one is there. Feeds side by side have a table each. Bucket
versions with KEEP newer ones are deleted, and versions of which nothing is left.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricfold.operators import state as st
from metricfold.operators.fold import fold_state
from metricfold.sinks.snapshot import delete_path, list_children, path_exists

STATE = "id string, mtype string, delta bigint, value double"
BUCKETS, KEEP = 16, 2  # buckets of a new table: about one for each GB of state


def _home(spark: SparkSession, root: str, buckets: int = BUCKETS) -> tuple[str, int]:
    """The versions' folder and the number of buckets, which a table keeps."""
    n = next((int(c[3:]) for c in list_children(spark, root) if c.startswith("of=")), buckets)
    return f"{root.rstrip('/')}/of={n}", n


def _bucket(id_: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(n)).cast("int")


def versions(spark: SparkSession, root: str) -> list[int]:
    """Ids of the batches whose versions are there, oldest first."""
    home, _ = _home(spark, root)
    return [int(c[6:]) for c in list_children(spark, home)
            if c.startswith("batch=") and path_exists(spark, f"{home}/{c}/_SUCCESS")]


def latest(spark: SparkSession, root: str) -> int | None:
    return max(versions(spark, root), default=None)


def already_applied(spark: SparkSession, root: str, batch_id: int) -> bool:
    """Whether this batch is part of the state."""
    return batch_id <= max(versions(spark, root), default=-1)


def _copies(spark: SparkSession, root: str) -> dict[int, list[str]]:
    """The folders of each bucket, oldest first."""
    home, out = _home(spark, root)[0], {}
    for path in (f"{home}/batch={v:012d}" for v in versions(spark, root)):
        for c in list_children(spark, path):
            if c.startswith("bucket="):
                out.setdefault(int(c[7:]), []).append(f"{path}/{c}")
    return out


def read_state(spark: SparkSession, root: str, buckets: set[int] | None = None) -> DataFrame:
    """SRC-5: the current state (id, mtype, delta, value), empty when nothing
    was stored; of some buckets only if given. Filters on the kind prune
    folders, those on the id reach Parquet and its bloom filters."""
    paths = [c[-1] for b, c in sorted(_copies(spark, root).items()) if buckets is None or b in buckets]
    if not paths:
        return spark.createDataFrame([], STATE)
    return spark.read.option("basePath", _home(spark, root)[0]).schema(f"{STATE}, batch string, bucket int") \
        .parquet(*paths).select("id", "mtype", "delta", "value")


def _touched(spark: SparkSession, root: str, ids: DataFrame, buckets: int = BUCKETS) -> set[int]:
    """The buckets of some ids (no more numbers than there are buckets)."""
    return {r[0] for r in ids.select(_bucket(F.col("id"), _home(spark, root, buckets)[1])).distinct().collect()}


def lookup_point(spark: SparkSession, root: str, points: list[tuple[str, str]]) -> DataFrame:
    """FLT-5 on the stored table: only the files of the points' buckets are opened."""
    ids = spark.createDataFrame([(i,) for i, _ in points], "id string")
    return st.lookup_point(read_state(spark, root, _touched(spark, root, ids)), points=points)


def _apply(spark: SparkSession, root: str, changes: DataFrame, batch_id: int, buckets: int, merge=st.upsert_folded) -> int:
    """Writes ``merge(stored rows of the touched buckets, changes)``; ``changes`` has one row per key."""
    home, n = _home(spark, root, buckets)
    changes.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        merge(read_state(spark, root, _touched(spark, root, changes, buckets)), changes) \
            .withColumn("bucket", _bucket(F.col("id"), n)).repartition("bucket").sortWithinPartitions("bucket", "mtype", "id") \
            .write.mode("overwrite").option("parquet.bloom.filter.enabled#id", "true").partitionBy("bucket", "mtype") \
            .parquet(f"{home}/batch={batch_id:012d}")
    finally:
        changes.unpersist()
    copies = _copies(spark, root).values()
    kept = {path.rsplit("/", 1)[0] for c in copies for path in c[-KEEP:]} | {f"{home}/batch={batch_id:012d}"}
    empty = [path for v in versions(spark, root) if (path := f"{home}/batch={v:012d}") not in kept]
    for path in empty + [path for c in copies for path in c[:-KEEP]]:
        delete_path(spark, path)
    return batch_id


def apply_batch(spark: SparkSession, root: str, batch: DataFrame, batch_id: int, order_col: str = "seq",
                buckets: int = BUCKETS) -> int | None:
    """SNK-3 + JOIN-1: fold a batch and upsert it (keyed (id, mtype)); its id, or None if it was applied before."""
    return None if already_applied(spark, root, batch_id) else \
        _apply(spark, root, fold_state(batch, order_col), batch_id, buckets)


def apply_set(spark: SparkSession, root: str, current: DataFrame, batch_id: int, buckets: int = BUCKETS) -> int | None:
    """Replace the values of the keys in ``current`` (as a streaming fold emits them in update mode)."""
    return None if already_applied(spark, root, batch_id) else _apply(
        spark, root, current.select("id", "mtype", "delta", "value"), batch_id, buckets,
        lambda old, new: old.join(new, ["id", "mtype"], "left_anti").unionByName(new))


def apply_strict_batch(spark: SparkSession, root: str, batch: DataFrame, batch_id: int, order_col: str = "seq",
                       quarantine: str | None = None, buckets: int = BUCKETS) -> int | None:
    """AGG-4b: all or nothing. One conflicting gauge sends the whole batch to
    ``quarantine``/batch_id=N (when given) and leaves no version."""
    if already_applied(spark, root, batch_id):
        return None
    stored = read_state(spark, root, _touched(spark, root, batch, buckets))
    plan = st.strict_batch_plan(stored, batch, order_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not plan.agg(F.sum("conflicts")).first()[0]:
            effective = plan.where("effective").select("id", "mtype", "delta", "value")
            return _apply(spark, root, effective, batch_id, buckets)
        if quarantine:
            batch.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch_id={batch_id}")
        return None
    finally:
        plan.unpersist()
