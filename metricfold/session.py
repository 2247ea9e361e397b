"""Session settings and the shared checkpoint location.

On a cluster the session comes from the launcher; ``tune`` only sets options
that are not already set, so cluster-wide choices win. The checkpoint root is
always read from ``spark.checkpoint.dir``; without it, it lies in the warehouse,
which the cluster shares as well. Nothing is written to a machine's own folders.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Options every metricfold job relies on. Values are defaults, not overrides.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast only on measured sizes: no broadcast from plan estimates
    # (compressed file sizes are no bound on in-memory size); AQE broadcasts
    # a join side when its actual shuffle output is under the adaptive
    # threshold and keeps the sort-merge join otherwise.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # A JSON key that occurs twice keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Coalesce shuffle partitions to the advisory size (bytes), not to the
    # largest task count: with a high spark.sql.shuffle.partitions on a
    # cluster, AQE then right-sizes every stage from measured output.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply metricfold defaults for any option the session does not set."""
    for key, value in _DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    # Session time zone must be UTC for unix-millisecond and window math to
    # agree with the naive timestamps in the inputs.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(master: str | None = None, partitions: int | None = None,
                  app: str = "metricfold", conf: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs and tests (UI off, small shuffle width)."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("METRICFOLD_DRIVER_MEM", "8g"))
    for key, value in (_DEFAULTS | (conf or {})).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables:
    ``spark.checkpoint.dir`` (or the context's checkpoint dir), else a folder in
    the session's warehouse."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root and sc is not None:
            root = sc.getConf().get("spark.checkpoint.dir")
        if root and sc is not None:
            sc.setCheckpointDir(root)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = f"{warehouse.rstrip('/')}/_checkpoints"
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir()
    return root.rstrip("/")
