"""Audit events: one record per applied update batch (AGG-7, SCL-8, SNK-4).

The reference emits, after each batch is stored, ``{ts, metrics, ip_address}``
where ``metrics`` lists the ids of the batch in arrival order, duplicates and
skipped rows included. One batch is one event, whatever its order keys. The
list is as long as the batch, which its sender bounds (one request body, one
micro-batch). ``payload_events`` takes the ids from each parsed request body,
without a shuffle, so that an empty batch has its event too; ``audit_events``
groups exploded updates by their batch; ``audit_rows`` keeps a batch of any
length as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricfold.functions.scalars import unix_millis


def _with_line(events: DataFrame) -> DataFrame:
    return events.withColumn("n_metrics", F.size("metrics").cast("bigint")).withColumn(
        "line", F.to_json(F.struct("ts", "metrics", "ip_address")))


def audit_events(updates: DataFrame, batch_col: str = "batch_id", order_col: str = "seq",
                 ts_col: str = "ts", ip_col: str = "ip_address") -> DataFrame:
    """AGG-7 -> (batch_id, ts, metrics, ip_address, n_metrics, line).

    ``ts`` is the batch's latest arrival time in Unix ms (floored),
    ``ip_address`` that of its first row; ``line`` is the JSON text the file
    observer appends (key order ts, metrics, ip_address).
    """
    item = F.struct(F.col(order_col).alias("o"), F.col("id").alias("id"), F.col(ip_col).alias("ip"))
    g = updates.groupBy(F.col(batch_col).alias("batch_id")).agg(
        F.max(ts_col).alias("_ts"), F.sort_array(F.collect_list(item)).alias("_items"))
    return _with_line(g.select("batch_id", unix_millis("_ts").alias("ts"),
                               F.transform("_items", lambda x: x["id"]).alias("metrics"),
                               F.get("_items", F.lit(0))["ip"].alias("ip_address")))


def payload_events(bodies: DataFrame, batch_col: str, ids: Column, ts: Column, ip: Column) -> DataFrame:
    """AGG-7 over request bodies: ``ids`` is the array of the body's ids in
    order, empty for an empty batch."""
    return _with_line(bodies.select(F.col(batch_col).alias("batch_id"), unix_millis(ts).alias("ts"),
                                    ids.alias("metrics"), ip.alias("ip_address")))


def audit_rows(updates: DataFrame, batch_col: str = "batch_id", order_col: str = "seq") -> DataFrame:
    """The ids of batches as rows (batch_id, pos, id), for batches of any length."""
    return updates.select(F.col(batch_col).alias("batch_id"), F.col(order_col).alias("pos"), "id")
