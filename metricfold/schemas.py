"""Record schemas and the fixed values of the metric model.

Fixed values below must equal the reference data model for results to match:
the two metric kinds and the names of the host-sample fields, in their
natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: metric kinds -------------------------------------------
COUNTER = "counter"
GAUGE = "gauge"
KINDS = (GAUGE, COUNTER)

# ---- fixed values: host-sample fields (runtime provider, then host provider)
RUNTIME_FIELDS = (
    "Alloc", "BuckHashSys", "Frees", "GCCPUFraction", "GCSys", "HeapAlloc",
    "HeapIdle", "HeapInuse", "HeapObjects", "HeapReleased", "HeapSys", "LastGC",
    "Lookups", "MCacheInuse", "MCacheSys", "MSpanInuse", "MSpanSys", "Mallocs",
    "NextGC", "NumForcedGC", "NumGC", "OtherSys", "PauseTotalNs", "StackInuse",
    "StackSys", "Sys", "TotalAlloc", "RandomValue",
)
HOST_FIELDS = ("TotalMemory", "FreeMemory")
SAMPLE_FIELDS = RUNTIME_FIELDS + HOST_FIELDS
CPU_FIELD = "CPUutilization"
# Fields whose joint zero marks a sample as "empty" (nothing collected yet).
ZERO_TEST_FIELDS = ("Alloc", "Sys", "TotalAlloc")
# Counter name of the poll counter sent with every report.
POLL_COUNTER = "PollCount"
# -----------------------------------------------------------------------------

UPDATE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("delta", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("hash", T.StringType()),
])

STATE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("mtype", T.StringType()),
    T.StructField("delta", T.LongType()),
    T.StructField("value", T.DoubleType()),
])

AUDIT = T.StructType([
    T.StructField("ts", T.LongType()),
    T.StructField("metrics", T.ArrayType(T.StringType())),
    T.StructField("ip_address", T.StringType()),
])

SAMPLE = T.StructType(
    [T.StructField("host", T.LongType()), T.StructField("ord", T.LongType()),
     T.StructField("ts", T.TimestampType())]
    + [T.StructField(name, T.DoubleType()) for name in SAMPLE_FIELDS]
    + [T.StructField(CPU_FIELD, T.ArrayType(T.DoubleType()))]
)

SIGNED = T.StructType([
    T.StructField("payload", T.StringType()),
    T.StructField("sig", T.StringType()),
    T.StructField("alt_sig", T.StringType()),
])
