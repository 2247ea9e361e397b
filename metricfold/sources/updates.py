"""Update sources: JSON batches, single JSON updates, path texts, snapshots.

Payload validation runs on the VARIANT type: ``try_parse_json``, then one look
at the type of the whole payload, which merges those of its elements. Where it
shows known fields that are exactly spelled and well typed, as in most payloads,
one cast decodes all elements. Any other payload is decoded element by element
with higher-order functions on its row. No explode, no shuffle, and a bad element
rejects its whole payload, as the batch endpoint does. Only accepted payloads are
exploded into update rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricfold.operators.admission import BAD_PATH, EMPTY_BODY, MALFORMED_JSON, update_reason
from metricfold.functions.scalars import normalize_kind
from metricfold.schemas import COUNTER, GAUGE, UPDATE

# VARIANT types that a field may have; any other type rejects the update.
_TYPES = {"id": "STRING|VOID", "type": "STRING|VOID", "hash": "STRING|VOID", "delta": "BIGINT|VOID",
          "value": r"BIGINT|DOUBLE|VOID|DECIMAL\([0-9]+, ?[0-9]+\)"}
# The type text of an object of scalars whose known fields are spelled exactly
# and well typed (of an array: the merged type of its elements): the common
# case, settled by one look at one text.
_OBJECT = (r"OBJECT<(?:(?:" + "|".join(f"{f}: (?:{t})" for f, t in _TYPES.items())
          + r"|(?!(?i:id|type|hash|delta|value): )[A-Za-z0-9_]+: [A-Z_]+(?:\([0-9]+, ?[0-9]+\))?)(?:, (?=[A-Za-z0-9_])|(?=>)))*>")
_PLAIN, _PLAIN_ARRAY = f"^{_OBJECT}$", f"^ARRAY<(?:VOID|{_OBJECT})>$"
_KINDS_OF = {"id": "string", "type": "string", "hash": "string", "delta": "bigint", "value": "double"}


def _typed(v: Column) -> Column:
    """A JSON value with its type, looked up once."""
    t = F.schema_of_variant(v)
    return F.struct(v.alias("v"), t.alias("kind"), F.coalesce(t.rlike(_PLAIN), F.lit(False)).alias("plain"))


def _spelled(x: Column) -> Column:
    """Adds the fields of an object that is not plain, for keys that differ in
    case (a field is known by its name in any case)."""
    entries = F.map_entries(F.try_variant_get(x["v"], "$", "map<string,variant>"))
    odd = ~x["plain"] & x["kind"].startswith("OBJECT")
    return F.struct(x["v"].alias("v"), x["kind"].alias("kind"), x["plain"].alias("plain"),
                    F.when(odd, entries).alias("fields"))


def _decode(x: Column) -> Column:
    """One update (Go's decoder into the update struct) as a struct with ``ok``.

    id/type/hash: string or null; delta: integer within int64 or null; value:
    any finite JSON number or null. Unknown keys are ignored; keys match in any
    case, and two keys that differ in case only make the update ill-formed (their
    order is not kept).
    """
    def spelled(f: str) -> Column:
        return F.filter(x["fields"], lambda e: F.lower(e["key"]) == f)

    named = {f: spelled(f) for f in _TYPES}

    def get(f: str) -> Column:
        kind = _KINDS_OF[f]
        return F.when(x["plain"], F.try_variant_get(x["v"], f"$.{f}", kind)) \
            .otherwise(F.try_variant_get(F.get(named[f], F.lit(0))["value"], "$", kind))

    def well(f: str) -> Column:
        t = F.schema_of_variant(F.get(named[f], F.lit(0))["value"])
        return (F.size(named[f]) == 0) | ((F.size(named[f]) == 1) & t.rlike(f"^(?:{_TYPES[f]})$"))

    slow = x["fields"].isNotNull()
    for f in _TYPES:
        slow = slow & well(f)
    value = get("value")
    finite = value.isNull() | ((F.abs(value) < float("inf")) & ~F.isnan(value))
    ok = (x["kind"] == "VOID") | ((x["plain"] | F.coalesce(slow, F.lit(False))) & finite)
    return F.struct(ok.alias("ok"), F.struct(get("id").alias("id"), get("type").alias("type"), get("delta").alias("delta"),
                                             value.alias("value"), get("hash").alias("hash")).alias("update"))


_FIELDS = "struct<id:string,type:string,delta:bigint,value:double,hash:string>"


def _infinite(value: Column) -> Column:
    return F.coalesce(F.abs(value) == float("inf"), F.lit(False))


def _parsed(payloads: DataFrame, payload_col: str) -> DataFrame:
    """Parses and decodes each payload once, into ``_d`` (an array of updates,
    NULL for a payload that is no array) and ``_ok`` (whether all are well
    formed); verdicts, rows and audit ids all read them."""
    v, none = F.col("_v"), F.array().cast(f"array<{_FIELDS}>")
    kinds = F.schema_of_variant(v)
    p = payloads.withColumn("_v", F.try_parse_json(F.col(payload_col))).withColumn("_t", kinds) \
        .withColumn("_plain", F.coalesce(F.col("_t").rlike(_PLAIN_ARRAY), F.lit(False)))
    elems = F.try_variant_get(v, "$", "array<variant>")
    each = F.transform(F.transform(F.transform(elems, _typed), _spelled), _decode)
    odd = F.when(~F.col("_plain") & F.col("_t").startswith("ARRAY"), each)
    p = p.withColumn("_odd", odd).withColumn("_d", F.when(F.col("_t") == "VOID", none).when(
        F.col("_plain"), F.try_variant_get(v, "$", f"array<{_FIELDS}>")).otherwise(F.transform("_odd", lambda x: x["update"])))
    ok = F.when(F.col("_plain"), ~F.exists("_d", lambda x: _infinite(x["value"]))) \
        .otherwise((F.col("_t") == "VOID") | F.forall("_odd", lambda x: x["ok"]))
    return p.withColumn("_ok", F.coalesce(ok, F.lit(False))).drop("_v", "_t", "_plain", "_odd")


def _reason() -> Column:
    return F.when(~(F.col("_ok") & F.col("_d").isNotNull()), F.lit(MALFORMED_JSON))


def _update(col: str) -> list[Column]:
    """The fields of a decoded update; a missing or null id or kind is "", the
    zero value (a JSON null is an update of nothing, later skipped)."""
    u = F.col(col)
    return [F.coalesce(u["id"], F.lit("")).alias("id"), F.coalesce(u["type"], F.lit("")).alias("type"),
            u["delta"].alias("delta"), u["value"].alias("value"), u["hash"].alias("hash")]


def payload_verdicts(payloads: DataFrame, payload_col: str = "payload",
                     keep_parsed: bool = False) -> DataFrame:
    """SRC-1 rule per payload row: adds ``accepted`` (bool), ``n_elements``
    and ``reject_reason``. ``null`` is an empty batch; a non-array, an
    unparsable text or one ill-typed element rejects the payload.
    ``keep_parsed`` keeps what is decoded (``_d``, ``_ok``) for ``payload_updates``."""
    p = payloads if "_d" in payloads.columns else _parsed(payloads, payload_col)
    out = p.withColumn("reject_reason", _reason()).withColumn("accepted", F.col("reject_reason").isNull()) \
        .withColumn("n_elements", F.when(F.col("_d").isNotNull(), F.size("_d")).cast("bigint"))
    return out if keep_parsed else out.drop("_d", "_ok")


def payload_ids() -> Column:
    """The ids of a decoded payload in order, empty for an empty batch."""
    return F.transform("_d", lambda x: F.coalesce(x["id"], F.lit("")))


def payload_updates(payloads: DataFrame, payload_col: str = "payload",
                    keep: list[str] | None = None) -> DataFrame:
    """Update rows of the accepted payloads, with their array position
    ``pos`` (the arrival order inside the payload). ``keep`` columns of the
    payload row (e.g. a batch id) are carried along. Parsed once; the array
    is exploded only for accepted payloads, without any shuffle."""
    keep = keep or []
    p = payloads if "_d" in payloads.columns else _parsed(payloads, payload_col)
    ex = p.where(_reason().isNull()).select(*keep, F.posexplode("_d").alias("pos", "_e"))
    return ex.select(*keep, "pos", *_update("_e"))


def read_update_batch(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-1 / SRC-7: every file under ``path`` is one JSON-array payload
    (``.gz`` files are decoded by the reader's codec). Returns (updates,
    verdicts); updates carry the file name as ``batch`` and ``pos``."""
    files = spark.read.option("wholetext", True).text(path) \
        .select(F.col("_metadata.file_path").alias("batch"), F.col("value").alias("payload"))
    return payload_updates(files, keep=["batch"]), \
        payload_verdicts(files).select("batch", "accepted", "n_elements", "reject_reason")


def parse_json_update(payloads: DataFrame, payload_col: str = "payload") -> DataFrame:
    """SRC-2 + SCL-10 + FLT-2: one JSON object per row.

    Adds id, mtype (lower-cased kind), delta, value and ``reject_reason``:
    empty body, malformed/ill-typed JSON (also: not an object), then the
    single-update rule (unknown kind, missing value/delta). Keys match in any
    case; unknown keys are ignored.
    """
    text = F.col(payload_col)
    p = payloads.withColumn("_v", F.try_parse_json(text)).withColumn("_t", F.schema_of_variant("_v")) \
        .withColumn("_plain", F.coalesce(F.col("_t").rlike(_PLAIN), F.lit(False)))
    one = F.get(F.transform(F.transform(F.transform(F.array("_v"), _typed), _spelled), _decode), F.lit(0))
    odd = F.when(~F.col("_plain") & F.col("_t").startswith("OBJECT"), one)
    p = p.withColumn("_odd", odd).withColumn("_d", F.when(F.col("_plain"), F.try_variant_get("_v", "$", _FIELDS))
                                             .otherwise(F.col("_odd.update")))
    # Fields are only decoded from a well-typed object (a failed decode in
    # the reference yields no update at all).
    ok = F.when(F.col("_plain"), ~_infinite(F.col("_d.value"))).otherwise(F.coalesce(F.col("_odd.ok"), F.lit(False)))
    checked = p.withColumn("_ok", ok).withColumn("_d", F.when(F.col("_ok"), F.col("_d")))
    fields = [F.when(F.col("_ok"), f).alias(n) for f, n in zip(_update("_d"), ("id", "type", "delta", "value"))]
    out = checked.select("*", *fields)
    mtype = normalize_kind("type")
    reason = (F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit(EMPTY_BODY))
              .when(~F.col("_ok"), F.lit(MALFORMED_JSON))
              .otherwise(update_reason(mtype, "delta", "value")))
    return out.withColumn("mtype", mtype).withColumn("reject_reason", reason) \
        .drop("type", "_v", "_t", "_plain", "_odd", "_d", "_ok")


def parse_path_update(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """SRC-3: ``/update/{type}/{name}/{value}`` -> mtype, id, raw_value.

    The kind is kept exactly as written (the path endpoint is
    case-sensitive); the value stays text until ``admit_path`` parses it.
    Paths of any other shape get ``reject_reason = 'bad_path'``.
    """
    parts = F.split(F.col(path_col), "/", -1)
    well_formed = (F.size(parts) == 5) & (parts[0] == "") & (parts[1] == "update") \
        & (parts[2] != "") & (parts[3] != "")
    return paths.select(
        "*",
        F.when(well_formed, parts[2]).alias("mtype"),
        F.when(well_formed, parts[3]).alias("id"),
        F.when(well_formed, parts[4]).alias("raw_value"),
        F.when(~well_formed, F.lit(BAD_PATH)).alias("reject_reason"),
    )


def restore_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4: a snapshot -> state (id, mtype, delta, value).

    Two layouts: a directory of JSON-lines parts (written by
    ``save_snapshot``; read in parallel, one record per line) or a single
    JSON-array file (the reference's layout; validated with the batch rule,
    ``null`` = empty). Records assign: a later duplicate of (id, kind) wins,
    by position. Unknown kinds and records without a value are dropped. A
    missing path is an empty state; a malformed file raises.
    """
    from metricfold.sinks.snapshot import is_directory, path_exists  # avoids a cycle
    if not path_exists(spark, path):
        return spark.createDataFrame([], "id string, mtype string, delta bigint, value double")
    # A record's place as one fixed-width number, so that the last one is found
    # by a hash aggregate: part, start of the block and row in it.
    if is_directory(spark, path):
        part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-([0-9]+)", 1).try_cast("bigint")
        row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        place = F.coalesce(part, F.lit(0)).cast("decimal(20,0)") * F.lit(1 << 47).cast("decimal(15,0)") \
            + F.col("_metadata.file_block_start")
        rows = spark.read.schema(UPDATE).option("mode", "FAILFAST").json(path).select(
            "*", (place.cast("decimal(27,0)") * F.lit(1 << 33).cast("decimal(10,0)") + row).alias("_pos"))
    else:  # one file, one document
        files = spark.read.option("wholetext", True).text(path).select(F.col("value").alias("payload"))
        bad = payload_verdicts(files).where(~F.col("accepted"))
        if not bad.isEmpty():
            raise ValueError(f"malformed snapshot: {path}")
        rows = payload_updates(files).withColumn("_pos", F.col("pos"))
    kept = rows.where(((F.col("type") == COUNTER) & F.col("delta").isNotNull())
                      | ((F.col("type") == GAUGE) & F.col("value").isNotNull()))
    return kept.groupBy("id", F.col("type").alias("mtype")).agg(
        F.max_by(F.when(F.col("type") == COUNTER, F.col("delta")), "_pos").alias("delta"),
        F.max_by(F.when(F.col("type") == GAUGE, F.col("value")), "_pos").alias("value"))
