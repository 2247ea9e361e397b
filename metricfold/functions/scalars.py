"""Row-level scalar functions (Column -> Column), all of them Spark built-ins.
The exact texts of doubles are worked out in ``functions.decimals``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metricfold.functions import decimals as dec
from metricfold.schemas import COUNTER, GAUGE, KINDS

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- kinds ----
def is_valid_kind(kind: ColumnOrName) -> Column:
    """FLT-1: exactly 'gauge' or 'counter' (case-sensitive, NULL -> false)."""
    return F.coalesce(_c(kind).isin(*KINDS), F.lit(False))


def normalize_kind(kind: ColumnOrName) -> Column:
    """SCL-1: the JSON endpoints lower-case the kind before checking it."""
    return F.lower(_c(kind))


# -------------------------------------------------------------- parsing ----
# Go strconv.ParseInt(s, 10, 64): optional sign, decimal digits, nothing else.
INT_TEXT = r"^[+-]?[0-9]+$"
# Go strconv.ParseFloat(s, 64) decimal and hexadecimal literal forms.
DEC_FLOAT_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
HEX_FLOAT_TEXT = r"^[+-]?0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+$"
INF_TEXT = r"^(?i)[+-]?(inf|infinity)$"
NAN_TEXT = r"^(?i)nan$"


def parse_counter(text: ColumnOrName) -> Column:
    """SCL-2: strict base-10 int64; anything else (blanks, 42.7, 1e3,
    overflow) is NULL. The regex guard stops Spark's lenient trimming."""
    t = _c(text)
    return F.when(t.rlike(INT_TEXT), _try_cast(t, "bigint"))


def _try_cast(col: Column, type_name: str) -> Column:
    # Column.try_cast exists from Spark 4.0.
    return col.try_cast(type_name)


def parse_gauge(text: ColumnOrName) -> Column:
    """SCL-3: float64 text incl. NaN/Inf spellings; finite-looking text whose
    value overflows to infinity is rejected (Go reports a range error)."""
    t = _c(text)
    num = _try_cast(t, "double")
    neg = t.startswith("-")
    return (
        F.when(t.rlike(INF_TEXT), F.when(neg, F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
        .when(t.rlike(NAN_TEXT), F.lit(float("nan")))
        .when((t.rlike(DEC_FLOAT_TEXT) | t.rlike(HEX_FLOAT_TEXT)) & ~F.abs(num).eqNullSafe(F.lit(float("inf"))), num)
    )


# ------------------------------------------------------------ signatures ---
def sign_payload(payload: ColumnOrName, key: str) -> Column:
    """SCL-6: lower-hex SHA-256 of key ++ payload (a prefix hash, not HMAC)."""
    return F.sha2(F.concat(F.lit(key), _c(payload)), 256)


def verify_signature(payload: ColumnOrName, sig: ColumnOrName, key: str) -> Column:
    """SCL-7: exact (case-sensitive) equality of the hex digests; NULL -> false."""
    return F.coalesce(sign_payload(payload, key) == _c(sig), F.lit(False))


# ----------------------------------------------------------------- time ----
def unix_millis(ts: ColumnOrName) -> Column:
    """SCL-8: Unix milliseconds, floored, of a (naive, UTC) timestamp."""
    return F.unix_millis(_c(ts).cast("timestamp"))


# ------------------------------------------------------------ formatting ---
def shortest_text(value: ColumnOrName) -> Column:
    """SCL-4 for gauges: shortest text without exponent (+Inf/-Inf/NaN)."""
    return dec.shortest(_c(value))


def fixed_text(value: ColumnOrName, decimals: int = 6) -> Column:
    """SCL-5: fixed-point text with ``decimals`` places (Go %f / %.2f), the
    exact binary value rounded half to even."""
    return dec.fixed(_c(value), decimals)


def value_text(mtype: ColumnOrName, delta: ColumnOrName, value: ColumnOrName) -> Column:
    """SCL-4: counter -> decimal integer text, gauge -> shortest float text."""
    return F.when(_c(mtype) == COUNTER, _c(delta).cast("string")) \
        .when(_c(mtype) == GAUGE, shortest_text(value))


def listing_line(id_: ColumnOrName, mtype: ColumnOrName, delta: ColumnOrName,
                 value: ColumnOrName, decimals: int = 6) -> Column:
    """SCL-11: one ``id = value`` line per metric (counters as integers,
    gauges fixed-point with ``decimals`` places: 6 memory form, 2 table form)."""
    text = F.when(_c(mtype) == COUNTER, _c(delta).cast("string")) \
        .otherwise(fixed_text(value, decimals))
    return F.concat(_c(id_), F.lit(" = "), text)


def encode_update(id_: ColumnOrName = "id", kind: ColumnOrName = "type",
                  delta: ColumnOrName = "delta", value: ColumnOrName = "value",
                  hash_: ColumnOrName | None = None) -> Column:
    """SCL-9: one update as a JSON object; NULL delta/value/hash are omitted.
    A gauge that is not finite has no JSON form and raises, as in the reference."""
    v = _c(value).cast("double")
    finite = F.when(F.isnan(v) | (F.abs(v) == float("inf")),
                    F.raise_error(F.lit("a gauge that is not finite cannot be encoded")).cast("double")).otherwise(v)
    fields = [_c(id_).alias("id"), _c(kind).alias("type"), _c(delta).alias("delta"),
              finite.alias("value")]
    if hash_ is not None:
        fields.append(F.nullif(_c(hash_), F.lit("")).alias("hash"))
    return F.to_json(F.struct(*fields))
