"""Exact decimal texts of doubles as column expressions.

``fixed`` gives C's and Go's ``%.Nf`` (the exact binary value, rounded half to
even) and ``shortest`` the shortest digits that read back as the same value,
without an exponent. Both are built-ins only.

A double below 2**63 is a whole number and a fraction with at most 75 binary
places that matter, held in three limbs of 25 bits; times a power of ten, the
limbs give the digits and what is left over, so ties are seen exactly. Larger
doubles are whole: their digits come from repeated multiplication of limbs of
nine decimal digits, an expression that only such values evaluate.

The JVM's own text of a double reads back, but (before Java 19) is not always
shortest. Up to 15 digits it must be, as no two decimals of 15 digits are one
normal double. Beyond that (and below the normal range) the exact digits are worked
out the same way, and of each length the nearest decimal, then the one on the
other side, is read back; the shortest that reads back is taken.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_PLACES = 6  # below 2**-22 a value is under half of the last place
_BITS, _MASK = 25, (1 << 25) - 1
_STEP, _LIMB = 29, 10 ** 9
_NORMAL = 2.2250738585072014e-308


def _split(f: Column) -> list[Column]:
    """A fraction's first 75 binary places in three whole limbs."""
    out = []
    for _ in range(3):
        f = f * float(1 << _BITS)
        limb = F.floor(f)
        out.append(limb)
        f = f - limb.cast("double")
    return out


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, whatever body does with it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _div(a: Column, b) -> Column:
    """The whole quotient of two whole numbers."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b).cast("bigint"))


def _times(limbs: Column, by: Column) -> Column:
    """Limbs of nine decimal digits, lowest first, times a number below 10**9."""
    def one(acc: Column, x: Column) -> Column:
        t = x * by + acc["carry"]
        return F.struct(_div(t, _LIMB).alias("carry"), F.concat(acc["limbs"], F.array(t % _LIMB)).alias("limbs"))

    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("limbs"))
    return F.aggregate(limbs, start, one, lambda s: F.concat(s["limbs"], F.array(s["carry"])))


def _power_digits(m: Column, base: int, k: Column, step: int) -> Column:
    """The digits of a whole number times a power of a base, ``step`` of its
    factors at a time."""
    limbs = F.array(m % _LIMB, _div(m, _LIMB) % _LIMB, _div(m, _LIMB ** 2))
    full = F.aggregate(F.when(k > 0, F.sequence(F.lit(0), F.floor((k - 1) / step).cast("int"))).otherwise(F.array().cast("array<int>")), limbs,
                       lambda x, i: _times(x, F.pow(F.lit(float(base)), F.least(F.lit(step), k - i * step)).cast("bigint")))
    return F.ltrim(F.array_join(F.transform(F.reverse(full), lambda x: F.lpad(x.cast("string"), 9, "0")), ""), F.lit("0"))


def _whole_digits(a: Column) -> Column:
    """The digits of a double of 2**63 or more."""
    k = F.floor(F.log2(a)).cast("int") - 60
    return _power_digits((a * F.pow(F.lit(2.0), -k)).cast("bigint"), 2, k, _STEP)


def _exact(a: Column) -> Column:
    """A finite double above 0 as exact digits and the power of ten of the last."""
    k = F.greatest(F.lit(0), F.least(F.lit(1074), 60 - F.floor(F.log2(a)).cast("int")))
    half = F.floor(k / 2).cast("int")
    m = (a * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), k - half)).cast("bigint")
    return F.when(a >= float(1 << 63), F.struct(_whole_digits(a).alias("digits"), F.lit(0).alias("at"))) \
        .otherwise(F.struct(_power_digits(m, 5, k, 12).alias("digits"), (-k).alias("at")))


def _special(v: Column) -> Column:
    return F.when(F.isnan(v), F.lit("NaN")).when(v == float("inf"), F.lit("+Inf")).when(v == float("-inf"), F.lit("-Inf"))


def _minus(v: Column) -> Column:
    return F.when(v.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))


def fixed(v: Column, places: int) -> Column:
    """``%.{places}f`` of a double, for up to six places."""
    if not 0 <= places <= MAX_PLACES:
        raise ValueError(f"fixed-point texts have 0 to {MAX_PLACES} places")
    a = F.abs(v)
    whole = F.floor(a)
    x = [limb * (10 ** places) for limb in _split(a - whole.cast("double"))]
    x[1] = x[1] + F.shiftright(x[2], _BITS)
    x[0] = x[0] + F.shiftright(x[1], _BITS)
    digits = F.shiftright(x[0], _BITS)
    top, lower = x[0].bitwiseAND(_MASK), x[1].bitwiseAND(_MASK).bitwiseOR(x[2].bitwiseAND(_MASK))
    half = 1 << (_BITS - 1)
    last = digits if places else whole
    up = (top > half) | ((top == half) & ((lower > 0) | (last % 2 == 1)))
    digits = digits + F.when(up, 1).otherwise(0)
    full = digits >= 10 ** places
    whole_text = (whole + F.when(full, 1).otherwise(0)).cast("string")
    tail = F.lpad(F.when(full, 0).otherwise(digits).cast("string"), places, "0")
    small = F.concat(_minus(v), whole_text, F.lit("."), tail) if places else F.concat(_minus(v), whole_text)
    big = F.concat(_minus(v), _whole_digits(a), F.lit("." + "0" * places if places else ""))
    return F.when(a < float(1 << 63), small).otherwise(F.coalesce(_special(v), F.when(v.isNotNull(), big)))


def _plain(digits: Column, power: Column) -> Column:
    """digits times ten to a power, written without exponent."""
    n = F.length(digits)
    return F.when(power >= 0, F.concat(digits, F.repeat(F.lit("0"), power))) \
        .when(n + power > 0, F.concat(F.substring(digits, F.lit(1), n + power), F.lit("."),
                                      F.substring(digits, n + power + 1, -power))) \
        .otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - n), digits))


def _shortest_long(a: Column, text: Column) -> Column:
    """The shortest text of a finite value above 0 whose own text is long or
    has an exponent."""
    mantissa = F.substring_index(text, "E", 1)
    power = F.when(text.contains("E"), F.substring_index(text, "E", -1).try_cast("int")).otherwise(0)
    written = F.ltrim(F.replace(mantissa, F.lit("."), F.lit("")), F.lit("0"))
    own = F.rtrim(written, F.lit("0"))
    at = power - F.length(F.substring_index(mantissa, ".", -1)) + F.length(written) - F.length(own)

    def search(x: Column, most: Column) -> Column:
        def of_length(n: Column) -> Column:  # the decimal of n digits that reads back, if any
            low = F.substring(x["digits"], F.lit(1), n).cast("bigint")
            rest = F.rtrim(F.substring(x["digits"], n + 1, F.length(x["digits"])), F.lit("0"))
            up = (rest > "5") | ((rest == "5") & (low % 2 == 1))
            last = x["at"] + F.greatest(F.length(x["digits"]) - n, F.lit(0))
            both = F.array(F.when(up, low + 1).otherwise(low), F.when(up, low).otherwise(low + 1))
            back = F.filter(both, lambda c: F.concat(c.cast("string"), F.lit("E"), last.cast("string")).try_cast("double") == a)
            return F.struct(F.get(back, F.lit(0)).cast("string").alias("digits"), last.alias("at"))

        def plain(o: Column) -> Column:
            bare = F.rtrim(o["digits"], F.lit("0"))
            return _plain(bare, o["at"] + F.length(o["digits"]) - F.length(bare))

        shorter = F.filter(F.transform(F.sequence(F.lit(1), most - 1), of_length), lambda o: o["digits"].isNotNull())
        longest = (most == 1) | of_length(most - 1)["digits"].isNull()
        return F.when(longest, _let(of_length(most), plain)).otherwise(_let(F.get(shorter, F.lit(0)), plain))

    sure = (F.length(own) <= 15) & (a >= _NORMAL)
    return F.when(sure, _plain(own, at)).otherwise(_let(_exact(a), lambda x: search(x, F.length(own))))


def shortest(v: Column) -> Column:
    """The shortest text that reads back as ``v``, without exponent."""
    text = v.cast("string")
    easy = ~text.contains("E") & (F.length(text) <= 16)  # 15 digits and the point at most
    own = F.when(text.endswith(".0"), F.substring(text, F.lit(1), F.length(text) - 2)).otherwise(text)
    hard = F.concat(_minus(v), _shortest_long(F.abs(v), F.abs(v).cast("string")))
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), _special(v)).when(easy, own).otherwise(
        F.when(v.isNotNull(), hard))
