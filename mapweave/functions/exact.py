"""Exact tests on numbers, as Column expressions."""

from __future__ import annotations

import math
from decimal import ROUND_CEILING, ROUND_FLOOR, Context, Decimal

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the JSON number grammar.
NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the
    body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def number_parts(text: Column) -> Column:
    """Normal form of a decimal text: ``STRUCT<negative, digits, exponent>``
    with value = digits * 10^exponent, no leading or trailing zero digits.
    Two texts denote the same number exactly when their parts are equal.
    """

    def split(t):
        whole = F.regexp_extract(t, r"^-?([0-9]+)", 1)
        fraction = F.regexp_extract(t, r"\.([0-9]+)", 1)
        power = F.coalesce(F.regexp_extract(t, r"[eE]([+-]?[0-9]+)$", 1).try_cast("long"), F.lit(0))
        return F.struct(
            t.startswith("-").alias("minus"),
            F.regexp_replace(F.concat(whole, fraction), "^0+", "").alias("digits"),
            (power - F.length(fraction)).alias("power"),
        )

    def normal(p):
        kept = F.regexp_replace(p["digits"], "0+$", "")
        zero = p["digits"] == ""
        exponent = p["power"] + F.length(p["digits"]) - F.length(kept)
        return F.struct(
            (p["minus"] & ~zero).alias("negative"),
            kept.alias("digits"),
            F.when(zero, 0).otherwise(exponent).cast("long").alias("exponent"),
        )

    return let(F.when(text.rlike(NUMBER), text), lambda t: F.when(t.isNotNull(), let(split(t), normal)))


def exact_long(text: Column) -> Column:
    """The 64-bit integer a decimal text denotes, NULL when it is not one."""

    def whole(p):
        zeros = F.when(p["exponent"].between(0, 19), F.repeat(F.lit("0"), p["exponent"].cast("int")))
        plain = F.concat(F.when(p["negative"], "-").otherwise(""), p["digits"], zeros)
        return F.when(p["digits"] == "", F.lit(0).cast("long")).otherwise(plain.try_cast("long"))

    return let(number_parts(text), whole)


def _same_number(text: Column, value: Column) -> Column:
    """The value when its text denotes the same number, else NULL."""
    return let(
        F.struct(text.alias("t"), value.alias("v")),
        lambda p: F.when(number_parts(p["v"].cast("string")) == number_parts(p["t"]), p["v"]),
    )


def exact_double(text: Column) -> Column:
    """The double whose shortest text denotes the same number, else NULL."""
    return _same_number(text, text.try_cast("double"))


def exact_decimal(text: Column, precision: int = 38, scale: int = 18) -> Column:
    """The decimal when it holds the number without rounding, else NULL."""
    return _same_number(text, text.try_cast(f"decimal({precision},{scale})"))


def fits_integer(value: Column, low: int, high: int) -> Column:
    """Numeric value as an exact integer of a range, else NULL."""
    limits = [F.lit(v).cast("decimal(38,0)") for v in (low, high)]
    return let(
        value.try_cast("decimal(38,18)"),
        lambda n: F.when((n % 1 == 0) & n.between(*limits), n.try_cast("long")),
    )


def _rank(p):
    """Order of the magnitude: power of the leading digit, then the digits."""
    zero = p["digits"] == ""
    power = F.when(zero, F.lit(-(2**62))).otherwise(p["exponent"] + F.length(p["digits"]))
    return F.struct(power.alias("power"), p["digits"].alias("digits"))


def _compared(p):
    a, b = p["a"], p["b"]
    both = F.when(a["negative"], _rank(b) >= _rank(a)).otherwise(_rank(a) >= _rank(b))
    return F.when(a.isNotNull() & b.isNotNull(), F.when(a["negative"] == b["negative"], both).otherwise(b["negative"]))


def _literal_parts(number: Decimal) -> Column:
    """:func:`number_parts` of a number known when the query is made."""
    sign, digits, power = number.as_tuple()
    text = "".join(map(str, digits)).lstrip("0")
    kept = text.rstrip("0")
    exponent = power + len(text) - len(kept) if text else 0
    return F.struct(F.lit(bool(sign and text)).alias("negative"), F.lit(kept).alias("digits"), F.lit(exponent).cast("long").alias("exponent"))


def _nearest_float(number: Decimal, up: bool, single: bool) -> float:
    """The first floating value, from above (or below) on, whose shortest decimal
    text is on the asked side of ``number``; infinite if there is none."""
    kind = np.float32 if single else np.float64
    toward = kind(math.inf if up else -math.inf)
    with np.errstate(over="ignore"):
        value = kind(float(number))
        # two steps back, then forward to the first that fits
        value = np.nextafter(np.nextafter(value, -toward), -toward)
        while np.isfinite(value) and (Decimal(str(value)) < number if up else Decimal(str(value)) > number):
            value = np.nextafter(value, toward)
    return float(value)


def _integral(number: Decimal, places: int, up: bool) -> int:
    """``number * 10**places`` as the next integer above (below)."""
    wide = Context(prec=max(60, len(number.as_tuple().digits) + abs(number.as_tuple().exponent) + places + 2))
    return int(number.scaleb(places, wide).to_integral_value(ROUND_CEILING if up else ROUND_FLOOR, wide))


def _side(value: Column, kind: T.DataType, number: Decimal, low: bool) -> Column | bool:
    """Whether a numeric value is not below (or not above) a bound; True or False
    where the type alone settles it."""
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        single = isinstance(kind, T.FloatType)
        edge = _nearest_float(number, low, single)
        if math.isinf(edge):
            # beyond the type: no finite value reaches it, or every one does
            most = float(np.finfo(np.float32 if single else np.float64).max)
            if (edge > 0) == low:
                return False
            edge = -most if low else most
        bound = F.lit(edge).cast(kind)
        return value >= bound if low else (value <= bound) & ~F.isnan(value)
    places = kind.scale if isinstance(kind, T.DecimalType) else 0
    # a bound far beyond the type is settled by its sign
    if number and abs(number.adjusted()) > 60:
        if number.adjusted() > 0:
            return (number < 0) == low
        edge = int(low and number > 0) - int(not low and number < 0)
    else:
        edge = _integral(number, places, low)
    most = 10**kind.precision - 1 if isinstance(kind, T.DecimalType) else 2 ** ({T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32}.get(type(kind), 64) - 1) - 1
    if edge > most or edge < -most - 1:
        return (edge < 0) == low
    if isinstance(kind, T.DecimalType):
        bound = F.lit(str(Decimal(edge).scaleb(-places, Context(prec=60)))).cast(f"decimal(38,{places})")
    else:
        bound = F.lit(edge).cast("long")
    return value >= bound if low else value <= bound


def outside_range(value: Column, kind: T.DataType, low: str, high: str) -> Column:
    """Whether a value is not NULL and outside two decimal bounds, which belong
    to the range.

    Numbers are compared in their own type with the next value of that type on
    the safe side of the bound: a floating value stands for its shortest text.
    Texts are compared digit by digit, as exact numbers of any size, and are
    outside when they are no number; so is a value of any other type.
    """
    ends = Decimal(low), Decimal(high)
    if isinstance(kind, T.NumericType):
        sides = [_side(value, kind, ends[0], True), _side(value, kind, ends[1], False)]
        if False in [s for s in sides if isinstance(s, bool)]:
            return value.isNotNull()
        inside = [s for s in sides if not isinstance(s, bool)]
        within = inside[0] & inside[1] if len(inside) == 2 else inside[0] if inside else F.lit(True)
        if len(inside) < 2 and isinstance(kind, (T.FloatType, T.DoubleType)):
            within = within & ~F.isnan(value) & (F.abs(value) != float("inf"))
        return value.isNotNull() & ~within

    def within(parts):
        first, last = (F.struct(a.alias("a"), b.alias("b")) for a, b in ((parts, _literal_parts(ends[0])), (_literal_parts(ends[1]), parts)))
        return F.coalesce(let(first, _compared) & let(last, _compared), F.lit(False))

    return value.isNotNull() & ~let(number_parts(value.cast("string")), within)


def plain_text(value: Column) -> Column:
    """Shortest decimal text of a double, without an exponent."""

    def spell(p):
        digits, exponent = p["digits"], p["exponent"]
        whole = F.concat(digits, F.repeat(F.lit("0"), F.greatest(exponent, F.lit(0)).cast("int")))
        padded = F.lpad(digits, F.greatest(F.length(digits), (1 - exponent).cast("int")), "0")
        point = (F.length(padded) + exponent).cast("int")
        parts = F.concat(F.substring(padded, 1, 0 + point), F.lit("."), F.substring(padded, point + 1, F.length(padded)))
        text = F.when(digits == "", "0").when(exponent >= 0, whole).otherwise(parts)
        return F.concat(F.when(p["negative"], "-").otherwise(""), text)

    return let(number_parts(value.cast("string")), spell)
