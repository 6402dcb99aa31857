"""Arithmetic that never fails on bad data: a zero base or an unreadable text is NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _double(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def round_to(c: Column, digits: int | None) -> Column:
    """Half-up rounding on the decimal text of the double; ``None`` leaves it alone."""
    return c if digits is None else F.round(c, digits)


def ratio(num: Column | str, den: Column | str, scale: float = 1) -> Column:
    """``num / den * scale``; the operand order decides the last rounded digit."""
    quotient = F.try_divide(_double(num), _double(den))
    return quotient if scale == 1 else quotient * F.lit(scale)


def product(a: Column | str, b: Column | str, divisor: float = 1) -> Column:
    """``a * b / divisor`` with a constant divisor."""
    value = _double(a) * _double(b)
    return value if divisor == 1 else value / F.lit(divisor)


def growth(current: Column | str, previous: Column | str, scale: float = 100) -> Column:
    """``(current - previous) / previous * scale``; a negative base keeps its sign."""
    now, before = _double(current), _double(previous)
    return F.try_divide(now - before, before) * F.lit(scale)


def percent_of(part: Column | str, whole: Column | str, minus: Column | str) -> Column:
    """``(part - minus) / whole * 100``."""
    return F.try_divide(_double(part) - _double(minus), _double(whole)) * F.lit(100)


def parse_number(c: Column | str) -> Column:
    """Text to double: thousands separators and percent signs go, unreadable is NULL."""
    text = F.col(c) if isinstance(c, str) else c
    plain = F.replace(F.replace(text, F.lit(","), F.lit("")), F.lit("%"), F.lit(""))
    return plain.try_cast("double")


#: Below this many units, a double is a decimal of the scale exactly if it is the double
#: nearest to its whole number of units; decimals of 15 digits differ as doubles.
_SURE = 1e15
#: Units are summed in two halves, whose sums can't leave 64 bits.
_LOW_BITS = 25


def exact_sums(value: Column, scale: int | None, sign: Column | None = None) -> tuple[Column, Column]:
    """Aggregates: the sum of the values that are decimals of ``scale`` places, times
    ``sign``, in decimals, and how many are none.

    Values with more places, or too large, are none; without ``scale`` all are.  The sum is
    NULL where it has no values or doesn't fit.
    """
    if scale is None:
        return F.sum(F.lit(None).cast("decimal(28,0)")), F.sum(F.when(value.isNotNull(), 1).otherwise(0))
    signed = (lambda c: c) if sign is None else (lambda c: c * sign)
    exact = value.try_cast(f"decimal(28,{scale})")
    same = F.coalesce(exact.cast("double") == value, F.lit(False))
    if scale > 6:  # a sum of two decimals of 38 digits keeps six places
        known = same | value.isNull()
        return F.sum(signed(F.when(known, exact))), F.sum(F.when(known, 0).otherwise(1))
    # most values are small: whole numbers of units, without a decimal per row
    one = float(10**scale)
    sure = F.abs(value) < F.lit(_SURE / one)
    units = F.rint(value * F.lit(one))
    whole = signed(F.when(sure & (units / F.lit(one) == value), units.cast("bigint")))
    high = F.sum(F.shiftright(whole, _LOW_BITS)).cast("decimal(19,0)")
    low = F.sum(whole.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast("decimal(19,0)")
    unit = F.lit(f"{10**-scale:.{scale}f}").cast(f"decimal({max(scale, 1)},{scale})")
    small = ((high * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + low) * unit).cast(f"decimal(38,{scale})")
    large = F.sum(signed(F.when(~sure & same, exact))).try_cast(f"decimal(38,{scale})")
    known = F.when(sure, units / F.lit(one) == value).otherwise(same) | value.isNull()
    return F.coalesce(F.try_add(small, large), small, large), F.sum(F.when(known, 0).otherwise(1))


def decimal_mean(c: Column | str, scale: int | None = None) -> Column:
    """Mean of a measure.

    ``scale=None`` is the plain floating mean, whose last bits depend on the order partial
    sums arrive in.  With ``scale`` the sum is taken in decimals of that many places if
    every value is one (same answer on every run and every cluster size), else as floats.
    """
    value = (F.col(c) if isinstance(c, str) else c).cast("double")
    if scale is None:
        return F.avg(value)
    exact, inexact = exact_sums(value, scale)
    total = F.when(inexact == 0, exact.cast("double")).otherwise(F.sum(value))
    return F.try_divide(total, F.count(value).cast("double"))
