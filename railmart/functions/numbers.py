"""Numeric expressions with explicit null and zero rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a finite number becomes NULL."""
    n = c.cast("string").try_cast("double")
    return F.when(F.isnan(n) | (F.abs(n) == float("inf")), F.lit(None)).otherwise(n)


def non_negative(c: Column) -> Column:
    return F.when(c >= 0, c)


def within(c: Column, low: float, high: float) -> Column:
    return F.when(c.between(low, high), c)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def ratio(num: Column, den: Column, times: int = 1) -> Column:
    """``num / den * times`` in double; NULL when ``den`` is 0 or NULL."""
    top = num.cast("double")
    return F.try_divide(top if times == 1 else top * times, den.cast("double"))


def rounded_ratio(num: Column, den: Column, scale: int, times: int = 1) -> Column:
    """``ratio`` rounded half away from zero. One division of whole numbers keeps ties exact."""
    return F.round(ratio(num, den, times), scale)


def rounded_mean(total: Column, n: Column, scale: int = 2, decimals: int = 0) -> Column:
    """Mean from a sum and a count. ``decimals`` are the places of the summed column, shifted out to divide whole numbers."""
    shift = 10**decimals
    return rounded_ratio(total * shift, n * shift, scale)


def divide_or_zero(num: Column, den: Column) -> Column:
    """BI style division: 0 where there is nothing to divide by, blank numerators count as blank."""
    return F.coalesce(ratio(num, den), F.lit(0.0))
