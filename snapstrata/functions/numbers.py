"""Null-aware numeric expressions. A bad value becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Rounded quotient; null when either side is null or the divisor is 0."""
    return F.round(F.try_divide(numerator.cast("double"), denominator), digits)


def percent_to_fraction(text: Column) -> Column:
    """``89%`` to 0.89; blank, null or unreadable text to null."""
    return F.translate(F.trim(text), "%", "").try_cast("double") / F.lit(100)


def ratio_part(text: Column, index: int) -> Column:
    """Integer before (0) or after (1) the slash of ``W/P``."""
    return F.get(F.split(text, "/"), F.lit(index)).try_cast("int")


def exact_sum(value: Column) -> Column:
    """Sum of a double as decimal, so the result does not depend on row order."""
    return F.sum(value.try_cast("decimal(18,4)"))


def weighted_sums(value: Column, weight: Column) -> tuple[Column, Column]:
    """Numerator and denominator of a weighted mean over rows having both.

    Values count as decimals of 8 places. NaN, infinite values and those from 1e16 on
    are left out of both sums.
    """
    exact = value.try_cast("decimal(24,8)")
    both = exact.isNotNull() & weight.isNotNull()
    return F.sum(F.when(both, exact * weight)), F.sum(F.when(both, weight.cast("bigint")))


def quotient(numerator: Column, denominator: Column) -> Column:
    """Unrounded quotient of two aggregates; null when the divisor is 0 or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def weighted_mean(value: Column, weight: Column) -> Column:
    top, bottom = weighted_sums(value, weight)
    return quotient(top, bottom)
