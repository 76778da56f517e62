"""Ratios, number parsing and other arithmetic that must hold under ANSI mode."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column, digits: int = 6) -> Column:
    """Rounded ratio, null unless the denominator is positive."""
    top, bottom = numerator.cast("double"), denominator.cast("double")
    return F.round(F.when(bottom > 0, F.try_divide(top, bottom)), digits)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Ratio that is 0 when the total is 0 or unknown."""
    bottom = denominator.cast("double")
    return F.when(bottom != 0, F.try_divide(numerator.cast("double"), bottom)).otherwise(0.0)


def ratio_or_null(numerator: Column, denominator: Column) -> Column:
    """Plain division that yields null on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def smoothed_ratio(numerator: Column, denominator: Column, top: float = 0.0, bottom: float = 0.0) -> Column:
    """Ratio with a small constant added above and below."""
    return F.try_divide(numerator + F.lit(top), denominator + F.lit(bottom))


def scaled_sum(columns: list[str], divisor: float) -> Column:
    """Sum of scaled columns; one missing part makes the whole missing."""
    return reduce(add, [F.col(c) / F.lit(divisor) for c in columns])


def parse_number(text: Column) -> Column:
    """`1,234.5` to a double, null when it is no number."""
    return F.regexp_replace(F.trim(text), ",", "").try_cast("double")


# Volume suffixes and their multipliers.
VOLUME_SUFFIXES = {"K": 1_000, "M": 1_000_000, "B": 1_000_000_000}


def parse_volume(text: Column) -> Column:
    """`12.5K`, `3M`, `1B` to a double; an empty volume counts as 0."""
    bare = F.regexp_replace(F.trim(F.coalesce(text, F.lit(""))), ",", "")
    number = F.regexp_replace(bare, "[KMB]", "").try_cast("double")
    factor = F.lit(1.0)
    for suffix, multiplier in reversed(VOLUME_SUFFIXES.items()):
        factor = F.when(bare.contains(suffix), float(multiplier)).otherwise(factor)
    return F.when(bare == "", 0.0).otherwise(number * factor)


def parse_percent(text: Column) -> Column:
    """`5.60%` to 5.6."""
    return F.trim(F.regexp_replace(text, "%", "")).try_cast("double")


def flag(condition: Column) -> Column:
    """1 when the condition holds, else 0 (also for an unknown condition)."""
    return F.when(condition, 1).otherwise(0)


def present(column: Column) -> Column:
    return column.isNotNull().cast("int")


def in_range(column: Column, low: float | None, high: float | None,
             low_closed: bool = True, high_closed: bool = False) -> Column:
    """Interval test with open or closed ends; a missing end is unbounded."""
    test = F.lit(True)
    if low is not None:
        test = test & ((column >= low) if low_closed else (column > low))
    if high is not None:
        test = test & ((column <= high) if high_closed else (column < high))
    return test
