"""Arithmetic that stays legal under ANSI mode."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_or_null(c) -> Column:
    """Text to double; missing, the text ``null`` and anything unreadable give null."""
    return F.col(c).try_cast("double")


def filled(c, value) -> Column:
    value = value if isinstance(value, Column) else F.lit(value)
    return F.coalesce(F.col(c), value)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``; 0 for a zero denominator, null if a part is missing."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(F.try_divide(numerator, denominator))


def rescaled(value: Column, low: Column, high: Column) -> Column:
    """Position between low and high as 0..1; null when all values are equal."""
    return F.try_divide(value - low, high - low)
