"""Numeric column expressions shared by every operator.

Money columns may be double or decimal. Sums stay in the input type (decimal
sums are exact, so they do not depend on task order); ratios are taken in double.
Division is ``try_divide``: a zero denominator gives NULL, under ANSI mode too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator) * F.lit(100.0)


def round2(value: Column) -> Column:
    """Two decimals as double; decimals are rounded before the conversion."""
    return F.round(value, 2).cast("double")


def margin_pct(profit: str = "profit", revenue: str = "revenue") -> Column:
    """Profit as a percentage of revenue, unrounded."""
    return percent(F.col(profit), F.col(revenue))


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds (0, not NULL, on empty input)."""
    return F.count_if(condition)
