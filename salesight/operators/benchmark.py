"""Compare groups with figures of the whole: benchmarks and shares of a total.

The figures are one row by construction (an aggregate without keys) and enter the
plan as scalar subqueries, so no join is planned. The input is read for the groups
and for the figures: stage it when it is expensive.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import percent, ratio


def with_benchmark(df: DataFrame, figures: Mapping[str, Column]) -> DataFrame:
    """Add aggregates over all rows of ``df`` as constant columns."""
    whole = df.agg(F.struct(*[value.alias(name) for name, value in figures.items()]).alias("b"))
    return (
        df.withColumn("_benchmark", whole.scalar())
        .select(*df.columns, *[F.col("_benchmark")[name].alias(name) for name in figures])
    )


def with_shares(df: DataFrame, shares: Mapping[str, str]) -> DataFrame:
    """Percentage of the column total; ``shares`` maps output to measure."""
    totals = {f"_total_{out}": F.sum(measure) for out, measure in shares.items()}
    both = with_benchmark(df, totals)
    parts = {out: percent(F.col(m), F.col(f"_total_{out}")) for out, m in shares.items()}
    return both.withColumns(parts).drop(*totals)


def mean_of(column: str) -> Column:
    """Unweighted mean over groups, in double (a decimal average would be cut)."""
    return ratio(F.sum(column), F.count(column))


def overall_margin(profit: str = "total_profit", revenue: str = "total_revenue") -> Column:
    """Margin of the summed sums, that is weighted by revenue."""
    return percent(F.sum(profit), F.sum(revenue))
