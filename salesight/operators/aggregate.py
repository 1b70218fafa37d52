"""Group counts, KPI aggregates, contingency tables and dominant values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import margin_pct, ratio, round2
from .cube import KpiCube, kpi_sums


def group_counts(df: DataFrame, keys: Sequence[str], out: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def value_counts(df: DataFrame, cols: Sequence[str], n: int | None = None) -> DataFrame:
    """Rows per value (as text) of each column, largest first, for all columns in one scan.

    ``n`` keeps the first values of every column; Spark drops the others before it
    shuffles the counts by column.
    """
    counts = (
        df.select(*[F.col(c).cast("string").alias(c) for c in cols])
        .unpivot([], list(cols), "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    if n is not None:
        best = Window.partitionBy("column_name").orderBy(F.desc("row_count"), "value")
        counts = counts.withColumn("_place", F.row_number().over(best))
        counts = counts.where(F.col("_place") <= n).drop("_place")
    return counts.orderBy("column_name", F.desc("row_count"), "value")


def group_kpis(sales: DataFrame | KpiCube, keys: Sequence[str]) -> DataFrame:
    """Counts, unrounded sums and margin of sums per key tuple, of rows or of a cube."""
    if isinstance(sales, KpiCube):
        sums = sales.sums(keys)
    else:
        sums = sales.groupBy(*keys).agg(*kpi_sums())
    return sums.withColumn("profit_margin_pct", margin_pct("total_profit", "total_revenue"))


def order_averages(kpis: DataFrame) -> DataFrame:
    """Revenue and profit per order, as ratios of sums."""
    return kpis.withColumns(
        {
            "avg_order_value": ratio(F.col("total_revenue"), F.col("order_count")),
            "profit_per_order": ratio(F.col("total_profit"), F.col("order_count")),
        }
    )


def group_sum(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(column).alias(out))


def rounded(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Round report measures to two decimals (rounding is always the last step)."""
    return df.withColumns({c: round2(F.col(c)) for c in cols})


def group_profile(
    df: DataFrame, key: str, averages: Mapping[str, str], count: str = "order_count"
) -> DataFrame:
    """Row count and rounded means per group; ``averages`` maps output to input."""
    means = [round2(F.avg(F.col(c).cast("double"))).alias(out) for out, c in averages.items()]
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count), *means)


def crosstab_counts(df: DataFrame, a: str, b: str, out: str = "cnt") -> DataFrame:
    """Rows per pair of values, in long form."""
    return group_counts(df, [a, b], out)


def dominant_value(
    df: DataFrame,
    group: str,
    value: str,
    out: str | None = None,
    out_count: str | None = None,
) -> DataFrame:
    """The most frequent value of each group, ties to the smallest value.

    The winner is a minimum over (-count, value), which combines before the
    shuffle, where a ranking window would sort each group in one task.
    """
    out = out or f"dominant_{value}"
    out_count = out_count or f"{out}_count"
    best = F.min(F.struct((-F.col("cnt")).alias("less"), F.col(value).alias("value")))
    return (
        crosstab_counts(df, group, value)
        .groupBy(group)
        .agg(best.alias("best"))
        .select(group, F.col("best.value").alias(out), (-F.col("best.less")).alias(out_count))
    )


def profile_with_dominant(profile: DataFrame, dominant: DataFrame, key: str) -> DataFrame:
    """Left join on the group key; the key appears once."""
    return profile.join(dominant, key, "left")
