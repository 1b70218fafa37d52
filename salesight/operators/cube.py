"""An additive cube of KPIs: the sales table is read once, every report re-aggregates.

Counts and sums add up, so a few fine groupings give all coarser ones. One scan groups
by all of them together (GROUPING SETS, combined before the shuffle) and writes one
folder per grouping; a report reads the folder with the fewest keys that holds its own.
Margins, shares and ranks are not additive and are taken from the sums afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import PRICE_CUTS
from .prepare import with_price_tier

SUMS = ("order_count", "total_quantity", "total_revenue", "total_profit")
LEVELS = {
    "product": ("product_name", "category", "region"),
    "sub_category": ("sub_category", "category"),
    "state": ("state", "region"),
    "month": ("order_year_month",),
    "price_tier": ("price_tier",),
}


def kpi_sums() -> list[Column]:
    """Row count and unrounded sums of a group of sales rows."""
    return [
        F.count(F.lit(1)).alias("order_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("profit").alias("total_profit"),
    ]


@dataclass(frozen=True)
class KpiCube:
    """A written cube; reports take it in place of the sales table."""

    frame: DataFrame
    levels: Mapping[str, Sequence[str]]
    cuts: tuple[float, ...]

    def sums(self, keys: Sequence[str]) -> DataFrame:
        """Counts and sums by ``keys``, from the smallest grouping that has them."""
        fitting = [name for name, cols in self.levels.items() if set(keys) <= set(cols)]
        if not fitting:
            raise ValueError(f"no level of the cube holds {list(keys)}")
        level = min(fitting, key=lambda name: len(self.levels[name]))
        rows = self.frame.where(F.col("level") == level)
        if set(keys) == set(self.levels[level]):
            return rows.select(*keys, *SUMS)
        parts = [F.sum(c).alias(c) for c in SUMS[1:]]
        count = F.coalesce(F.sum("order_count"), F.lit(0)).alias("order_count")
        return rows.groupBy(*keys).agg(count, *parts)


def build_cube(
    sales: DataFrame,
    cuts: Sequence[float] = PRICE_CUTS,
    levels: Mapping[str, Sequence[str]] = LEVELS,
) -> DataFrame:
    """One row per level and group: the level's name, its keys (others NULL) and the sums.

    A NULL among the keys is a group of its own: levels are told apart by the grouping
    number, not by NULLs. An empty table gives no rows.
    """
    dims = list(dict.fromkeys(c for cols in levels.values() for c in cols))
    numbers = {
        name: sum(1 << (len(dims) - 1 - i) for i, c in enumerate(dims) if c not in cols)
        for name, cols in levels.items()
    }
    grouped = (
        with_price_tier(sales, cuts)
        .groupingSets([[F.col(c) for c in cols] for cols in levels.values()], *dims)
        .agg(F.grouping_id().alias("_number"), *kpi_sums())
    )
    names = [F.when(F.col("_number") == n, F.lit(name)) for name, n in numbers.items()]
    return grouped.select(F.coalesce(*names).alias("level"), *dims, *SUMS)


def write_cube(
    sales: DataFrame,
    path: str,
    cuts: Sequence[float] = PRICE_CUTS,
    levels: Mapping[str, Sequence[str]] = LEVELS,
    mode: str = "errorifexists",
) -> KpiCube:
    """Build the cube in one pass over ``sales`` and write it, one folder per level."""
    cube = build_cube(sales, cuts, levels)
    cube.hint("rebalance", "level").write.mode(mode).partitionBy("level").parquet(path)
    return read_cube(sales.sparkSession, path, cube, cuts, levels)


def read_cube(
    spark: SparkSession,
    path: str,
    like: DataFrame | None = None,
    cuts: Sequence[float] = PRICE_CUTS,
    levels: Mapping[str, Sequence[str]] = LEVELS,
) -> KpiCube:
    """Open a written cube; ``cuts`` and ``levels`` must be those it was built with."""
    reader = spark.read if like is None else spark.read.schema(like.schema)
    return KpiCube(reader.parquet(path), levels, tuple(cuts))


def tiered(sales: DataFrame | KpiCube, cuts: Sequence[float]) -> DataFrame | KpiCube:
    """Sales with their price tier; a cube has its tiers already, and no others."""
    if not isinstance(sales, KpiCube):
        return with_price_tier(sales, cuts)
    if tuple(cuts) != sales.cuts:
        raise ValueError(f"the cube has price cuts {sales.cuts}, not {tuple(cuts)}")
    return sales
