"""KPI overviews of the clean sales table, and the data behind each chart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import PRICE_CUTS, nth_label, tier_labels, tier_number
from ..functions.measures import round2
from ..operators.aggregate import group_kpis, group_sum, rounded
from ..operators.cube import tiered
from ..operators.ordering import top_k

MONEY = ("total_revenue", "total_profit")


def kpi_totals(sales: DataFrame) -> DataFrame:
    """Revenue, profit, margin, orders and units of the whole table."""
    whole = rounded(group_kpis(sales, []), [*MONEY, "profit_margin_pct"])
    return whole.select(
        *MONEY,
        F.col("profit_margin_pct").alias("overall_margin_pct"),
        F.col("order_count").alias("total_orders"),
        F.col("total_quantity").alias("total_units_sold"),
    )


def dimension_overview(
    sales: DataFrame, dimension: str, with_quantity: bool = False
) -> DataFrame:
    """KPIs per value of one dimension, largest revenue first."""
    units = ["total_quantity"] if with_quantity else []
    kpis = rounded(group_kpis(sales, [dimension]), [*MONEY, "profit_margin_pct"])
    return kpis.select(dimension, "order_count", *units, *MONEY, "profit_margin_pct").orderBy(
        F.desc("total_revenue"), dimension
    )


def price_tier_overview(sales: DataFrame, cuts: Sequence[float] = PRICE_CUTS) -> DataFrame:
    return dimension_overview(tiered(sales, cuts), "price_tier", with_quantity=True)


def monthly_overview(sales: DataFrame) -> DataFrame:
    """Revenue and profit per month, in time order."""
    months = rounded(group_kpis(sales, ["order_year_month"]), MONEY)
    return months.select("order_year_month", *MONEY).orderBy("order_year_month")


def chart_by_dimension(sales: DataFrame, dimension: str, measure: str) -> DataFrame:
    """One bar per dimension value, highest first (measure: a KPI of ``group_kpis``)."""
    bars = group_kpis(sales, [dimension]).select(dimension, measure)
    if measure != "total_quantity":
        bars = rounded(bars, [measure])
    return bars.orderBy(F.desc(measure), dimension)


def chart_monthly_revenue(sales: DataFrame) -> DataFrame:
    return monthly_overview(sales).select("order_year_month", "total_revenue")


def top_products(sales: DataFrame, k: int = 10) -> DataFrame:
    """Products with the largest revenue, ties to the smaller name."""
    products = group_sum(sales, ["product_name"], "revenue", "total_revenue")
    best = top_k(products, k, [F.desc("total_revenue"), F.col("product_name")])
    return rounded(best, ["total_revenue"])


def tier_feed(sales: DataFrame, cuts: Sequence[float] = PRICE_CUTS) -> DataFrame:
    """Revenue per price tier in price order, with the order as a column."""
    numbered = sales.withColumn("tier_order", tier_number(F.col("unit_price"), cuts))
    tiers = group_sum(numbered, ["tier_order"], "revenue", "total_revenue")
    return tiers.select(
        "tier_order",
        nth_label(F.col("tier_order"), tier_labels(cuts)).alias("price_tier"),
        round2(F.col("total_revenue")).alias("total_revenue"),
    ).orderBy("tier_order")
