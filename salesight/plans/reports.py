"""The twelve business reports over a clean sales table or a written KPI cube of one.

Each report is: KPIs per group, then shares, ranks, tiles or benchmarks on the
unrounded figures, then labels, rounding, order and limit. Where the KPIs are used
more than once they are staged, so the sales table is read once. Sorts end with
the group keys, so equal figures come out in one order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.measures import round2
from ..operators.aggregate import group_kpis, order_averages, rounded
from ..operators.benchmark import mean_of, overall_margin, with_benchmark, with_shares
from ..operators.cube import tiered
from ..operators.ordering import (
    top_k,
    top_with_ranks,
    with_growth,
    with_ranks,
    with_tiles,
)
from ..sources.staging import stage

SHARES = {"revenue_share_pct": "total_revenue", "profit_share_pct": "total_profit"}
RANKS = {
    "revenue_rank": "total_revenue",
    "profit_rank": "total_profit",
    "margin_rank": "profit_margin_pct",
}
# The shared column block of the ranking reports, in output order.
RANKED_MONEY = (
    "total_revenue",
    "revenue_share_pct",
    "total_profit",
    "profit_share_pct",
    "profit_margin_pct",
)
PER_ORDER = ("avg_order_value", "profit_per_order")


def _ranking(sales: DataFrame, dimension: str, extra: Sequence[str]) -> DataFrame:
    kpis = stage(order_averages(group_kpis(sales, [dimension])), "kpis")
    ranked = with_shares(with_ranks(kpis, RANKS), SHARES)
    shown = [*RANKED_MONEY, *extra]
    return (
        rounded(ranked, shown)
        .select(dimension, "order_count", "total_quantity", *shown, *RANKS)
        .orderBy("revenue_rank", dimension)
    )


def q01_category_ranking(sales: DataFrame) -> DataFrame:
    """Totals, shares, margin and three ranks per category."""
    return _ranking(sales, "category", ())


def q02_region_strength(sales: DataFrame) -> DataFrame:
    """The category ranking by region, with revenue and profit per order."""
    return _ranking(sales, "region", PER_ORDER)


def q03_top_products(sales: DataFrame, k: int = 10) -> DataFrame:
    """Products with the largest revenue; shares and ranks are among all products."""
    keys = ["product_name", "category"]
    kpis = stage(group_kpis(sales, keys), "kpis")
    shared = kpis._replace(frame=with_shares(kpis.frame, SHARES))
    top = top_with_ranks(shared, k, [F.desc("total_revenue"), *keys], RANKS)
    return (
        rounded(top, RANKED_MONEY)
        .select(*keys, "total_quantity", *RANKED_MONEY, *RANKS)
        .orderBy("revenue_rank", *keys)
    )


def _labelled(
    groups: DataFrame, candidate: Column, label: Column, out: str, include_all: bool
) -> DataFrame:
    """Label candidate groups and keep those only, or all with the rest on watch."""
    kept = groups if include_all else groups.where(candidate)
    return kept.withColumn(out, F.when(candidate, label).otherwise(L.MONITOR))


def q04_volume_without_margin(
    sales: DataFrame, high_revenue: float = L.HIGH_REVENUE, include_all: bool = False
) -> DataFrame:
    """Products above the mean quantity but below the (unweighted) mean margin."""
    keys = ["product_name", "category"]
    figures = {
        "avg_quantity_benchmark": mean_of("total_quantity"),
        "avg_margin_benchmark": mean_of("profit_margin_pct"),
    }
    groups = with_benchmark(stage(group_kpis(sales, keys), "kpis").frame, figures)
    gaps = {
        "quantity_above_benchmark": F.col("total_quantity") - F.col("avg_quantity_benchmark"),
        "margin_gap_pct": F.col("profit_margin_pct") - F.col("avg_margin_benchmark"),
    }
    candidate = (F.col("total_quantity") > F.col("avg_quantity_benchmark")) & (
        F.col("profit_margin_pct") < F.col("avg_margin_benchmark")
    )
    label = F.when(F.col("total_revenue") >= high_revenue, L.MARGIN_PRESSURE).otherwise(
        L.LOW_MARGIN_VOLUME
    )
    found = _labelled(groups.withColumns(gaps), candidate, label, "diagnosis", include_all)
    money = ["total_revenue", "total_profit", "profit_margin_pct"]
    return (
        rounded(found, [*figures, *gaps, *money])
        .select(
            *keys,
            "total_quantity",
            "avg_quantity_benchmark",
            "quantity_above_benchmark",
            *money,
            "avg_margin_benchmark",
            "margin_gap_pct",
            "diagnosis",
        )
        .orderBy(F.desc("total_quantity"), *keys)
    )


def q05_margin_ranking(sales: DataFrame, k: int = 10) -> DataFrame:
    """Sub-categories with the best rounded margin; the rank uses the unrounded one."""
    keys = ["sub_category", "category"]
    best = [F.desc(round2(F.col("profit_margin_pct"))), *keys]
    top = top_with_ranks(group_kpis(sales, keys), k, best, {"margin_rank": "profit_margin_pct"})
    money = ["total_revenue", "total_profit", "profit_margin_pct"]
    return (
        rounded(top, money)
        .select(*keys, *money, "margin_rank")
        .orderBy(F.desc("profit_margin_pct"), *keys)
    )


def q06_price_tiers(sales: DataFrame, cuts: Sequence[float] = L.PRICE_CUTS) -> DataFrame:
    """KPIs per price tier."""
    money = ["total_revenue", "total_profit", "profit_margin_pct"]
    tiers = group_kpis(tiered(sales, cuts), ["price_tier"])
    return (
        rounded(tiers, money)
        .select("price_tier", "order_count", "total_quantity", *money)
        .orderBy(F.desc("total_revenue"), "price_tier")
    )


def q07_share_without_margin(sales: DataFrame, include_all: bool = False) -> DataFrame:
    """Sub-categories with more than the mean revenue share at less than the overall margin."""
    keys = ["category", "sub_category"]
    kpis = stage(group_kpis(sales, keys), "kpis").frame
    shares = with_shares(kpis, {"revenue_share_pct": "total_revenue"})
    figures = {
        "avg_revenue_share_benchmark": mean_of("revenue_share_pct"),
        "overall_margin_benchmark": overall_margin(),
    }
    gap = F.col("profit_margin_pct") - F.col("overall_margin_benchmark")
    groups = with_benchmark(shares, figures).withColumn("margin_gap_pct", gap)
    candidate = (F.col("revenue_share_pct") > F.col("avg_revenue_share_benchmark")) & (
        F.col("profit_margin_pct") < F.col("overall_margin_benchmark")
    )
    found = _labelled(groups, candidate, F.lit(L.LOW_MARGIN_SHARE), "diagnosis", include_all)
    measures = [
        "total_revenue",
        "revenue_share_pct",
        "total_profit",
        "profit_margin_pct",
        *figures,
        "margin_gap_pct",
    ]
    ordered = found.orderBy(F.desc("revenue_share_pct"), round2(F.col("margin_gap_pct")), *keys)
    return rounded(ordered, measures).select(
        *keys, "order_count", "total_quantity", *measures, "diagnosis"
    )


def q08_monthly_growth(sales: DataFrame) -> DataFrame:
    """Monthly totals with the previous month and growth, on rounded revenue."""
    money = ["total_revenue", "total_profit"]
    sums = rounded(group_kpis(sales, ["order_year_month"]), money).select("order_year_month", *money)
    grown = with_growth(
        sums, "total_revenue", "order_year_month", "prev_month_revenue", "mom_growth_pct"
    )
    return grown.orderBy("order_year_month")


def q09_region_category(sales: DataFrame) -> DataFrame:
    """Region and category pairs with the revenue rank inside the region."""
    kpis = group_kpis(sales, ["region", "category"])
    ranked = with_ranks(kpis, {"rank_in_region": "total_revenue"}, ["region"])
    money = ["total_revenue", "total_profit"]
    return (
        rounded(ranked, money)
        .select("region", "category", *money, "total_quantity", "rank_in_region")
        .orderBy("region", "rank_in_region", "category")
    )


def q10_state_segments(sales: DataFrame, segments: Sequence[str] = L.SEGMENTS) -> DataFrame:
    """States in equal-count value segments by revenue."""
    keys = ["state", "region"]
    kpis = order_averages(group_kpis(sales, keys))
    tiles = {"revenue_tier": "total_revenue"}
    tiled = with_tiles(kpis, tiles, len(segments), keys)
    segment = L.nth_label(F.col("revenue_tier"), segments)
    measures = ["total_revenue", "total_profit", "profit_margin_pct", *PER_ORDER]
    ordered = tiled.withColumn("value_segment", segment).orderBy(F.desc("total_revenue"), *keys)
    return rounded(ordered, measures).select(
        *keys, "order_count", "total_quantity", *measures, "value_segment"
    )


def q11_product_actions(sales: DataFrame) -> DataFrame:
    """Products in the top quartile by revenue or margin, with the action to take.

    Quartiles are taken on the rounded figures, where margins tie often.
    """
    keys = ["product_name", "category"]
    money = ["total_revenue", "total_profit", "profit_margin_pct"]
    products = rounded(group_kpis(sales, keys), money)
    quartiles = {"revenue_quartile": "total_revenue", "margin_quartile": "profit_margin_pct"}
    tiled = with_tiles(products, quartiles, 4, keys)
    sells, earns = F.col("revenue_quartile"), F.col("margin_quartile")
    action = (
        F.when((sells == 1) & (earns <= 2), L.SCALE_UP)
        .when((earns == 1) & (sells > 1), L.PROMOTE)
        .otherwise(L.MONITOR)
    )
    return (
        tiled.where((sells == 1) | (earns == 1))
        .withColumn("priority_action", action)
        .select(
            *keys,
            "total_revenue",
            "total_profit",
            "total_quantity",
            "profit_margin_pct",
            *quartiles,
            "priority_action",
        )
        .orderBy(F.desc("total_revenue"), *keys)
    )


def q12_corrective_actions(
    sales: DataFrame, urgent_gap: float = L.URGENT_MARGIN_GAP, include_all: bool = False
) -> DataFrame:
    """Product and region pairs with at least mean revenue at less than the overall margin."""
    keys = ["product_name", "category", "region"]
    figures = {
        "avg_revenue_benchmark": mean_of("total_revenue"),
        "overall_margin_benchmark": overall_margin(),
    }
    revenue = F.col("total_revenue").cast("double")
    gaps = {
        "revenue_gap": revenue - F.col("avg_revenue_benchmark"),
        "margin_gap_pct": F.col("profit_margin_pct") - F.col("overall_margin_benchmark"),
    }
    kpis = stage(group_kpis(sales, keys), "kpis").frame
    groups = with_benchmark(kpis, figures).withColumns(gaps)
    candidate = (revenue >= F.col("avg_revenue_benchmark")) & (
        F.col("profit_margin_pct") < F.col("overall_margin_benchmark")
    )
    label = F.when(F.col("margin_gap_pct") <= urgent_gap, L.URGENT).otherwise(L.REVIEW)
    found = _labelled(groups, candidate, label, "recommended_action", include_all)
    ordered = found.orderBy(F.desc("total_revenue"), F.col("margin_gap_pct"), *keys)
    measures = [
        "total_revenue",
        "avg_revenue_benchmark",
        "revenue_gap",
        "total_profit",
        "profit_margin_pct",
        "overall_margin_benchmark",
        "margin_gap_pct",
    ]
    return rounded(ordered, measures).select(
        *keys, "total_quantity", *measures, "recommended_action"
    )
