from __future__ import annotations

import datetime

import pytest

from salesight.functions import labels as L
from salesight.plans import overviews, reports


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_ranking_ties_share_a_rank(sales):
    df = sales(
        {"category": "A", "revenue": 50, "profit": 5},
        {"category": "B", "revenue": 50, "profit": 10},
        {"category": "C", "revenue": 100, "profit": 1},
    )
    rows = by(reports.q01_category_ranking(df), "category")
    ranks = {k[0]: (r.revenue_rank, r.profit_rank, r.margin_rank) for k, r in rows.items()}
    assert ranks == {"A": (2, 2, 2), "B": (2, 1, 1), "C": (1, 3, 3)}
    assert sum(r.revenue_share_pct for r in rows.values()) == 100.0


def test_region_report_has_per_order_figures(sales):
    row = reports.q02_region_strength(sales({"revenue": 10, "profit": 4}, {"revenue": 20, "profit": 5})).first()
    assert (row.avg_order_value, row.profit_per_order, row.revenue_rank) == (15.0, 4.5, 1)


def test_top_products_rank_among_all(sales):
    rows = [{"product_name": f"p{i:02d}", "revenue": 100 + i, "profit": 50 - i} for i in range(15)]
    top = reports.q03_top_products(sales(*rows), k=3).collect()
    assert [r.product_name for r in top] == ["p14", "p13", "p12"]
    assert [(r.revenue_rank, r.profit_rank) for r in top] == [(1, 15), (2, 14), (3, 13)]
    total = sum(100 + i for i in range(15))
    assert top[0].revenue_share_pct == round(114 / total * 100, 2)


def test_equal_revenue_at_the_cut_goes_by_name(sales):
    rows = [{"product_name": n, "revenue": 10} for n in "dbca"]
    assert [r.product_name for r in reports.q03_top_products(sales(*rows), k=2).collect()] == ["a", "b"]


VOLUME = (
    {"product_name": "much", "quantity": 10, "revenue": 100, "profit": 10},
    {"product_name": "big", "quantity": 9, "revenue": 6_000_000, "profit": 60},
    {"product_name": "fine", "quantity": 1, "revenue": 100, "profit": 90},
    {"product_name": "rest", "quantity": 1, "revenue": 100, "profit": 90},
)


def test_volume_without_margin(sales):
    rows = by(reports.q04_volume_without_margin(sales(*VOLUME)), "product_name")
    assert {k[0]: r.diagnosis for k, r in rows.items()} == {
        "much": L.LOW_MARGIN_VOLUME,
        "big": L.MARGIN_PRESSURE,
    }
    # The benchmark is the unweighted mean of product margins.
    assert rows[("much",)].avg_margin_benchmark == pytest.approx((10 + 0.001 + 90 + 90) / 4, abs=0.01)
    assert rows[("much",)].quantity_above_benchmark == 4.75


def test_other_groups_are_on_watch_when_asked_for(sales):
    rows = by(reports.q04_volume_without_margin(sales(*VOLUME), include_all=True), "product_name")
    assert len(rows) == 4 and rows[("fine",)].diagnosis == L.MONITOR


def test_margin_ranking_sorts_by_rounded_and_ranks_by_raw(sales):
    df = sales(
        {"sub_category": "b", "revenue": 100000, "profit": "20000.1"},
        {"sub_category": "a", "revenue": 100000, "profit": "20000.0"},
        {"sub_category": "c", "revenue": 100, "profit": 10},
    )
    rows = reports.q05_margin_ranking(df, k=2).collect()
    assert [(r.sub_category, r.profit_margin_pct, r.margin_rank) for r in rows] == [
        ("a", 20.0, 2),
        ("b", 20.0, 1),
    ]


def test_share_without_margin_uses_weighted_margin(sales):
    df = sales(
        {"sub_category": "big", "revenue": 900, "profit": 90},
        {"sub_category": "s1", "revenue": 50, "profit": 40},
        {"sub_category": "s2", "revenue": 50, "profit": 40},
    )
    row = reports.q07_share_without_margin(df).collect()
    assert len(row) == 1 and row[0].sub_category == "big"
    assert (row[0].avg_revenue_share_benchmark, row[0].overall_margin_benchmark) == (33.33, 17.0)
    assert row[0].margin_gap_pct == -7.0
    assert reports.q07_share_without_margin(df, include_all=True).count() == 3


def test_group_at_the_mean_share_is_no_candidate(sales):
    df = sales({"sub_category": "a", "revenue": 10, "profit": 1}, {"sub_category": "b", "revenue": 10, "profit": 2})
    assert reports.q07_share_without_margin(df).count() == 0


def test_one_month_has_no_growth(sales):
    row = reports.q08_monthly_growth(sales({"revenue": 10})).first()
    assert (row.prev_month_revenue, row.mom_growth_pct) == (None, None)


def test_growth_between_months(sales):
    df = sales({"revenue": 10}, {"revenue": 15, "order_year_month": "2005-02"})
    rows = reports.q08_monthly_growth(df).collect()
    assert [r.mom_growth_pct for r in rows] == [None, 50.0]


def test_rank_inside_region(sales):
    df = sales(
        {"region": "N", "category": "A", "revenue": 5},
        {"region": "N", "category": "B", "revenue": 9},
        {"region": "S", "category": "A", "revenue": 1},
    )
    rows = reports.q09_region_category(df).collect()
    assert [(r.region, r.category, r.rank_in_region) for r in rows] == [
        ("N", "B", 1), ("N", "A", 2), ("S", "A", 1),
    ]


def test_state_segments_with_a_tie(sales):
    df = sales(*[{"state": s, "revenue": 10} for s in "cab"])
    segments = {r.state: r.value_segment for r in reports.q10_state_segments(df).collect()}
    assert segments == dict(zip("abc", L.SEGMENTS))


def test_action_grid(sales):
    rows = [
        {"product_name": "a", "revenue": 400, "profit": 200},
        {"product_name": "b", "revenue": 300, "profit": 3},
        {"product_name": "c", "revenue": 200, "profit": 160},
        {"product_name": "d", "revenue": 100, "profit": 10},
    ]
    found = {r.product_name: r.priority_action for r in reports.q11_product_actions(sales(*rows)).collect()}
    assert found == {"a": L.SCALE_UP, "c": L.PROMOTE}


def test_high_revenue_with_poor_margin_is_monitored(sales):
    rows = [{"product_name": n, "revenue": r, "profit": p} for n, r, p in
            (("a", 400, 1), ("b", 300, 90), ("c", 200, 100), ("d", 100, 90))]
    found = {r.product_name: r.priority_action for r in reports.q11_product_actions(sales(*rows)).collect()}
    assert found["a"] == L.MONITOR


def test_corrective_actions_include_the_mean_and_the_gap_limit(sales):
    df = sales(
        {"product_name": "a", "revenue": 100, "profit": 10},
        {"product_name": "b", "revenue": 100, "profit": 30},
    )
    row = reports.q12_corrective_actions(df).collect()
    # Revenue equal to the mean qualifies; the gap is 10 - 20 = -10, which is urgent.
    assert len(row) == 1 and row[0].product_name == "a"
    assert (row[0].revenue_gap, row[0].margin_gap_pct) == (0.0, -10.0)
    assert row[0].recommended_action == L.URGENT
    softer = reports.q12_corrective_actions(df, urgent_gap=-10.5).first()
    assert softer.recommended_action == L.REVIEW
    watched = by(reports.q12_corrective_actions(df, include_all=True), "product_name")
    assert watched[("b",)].recommended_action == L.MONITOR


@pytest.mark.parametrize(
    "report",
    [
        reports.q01_category_ranking,
        reports.q02_region_strength,
        reports.q09_region_category,
        reports.q10_state_segments,
        reports.q11_product_actions,
    ],
)
def test_reports_do_not_depend_on_the_task_limit(sales, report):
    rows = [
        {
            "category": f"c{i % 5}",
            "region": f"r{i % 3}",
            "state": f"s{i % 11}",
            "product_name": f"p{i % 13}",
            "revenue": 10 + i * 7 % 50,
            "profit": i % 9,
        }
        for i in range(60)
    ]
    df = sales(*rows)
    plain = report(df)
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sliced = report(df)
        sliced.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, sliced.collect()))


def test_overviews(sales):
    df = sales(
        {"region": "N", "revenue": 10, "profit": 4, "unit_price": 100.0},
        {"region": "S", "revenue": 30, "profit": 4, "unit_price": 600.0},
    )
    totals = overviews.kpi_totals(df).first()
    assert tuple(totals) == (40.0, 8.0, 20.0, 2, 2)
    assert [r.region for r in overviews.dimension_overview(df, "region").collect()] == ["S", "N"]
    tiers = overviews.price_tier_overview(df).collect()
    assert [r.price_tier for r in tiers] == ["Premium (550+)", "Budget (<150)"]
    feed = overviews.tier_feed(df).collect()
    assert [(r.tier_order, r.price_tier) for r in feed] == [(1, "Budget (<150)"), (3, "Premium (550+)")]


def test_totals_of_nothing(sales):
    row = overviews.kpi_totals(sales({}).limit(0)).first()
    assert (row.total_revenue, row.overall_margin_pct, row.total_orders) == (None, None, 0)


def test_months_are_in_time_order(sales):
    df = sales({"order_year_month": "2006-01"}, {"order_year_month": "2005-12"})
    assert [r[0] for r in overviews.monthly_overview(df).collect()] == ["2005-12", "2006-01"]
    assert overviews.chart_monthly_revenue(df).columns == ["order_year_month", "total_revenue"]


def test_top_product_ties_go_by_name(sales):
    df = sales(*[{"product_name": n, "order_date_parsed": datetime.date(2005, 1, 1)} for n in "cab"])
    assert [r.product_name for r in overviews.top_products(df, 2).collect()] == ["a", "b"]
