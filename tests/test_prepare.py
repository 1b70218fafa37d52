from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from salesight.operators import prepare


def test_headers(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" Order ID ", "Unit  Price", "state"])
    assert prepare.snake_case_columns(df).columns == ["order_id", "unit_price", "state"]


def test_header_collision_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], ["Unit Price", "unit  price"])
    with pytest.raises(ValueError, match="unit_price"):
        prepare.snake_case_columns(df)


def test_casts_give_null_for_bad_text_and_keep_other_columns(spark):
    df = spark.createDataFrame([("7", "x", "keep"), ("1.5", "2.25", "me")], "quantity string, revenue string, note string")
    rows = prepare.cast_columns(df).collect()
    assert rows[0] == (7, None, "keep")
    assert rows[1] == (1, 2.25, "me")


def test_whole_numbers_may_carry_decimals(spark):
    texts = ["3", "3.0", " 4.00 ", "-2.9", "1e2", "9223372036854775807", "92233720368547758070", "", None, "x"]
    df = spark.createDataFrame([(t, t) for t in texts], "order_id string, quantity string")
    rows = prepare.cast_columns(df).collect()
    assert [r.order_id for r in rows] == [3, 3, 4, -2, 100, 2**63 - 1, None, None, None, None]
    assert [r.quantity for r in rows] == [3, 3, 4, -2, 100, None, None, None, None, None]


def test_text_typing_equals_inference(spark, tmp_path):
    from salesight.sources import files

    path = str(tmp_path / "sales")
    rows = [("3.0", "1"), ("3", "2"), ("4.5", "3.0")]
    spark.createDataFrame(rows, "quantity string, order_id string").coalesce(1).write.option("header", "true").csv(path)
    found = [
        sorted(tuple(r) for r in prepare.cast_columns(files.read_sales(spark, path, infer=infer)).collect())
        for infer in (False, True)
    ]
    assert found[0] == found[1] == [(3, 1), (3, 2), (4, 3)]


def test_dates(spark):
    df = spark.createDataFrame([("02-29-24",), ("13-01-24",), ("bad",), (None,)], "order_date string")
    rows = prepare.date_parts(prepare.parse_date(df)).collect()
    assert rows[0].order_date_parsed == datetime.date(2024, 2, 29)
    assert (rows[0].order_year, rows[0].order_month, rows[0].order_year_month) == (2024, 2, "2024-02")
    assert all(r.order_date_parsed is None and r.order_year_month is None for r in rows[1:])


def test_two_digit_years_are_this_century(spark):
    df = spark.createDataFrame([("01-01-95",)], "order_date string")
    assert prepare.parse_date(df).first().order_date_parsed.year == 2095


def test_margin_of_zero_revenue_is_null(spark):
    df = spark.createDataFrame([(0.0, 0.0), (200.0, 33.333)], "revenue double, profit double")
    assert [r.profit_margin_pct for r in prepare.with_margin(df).collect()] == [None, 16.67]


def test_tier_boundaries(spark):
    prices = [149.99, 150.0, 549.99, 550.0]
    df = spark.createDataFrame([(p,) for p in prices], "unit_price double")
    tiers = [r.price_tier for r in prepare.with_price_tier(df).collect()]
    assert tiers == ["Budget (<150)", "Mid-Range (150-550)", "Mid-Range (150-550)", "Premium (550+)"]


def test_tier_cuts_are_parameters(spark):
    df = spark.createDataFrame([(9.0,), (20.0,)], "unit_price double")
    tiers = [r.price_tier for r in prepare.with_price_tier(df, (10, 20)).collect()]
    assert tiers == ["Budget (<10)", "Premium (20+)"]
    for cuts, expected in (
        ((), ["All prices"] * 2),
        ((15,), ["Budget (<15)", "Premium (15+)"]),
        ((5, 9, 12, 20), ["Tier 3 (9-12)", "Premium (20+)"]),
    ):
        assert [r.price_tier for r in prepare.with_price_tier(df, cuts).collect()] == expected


def test_prepare_keeps_unknown_columns_and_all_rows(spark):
    raw = spark.createDataFrame(
        [("1", "01-31-24", "2", "3.0", "6", "1", "n")],
        ["Order ID", "Order Date", "Quantity", "Unit Price", "Revenue", "Profit", "Note"],
    )
    typed = prepare.prepare_sales(raw)
    row = typed.first()
    assert row.note == "n" and row.order_id == 1 and row.order_year_month == "2024-01"
    assert typed.select(prepare.calc_revenue().alias("c")).first().c == 6.0
    assert prepare.with_calc_revenue(typed).where(F.col("calc_revenue") == 6).count() == 1
