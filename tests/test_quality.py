from __future__ import annotations

import math

from salesight.operators import prepare, quality

RAW = "order_id string, order_date string, category string, sub_category string, product_name string, region string, state string, quantity string, unit_price string, revenue string, profit string"
GOOD = ("1", "01-31-24", "C", "S", "p", "R", "T", "2", "5.0", "10", "3")


def typed(spark, *rows):
    return prepare.prepare_sales(spark.createDataFrame(list(rows), RAW))


def change(**values):
    names = [c.split()[0] for c in RAW.split(", ")]
    return tuple(values.get(n, v) for n, v in zip(names, GOOD))


def test_clean_drops_repeats_incomplete_and_out_of_range_rows(spark):
    df = typed(
        spark,
        GOOD,
        GOOD,
        change(order_date="nope"),
        change(state=None),
        change(quantity="0"),
        change(unit_price="-1"),
        change(revenue="-5"),
        change(profit="-0.01"),
        change(unit_price="NaN"),
        change(order_id="2", revenue="0", profit="0"),
    )
    rows = {r.order_id: r for r in quality.clean_sales(df).collect()}
    assert set(rows) == {1, 2}
    assert rows[1].profit_margin_pct == 30.0 and rows[1].order_month == 1
    assert rows[2].profit_margin_pct is None


def test_cleaning_report_counts_the_same_rows(spark):
    df = typed(spark, GOOD, GOOD, GOOD, change(profit="-1"), change(order_id="2"))
    report = quality.cleaning_report(df).first()
    assert tuple(report) == (5, quality.clean_sales(df).count(), 3, 60.0)


def test_cleaning_report_of_nothing(spark):
    report = quality.cleaning_report(typed(spark, GOOD).limit(0)).first()
    assert tuple(report) == (0, 0, 0, None)


def test_text_variants_of_one_value_are_one_row(spark):
    df = typed(spark, GOOD, change(revenue="10.0", quantity=" 2 "))
    assert quality.clean_sales(df).count() == 1


def test_key_repeats_count_null_as_a_value(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "order_id int")
    assert tuple(quality.duplicate_keys(df).first()) == (4, 2, 2)


def test_row_repeats_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert tuple(quality.duplicate_rows(df).first()) == (0, 0, 0)


def test_profile_figures(spark):
    df = typed(spark, GOOD, change(revenue="12"), change(quantity=None), change(profit="11"))
    assert quality.null_counts(df).first().quantity == 1
    assert quality.revenue_mismatch(df).first()[0] == 1
    assert quality.margin_sanity(df).first().profit_exceeds_revenue_rows == 1
    bounds = quality.range_profile(df).first()
    assert (bounds.min_revenue, bounds.max_revenue, bounds.max_profit) == (10.0, 12.0, 11.0)
    assert quality.bad_dates(df).first()[0] == 0


def test_size_gate_is_strict(spark):
    df = spark.range(5)
    gate = quality.size_gate(df, min_rows=5, min_cols=0).first()
    assert (gate.row_count, gate.column_count, gate.enough_rows, gate.enough_columns) == (5, 1, False, True)


def test_schema_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    rows = quality.schema_report(df).orderBy("position").collect()
    assert [tuple(r) for r in rows] == [(0, "a", "int", True, 0), (1, "b", "string", True, 1)]


def test_dependency_violations_and_lookup(spark):
    df = spark.createDataFrame(
        [("a", "x", "1"), ("a", "y", "1"), ("a", "y", "1"), ("b", "x", "2")],
        "product_name string, category string, sub_category string",
    )
    assert [tuple(r) for r in quality.fd_violations(df).collect()] == [("a", 2)]
    assert quality.product_lookup(df, ["a"]).count() == 2


def test_rows_that_differ_in_an_input_margin_stay(spark):
    from salesight.operators import prepare

    base = (1, "01-02-23", "c", "s", "p", "r", "t", 1, 2.0, 2.0, 1.0)
    names = "order_id bigint, order_date string, category string, sub_category string, product_name string, region string, state string, quantity int, unit_price double, revenue double, profit double, profit_margin_pct double"
    df = spark.createDataFrame([(*base, 50.0), (*base, 49.0), (*base, 50.0)], names)
    typed = prepare.date_parts(prepare.parse_date(df))
    assert quality.clean_sales(typed).count() == 2
    assert quality.cleaning_report(typed).first().rows_after == 2
    assert {r.profit_margin_pct for r in quality.clean_sales(typed).collect()} == {50.0}


def test_preview_takes_rows_as_they_come(spark):
    text = quality.preview(spark.range(1000), 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in text and quality.preview(spark.range(1000), 3).count() == 3


def test_preview_is_ordered(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "n int, s string")
    assert [r.n for r in quality.preview(df, 2, ordered=True).collect()] == [1, 2]
    assert quality.preview(df, 1, ["s"], ordered=True).collect()[0].s == "a"


def test_non_null_rule_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (None,)], "x double")
    assert quality.require_non_null(df, ["x"]).count() == 1
