from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from salesight.operators.sketches import daily_sketches, distinct_from, quantiles_from


@pytest.fixture(scope="module")
def many(spark):
    """60,000 rows of 90 days; 20,000 orders; revenue is uniform in a scrambled order."""
    return spark.range(60_000).select(
        (F.col("id") % 20_000).alias("order_id"),
        F.date_add(F.lit(datetime.date(2005, 1, 1)), (F.col("id") % 90).cast("int")).alias("order_date_parsed"),
        F.concat(F.lit("p"), F.col("id") % 50).alias("product_name"),
        F.when(F.col("id") % 10 < 4, "A").when(F.col("id") % 10 < 8, "B").alias("region"),
        F.lit("C").alias("category"),
        (F.pmod(F.col("id") * 7919, F.lit(60_000)) / 100).cast("decimal(12,2)").alias("revenue"),
    )


def sketched(rows):
    return daily_sketches(rows, measured=["revenue"])


def test_distinct_counts_are_within_their_error(spark, many):
    days = sketched(many)
    whole = distinct_from(days, []).first()
    assert abs(whole.distinct_order_id - 20_000) < 4 * 0.013 * 20_000
    assert whole.distinct_product_name == 50
    by = {r.region: r.distinct_order_id for r in distinct_from(days, ["region"]).collect()}
    exact = many.groupBy("region").agg(F.count_distinct("order_id").alias("n")).collect()
    assert set(by) == {"A", "B", None}
    assert all(abs(by[r.region] - r.n) < 4 * 0.013 * r.n for r in exact)


def test_quantiles_are_within_their_rank_error(many):
    for r in quantiles_from(sketched(many), ["region"], ["revenue"]).collect():
        rows = many.where(F.col("region").eqNullSafe(r.region))
        n = rows.count()
        for value, wanted in ((r.q25, 0.25), (r.q50, 0.5), (r.q75, 0.75)):
            assert abs(rows.where(F.col("revenue") <= value).count() / n - wanted) < 0.02


def test_days_can_be_added(spark, many, tmp_path):
    path = str(tmp_path / "days")
    late = F.col("order_date_parsed") > "2005-02-15"
    for part in (~late, late):
        sketched(many.where(part)).write.mode("append").parquet(path)
    kept = spark.read.parquet(path)
    assert kept.count() == sketched(many).count()
    a, b = distinct_from(kept, []).first(), distinct_from(sketched(many), []).first()
    assert a == b  # a union of distinct sketches does not depend on how rows were dealt


def test_empty_tables_and_columns_without_values(spark, many):
    empty = sketched(many.limit(0))
    assert empty.count() == 0
    assert distinct_from(empty, ["region"]).count() == 0
    assert quantiles_from(empty, ["region"], ["revenue"]).count() == 0
    nothing = many.limit(3).withColumn("revenue", F.lit(None).cast("decimal(12,2)"))
    found = quantiles_from(sketched(nothing), ["category"], ["revenue"]).first()
    assert (found.measure, found.q25, found.q75) == ("revenue", None, None)


def test_rows_are_combined_before_the_shuffle_and_not_sorted_in_one_task(many):
    plan = sketched(many)._jdf.queryExecution().executedPlan().toString()
    assert "partial_hll_sketch_agg" in plan and plan.count("Exchange") == 1
