from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from salesight.operators import aggregate, benchmark, describe, sampling


def test_group_kpis_use_ratios_of_sums(sales):
    df = sales({"revenue": 100, "profit": 50}, {"revenue": 300, "profit": 30})
    row = aggregate.order_averages(aggregate.group_kpis(df, ["category"])).first()
    assert (row.order_count, row.total_quantity, row.profit_margin_pct) == (2, 2, 20.0)
    assert (row.avg_order_value, row.profit_per_order) == (200.0, 40.0)


def test_group_without_revenue_has_no_margin(sales):
    row = aggregate.group_kpis(sales({"revenue": 0, "profit": 0}), ["category"]).first()
    assert row.profit_margin_pct is None


def test_value_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None)], "p string, q string")
    rows = [tuple(r) for r in aggregate.value_counts(df, ["p"]).collect()]
    assert rows == [("p", "a", 2), ("p", "b", 1)]
    assert [tuple(r) for r in aggregate.value_counts(df, ["p"], 1).collect()] == rows[:1]
    assert aggregate.value_counts(df, ["p", "q"]).where("value IS NULL").count() == 1


def test_dominant_value_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (2, "c"), (2, "c"), (2, "a"), (3, None)], "g int, v string"
    )
    rows = {r.g: (r.dominant_v, r.dominant_v_count) for r in aggregate.dominant_value(df, "g", "v").collect()}
    assert rows == {1: ("a", 1), 2: ("c", 2), 3: (None, 1)}


def test_profile_join_keeps_one_key_and_unmatched_groups(spark):
    profile = spark.createDataFrame([(1, 5), (2, 6)], "g int, n int")
    dominant = spark.createDataFrame([(1, "a")], "g int, d string")
    joined = aggregate.profile_with_dominant(profile, dominant, "g")
    assert joined.columns == ["g", "n", "d"]
    assert sorted(map(tuple, joined.collect())) == [(1, 5, "a"), (2, 6, None)]


def test_shares_sum_to_100(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 8)], "x double")
    shares = benchmark.with_shares(df, {"share": "x"})
    assert shares.agg(F.sum("share")).first()[0] == pytest.approx(100)
    assert shares.columns == ["x", "share"]


def test_benchmark_of_an_empty_table(spark):
    df = spark.createDataFrame([], "x double")
    assert benchmark.with_benchmark(df, {"m": benchmark.mean_of("x")}).count() == 0


NUMBERS = [5.0, 1.0, 1.0, 8.0, 2.5, 1.0, 100.0, None]


@pytest.mark.parametrize("accuracy", [3, 10_000])
def test_exact_description(spark, accuracy):
    import numpy as np

    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(NUMBERS)], "x double, y double")
    rows = {r.measure: r for r in describe.describe(df, ["x", "y"], True, accuracy).collect()}
    known = np.array(NUMBERS[:-1])
    x = rows["x"]
    assert (x.row_count, x.min, x.max) == (7, 1.0, 100.0)
    assert x.mean == pytest.approx(known.mean()) and x.stddev == pytest.approx(known.std(ddof=1))
    assert [x.q25, x.q50, x.q75] == pytest.approx(list(np.quantile(known, [0.25, 0.5, 0.75])))
    assert rows["y"].q50 == 3.5 and rows["y"].row_count == 8


@pytest.mark.parametrize("accuracy", [20, 200])
def test_exact_quartiles_of_many_rows(spark, accuracy):
    """Brackets of a coarse approximation still hold the true quartiles."""
    import numpy as np

    rnd = np.random.default_rng(accuracy)
    values = np.concatenate([rnd.normal(0, 50, 4000).round(1), np.full(1500, 7.0)])
    df = spark.createDataFrame([(float(v), float(i)) for i, v in enumerate(values)], "x double, y double").repartition(7)
    rows = {r.measure: r for r in describe.describe(df, ["x", "y"], True, accuracy).collect()}
    for name, known in (("x", values), ("y", np.arange(len(values)))):
        found = [rows[name].q25, rows[name].q50, rows[name].q75]
        assert found == pytest.approx(list(np.quantile(known, [0.25, 0.5, 0.75])))


def test_value_counts_keep_the_first_of_every_column(spark):
    from salesight.operators.aggregate import value_counts

    df = spark.createDataFrame([("a", i % 7, 1.5) for i in range(40)], "m string, n int, d double")
    found = [(r.column_name, r.value, r.row_count) for r in value_counts(df, ["m", "n", "d"], 2).collect()]
    assert found == [("d", "1.5", 40), ("m", "a", 40), ("n", "0", 6), ("n", "1", 6)]


def test_approximate_description(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    row = describe.describe(df, ["x"]).first()
    assert (row.row_count, row.q25, row.q50, row.q75) == (1001, 250.0, 500.0, 750.0)


@pytest.mark.parametrize("finest", [20, 10_000])
def test_fine_approximate_quartiles_need_no_long_digest(spark, monkeypatch, finest):
    """They are the values at the quartiles' ranks, from digests of the usual length."""
    import numpy as np

    rnd = np.random.default_rng(finest)
    values = np.concatenate([rnd.normal(0, 50, 4000).round(1), np.full(1503, 7.0)])
    asked, digest = [], F.percentile_approx
    monkeypatch.setattr(describe, "DIGEST_ACCURACY", finest)
    monkeypatch.setattr(F, "percentile_approx", lambda c, p, accuracy: asked.append(accuracy) or digest(c, p, accuracy))
    df = spark.createDataFrame([(float(v), float(i)) for i, v in enumerate(values)], "x double, y double").repartition(7)
    df = df.unionByName(spark.createDataFrame([(None, None)], df.schema))
    rows = {r.measure: r for r in describe.describe(df, ["x", "y"], accuracy=10_000_000).collect()}
    for name, known in (("x", values), ("y", np.arange(len(values)))):
        found = [rows[name].q25, rows[name].q50, rows[name].q75]
        assert found == list(np.quantile(known, [0.25, 0.5, 0.75], method="inverted_cdf"))
    assert max(asked) <= finest


def test_split_follows_rows_not_partitions(spark):
    df = spark.range(5000).select("id", F.lit("hot").alias("key"))
    one = sampling.train_test_split(df.repartition(1)).where("split = 'train'").select("id")
    many = sampling.train_test_split(df.repartition(7)).where("split = 'train'").select("id")
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0
    assert 3800 < one.count() < 4200
    sizes = {r.split: r.row_count for r in sampling.split_sizes(sampling.train_test_split(df)).collect()}
    assert sum(sizes.values()) == 5000


def test_sample_and_cap(spark):
    df = spark.range(20000)
    sample = sampling.sample_rows(df, 0.05)
    assert 800 < sample.count() < 1200
    capped = sampling.sample_rows(df, 0.05, cap=100)
    assert capped.count() == 100 and capped.exceptAll(sample).count() == 0
    assert sampling.sample_rows(df, 0.05, seed=7).exceptAll(sample).count() > 0
