"""Ordering by slices against brute force."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesight.operators import ordering
from salesight.sources.staging import stage

SCHEMA = "g string, k int, v double"


def table(n=300, hot=0.4, seed=1):
    """Rows of which a large part shares one value and one group; some values are NULL."""
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        group = "hot" if rnd.random() < hot else rnd.choice("abc")
        value = 7.0 if rnd.random() < hot else rnd.choice([None, *map(float, range(20))])
        rows.append((group, k, value))
    return rows


def down(value):
    return (value is None, -(value or 0.0))


def brute_rank(rows, grouped):
    found = {}
    for g, k, v in rows:
        peers = [r for r in rows if not grouped or r[0] == g]
        found[k] = 1 + sum(down(r[2]) < down(v) for r in peers)
    return found


def brute_tiles(rows, n):
    ordered = sorted(rows, key=lambda r: (down(r[2]), r[1]))
    size, larger = divmod(len(rows), n)
    found, place = {}, 0
    for tile in range(1, n + 1):
        for _ in range(size + (tile <= larger)):
            found[ordered[place][1]] = tile
            place += 1
    return found


@pytest.fixture(params=[1, 4, 7])
def slices(request, spark):
    """The number of slices that a range partitioning makes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    for key, value in old.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("grouped", [False, True])
def test_ranks(spark, slices, grouped):
    rows = table()
    by = ["g"] if grouped else []
    df = ordering.with_ranks(spark.createDataFrame(rows, SCHEMA), {"r": "v"}, by)
    assert {r.k: r.r for r in df.collect()} == brute_rank(rows, grouped)
    assert dict(df.dtypes)["r"] == "bigint"


@pytest.mark.parametrize("n", [3, 4])
def test_tiles(spark, slices, n):
    rows = table(n=101)
    df = ordering.with_tiles(spark.createDataFrame(rows, SCHEMA), {"t": "v"}, n, ["k"])
    assert {r.k: r.t for r in df.collect()} == brute_tiles(rows, n)
    assert dict(df.dtypes)["t"] == "int"


def test_fewer_rows_than_tiles(spark, slices):
    rows = [("a", 1, 5.0), ("a", 2, 9.0)]
    df = ordering.with_tiles(spark.createDataFrame(rows, SCHEMA), {"t": "v"}, 4, ["k"])
    assert {r.k: r.t for r in df.collect()} == {2: 1, 1: 2}


def test_two_tile_columns_at_once(spark, slices):
    rows = [(str(i % 3), i, float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("w", -F.col("v"))
    out = ordering.with_tiles(df, {"up": "w", "down": "v"}, 4, ["k"]).collect()
    assert all(r.up + r.down == 5 for r in out)


def test_running_total(spark, slices):
    rows = table(n=120)
    df = spark.createDataFrame(rows, SCHEMA).fillna(0.0)
    out = ordering.running_before(df, [F.col("k")], F.col("v"), "before", total="all").collect()
    total = 0.0
    for row in sorted(out, key=lambda r: r.k):
        assert row.before == total and row.all == sum(r.v for r in out)
        total += row.v


def test_several_ranks_in_one_pass(spark, slices):
    rows = table(n=80)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("w", (F.col("k") % 5).cast("decimal(6,2)"))
    out = ordering.with_ranks(df, {"r": "v", "by_key": "k", "by_w": "w"}, ["g"]).collect()
    ranks = brute_rank(rows, True)
    for r in out:
        peers = [p for p in out if p.g == r.g]
        assert r.r == ranks[r.k]
        assert r.by_key == 1 + sum(p.k > r.k for p in peers) and r.by_w == 1 + sum(p.w > r.w for p in peers)


def test_ranks_of_a_null_group(spark, slices):
    df = spark.createDataFrame([(None, 1, 2.0), (None, 2, 3.0), ("a", 3, None), (None, 4, None)], SCHEMA)
    assert {r.k: r.r for r in ordering.with_ranks(df, {"r": "v"}, ["g"]).collect()} == {1: 2, 2: 1, 3: 1, 4: 3}


def test_no_window_over_all_rows(spark):
    """Windows without keys stand on slice totals only."""
    df = spark.createDataFrame(table(), SCHEMA)
    for found in (ordering.with_ranks(df, {"r": "v"}), ordering.with_tiles(df, {"t": "v"}, 4, ["k"])):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.split("\n"):
            if "Window [" in line and "_slice" not in line.split("], [", 1)[-1]:
                assert "_weight" in line


def test_large_k(spark):
    df = spark.range(120_000).select(F.lit("a").alias("g"), F.col("id").cast("int").alias("k"), F.col("id").cast("double").alias("v"))
    top = ordering.top_with_ranks(df, 100_000, [F.desc("v")], {"r": "v"})
    assert top.agg(F.count("*"), F.max("r"), F.min("v")).first()[:] == (100_000, 100_000, 20_000.0)


def test_large_path_gives_hot_values_no_single_slice(spark):
    """One value on every row: the slices still follow the whole sort order."""
    df = spark.range(400).select(F.lit(1.0).alias("v"), F.col("id").alias("k"))
    order = [F.col("v"), F.col("k")]
    sliced = df.repartitionByRange(5, *order).groupBy(F.spark_partition_id()).count()
    assert sliced.agg(F.max("count")).first()[0] < 200


def test_top_with_ranks_equals_full_ranks(spark):
    rows = table()
    df = spark.createDataFrame(rows, SCHEMA)
    order = [F.desc_nulls_last("v"), F.col("k")]
    top = ordering.top_with_ranks(df, 7, order, {"r": "v", "by_key": "k"}).collect()
    ranks = brute_rank(rows, False)
    assert len(top) == 7
    assert all(r.r == ranks[r.k] and r.by_key == 300 - r.k for r in top)


def test_top_with_ranks_of_a_null_measure_and_of_nothing(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 3.0)], SCHEMA)
    rows = ordering.top_with_ranks(df, 5, [F.col("k")], {"r": "v"}).collect()
    assert [(r.k, r.r) for r in rows] == [(1, 2), (2, 1)]
    assert ordering.top_with_ranks(df.limit(0), 5, [F.col("k")], {"r": "v"}).count() == 0


def test_top_with_ranks_leaves_a_staged_table_usable(spark):
    staged = stage(spark.createDataFrame(table(n=20), SCHEMA))
    for _ in range(2):
        top = ordering.top_with_ranks(staged, 2, [F.col("k")], {"r": "v"})
        assert top.columns == ["g", "k", "v", "r"] and top.count() == 2
    assert staged.frame.columns == ["g", "k", "v"]


def test_ranks_take_a_staged_table_as_it_is(spark):
    staged = stage(spark.createDataFrame(table(n=20), SCHEMA))
    df = ordering.with_ranks(staged, {"r": "v"})
    assert set(staged.frame.inputFiles()) <= set(df.inputFiles())


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3).map(float)), min_size=1, max_size=30))
def test_ranks_of_any_values(spark, values):
    rows = [("a", i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.k: r.r for r in ordering.with_ranks(df, {"r": "v"}).collect()}
    assert found == brute_rank(rows, False)


def test_growth(spark):
    df = spark.createDataFrame(
        [("2005-01", 100.0), ("2005-03", 0.0), ("2005-02", 150.0), ("2005-04", 5.0)],
        "m string, x double",
    )
    rows = ordering.with_growth(df, "x", "m", "prev", "growth").orderBy("m").collect()
    assert [(r.prev, r.growth) for r in rows] == [
        (None, None), (100.0, 50.0), (150.0, -100.0), (0.0, None),
    ]
