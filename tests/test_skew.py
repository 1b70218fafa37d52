"""One key, one group or one set of copies holds a third of all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from salesight.operators import aggregate, quality
from salesight.session import tune

FACT = "k bigint, a bigint, b string"


@pytest.fixture()
def eager_skew(spark):
    """Skew handling that already acts on test-sized partitions."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield tune(spark)
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_join_key_is_split_before_the_dedupe(eager_skew):
    spark = eager_skew
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2000)
    fact = spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("a"))
    dim = spark.range(2000).select(F.col("id").alias("d"), F.concat(F.lit("name"), "id").alias("b"))
    joined = fact.join(dim.hint("merge"), F.col("k") == F.col("d")).select("k", "a", "b")
    unique = joined.dropDuplicates()
    assert len(unique.collect()) == n
    assert "skew=true" in unique._jdf.queryExecution().executedPlan().toString()


def test_hot_copies_collapse_before_the_shuffle(spark):
    row = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    df = spark.range(0, 30_000, 1, 8).select(row.alias("a"), (row % 5).cast("string").alias("b"))
    assert tuple(quality.duplicate_rows(df).first()) == (30_000, 20_001, 9_999)


def test_hot_group_gives_right_figures(spark):
    group = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    df = spark.range(9000).select(group.alias("g"), (F.col("id") % 4).alias("v"))
    hot = aggregate.dominant_value(df, "g", "v").where("g = 'hot'").first()
    assert (hot.dominant_v, hot.dominant_v_count) == (0, 750)
    counts = aggregate.value_counts(df, ["g"], 1).first()
    assert (counts.value, counts.row_count) == ("hot", 3000)
