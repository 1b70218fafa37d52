"""Row splits and samples that depend on the rows only, not on their partitions.

A row's side follows from a hash of its values: re-runs, retries after a lost
executor and other cluster sizes give the same rows, and nothing is shuffled. The hash
is the beginning of the MD5 of the values' text, which other engines can state too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1_000_000


def _hash(df: DataFrame, purpose: str, seed: int, keys: Sequence[str] | None) -> Column:
    """Row hash; the purpose keeps a sample independent of a split with the same seed."""
    values = [F.col(k).cast("string") for k in (keys or df.columns)]
    digest = F.md5(F.concat_ws("|", F.lit(f"{purpose} {seed}"), *values))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _chosen(row_hash: Column, fraction: float) -> Column:
    return F.pmod(row_hash, F.lit(BUCKETS)) < round(fraction * BUCKETS)


def train_test_split(
    df: DataFrame,
    fraction: float = 0.8,
    seed: int = 42,
    keys: Sequence[str] | None = None,
    out: str = "split",
) -> DataFrame:
    """Label rows ``train`` or ``test`` by a hash of ``keys`` (all columns by default).

    Hashing whole rows keeps the fractions even where one key holds many rows.
    """
    chosen = _chosen(_hash(df, "split", seed, keys), fraction)
    return df.withColumn(out, F.when(chosen, "train").otherwise("test"))


def split_sizes(df: DataFrame, column: str = "split") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def sample_rows(
    df: DataFrame,
    fraction: float = 0.05,
    seed: int = 42,
    cap: int | None = None,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Bernoulli sample without replacement; ``cap`` keeps the first rows by hash."""
    sample = df.where(_chosen(_hash(df, "sample", seed, keys), fraction))
    if cap is None:
        return sample
    return sample.orderBy(_hash(df, "cap", seed, keys)).limit(cap)
