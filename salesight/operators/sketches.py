"""Sketches that are kept by day and merged on read: distinct counts and quantiles.

Exact distinct counts and quartiles need the rows again for every grouping. A sketch is a
few kilobytes, built while rows are combined before the shuffle, written as a binary column
and merged by any coarser key later. New days add rows to the table and change none.
Distinct counts have a standard error of about 0.8 / sqrt(2 ** ``log_size``); a quantile's
rank is off by about 2.5 / ``size`` of the rows. The exact operators stay for exact answers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .describe import QUARTILES

DAY = "order_date_parsed"
COUNTED = ("order_id", "product_name")
MEASURED = ("quantity", "unit_price", "revenue", "profit")
LOG_SIZE = 12
SIZE = 400


def daily_sketches(
    sales: DataFrame,
    keys: Sequence[str] = ("category", "region"),
    day: str = DAY,
    counted: Sequence[str] = COUNTED,
    measured: Sequence[str] = MEASURED,
    log_size: int = LOG_SIZE,
    size: int = SIZE,
) -> DataFrame:
    """One row per day and key: row count, a distinct sketch and a quantile sketch per column.

    NULLs enter no sketch; a NULL key or day is a group of its own.
    """
    distinct = [F.hll_sketch_agg(F.col(c), F.lit(log_size)).alias(f"distinct_{c}") for c in counted]
    ranked = [
        F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(size)).alias(f"ranks_{c}") for c in measured
    ]
    return sales.groupBy(day, *keys).agg(F.count(F.lit(1)).alias("row_count"), *distinct, *ranked)


def distinct_from(sketches: DataFrame, keys: Sequence[str], counted: Sequence[str] = COUNTED) -> DataFrame:
    """Estimated distinct values by any of the sketches' keys (none: of the whole)."""
    merged = [
        F.hll_sketch_estimate(F.hll_union_agg(f"distinct_{c}")).alias(f"distinct_{c}") for c in counted
    ]
    return sketches.groupBy(*keys).agg(*merged)


def quantiles_from(
    sketches: DataFrame,
    keys: Sequence[str],
    measured: Sequence[str] = MEASURED,
    fractions: Mapping[str, float] = QUARTILES,
) -> DataFrame:
    """Estimated quantiles by any of the sketches' keys, one row per key and measure.

    A measure without a value has NULL quantiles.
    """
    merged = sketches.groupBy(*keys).agg(
        *[F.kll_merge_agg_double(f"ranks_{c}").alias(f"ranks_{c}") for c in measured]
    )
    long = merged.unpivot(list(keys), [f"ranks_{c}" for c in measured], "measure", "ranks")
    filled = F.kll_sketch_get_n_double("ranks") > 0
    found = [
        F.when(filled, F.kll_sketch_get_quantile_double("ranks", F.lit(q))).alias(name)
        for name, q in fractions.items()
    ]
    return long.select(*keys, F.regexp_replace("measure", "^ranks_", "").alias("measure"), *found)
