"""Descriptive statistics as a typed long table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .ordering import running_before

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
DESCRIBED = ("quantity", "unit_price", "revenue", "profit", "profit_margin_pct")
#: Finest accuracy of Spark's digests, which one task a measure merges.
DIGEST_ACCURACY = 10_000


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    return numbers.unpivot([], list(cols), "measure", "value").where(F.col("value").isNotNull())


def _moments() -> list[Column]:
    return [
        F.count("value").alias("row_count"),
        F.avg("value").alias("mean"),
        F.stddev("value").alias("stddev"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]


def _approximate(long: DataFrame, accuracy: int) -> DataFrame:
    wanted = F.percentile_approx("value", list(QUARTILES.values()), accuracy)
    stats = long.groupBy("measure").agg(*_moments(), wanted.alias("_q"))
    return stats.withColumns({name: F.col("_q")[i] for i, name in enumerate(QUARTILES)}).drop("_q")


def _exact(rows: DataFrame, cols: Sequence[str], accuracy: int, between: bool = True) -> DataFrame:
    """True quartiles from the few rows around the approximate ones; without ``between``
    the value at the quartile's rank, rounded up, instead of a mean of two neighbours.

    An approximate percentile is off by at most 1 / ``accuracy`` of the rows, so the
    two that lie twice as far to either side bracket a quartile; where that is less than
    a few rows, the extremes do. One more scan counts the rows below each bracket and
    keeps those inside; only these are put in order.
    """
    long = _long(stage(rows, "measures").frame, cols)
    wide = 2 / accuracy
    ends = [end for q in QUARTILES.values() for end in (max(0.0, q - wide), min(1.0, q + wide))]
    found = F.percentile_approx("value", ends, accuracy)
    # One row per described column, read several times.
    stats = stage(long.groupBy("measure").agg(*_moments(), found.alias("_ends")), "moments").frame

    n, few = F.col("row_count"), F.col("row_count") < 4 * accuracy

    def place(fraction: float) -> Column:
        return (n - 1) * F.lit(fraction) if between else F.greatest(F.ceil(n * F.lit(fraction)) - 1.0, F.lit(0.0))

    brackets = F.array(
        *[
            F.struct(
                F.lit(name).alias("quartile"),
                place(fraction).alias("place"),
                F.when(few, F.col("min")).otherwise(F.col("_ends")[2 * i]).alias("low"),
                F.when(few, F.col("max")).otherwise(F.col("_ends")[2 * i + 1]).alias("high"),
            )
            for i, (name, fraction) in enumerate(QUARTILES.items())
        ]
    )
    bracketed = long.join(F.broadcast(stats.select("measure", brackets.alias("b"))), "measure")
    numbers = range(len(QUARTILES))
    below = bracketed.groupBy("measure").agg(
        *[F.count_if(F.col("value") < F.col("b")[i]["low"]).alias(f"_{i}") for i in numbers]
    )
    below = below.select(
        "measure",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("quartile"), F.col(f"_{i}").alias("below"))
                    for i, name in enumerate(QUARTILES)
                ]
            )
        ),
    )
    held = F.filter("b", lambda e: F.col("value").between(e["low"], e["high"]))
    inside = bracketed.select("measure", "value", F.explode(held).alias("e")).groupBy(
        "measure", F.col("e.quartile").alias("quartile"), F.col("e.place").alias("place"), "value"
    )
    counts = inside.agg(F.count(F.lit(1)).alias("n"))
    placed = running_before(counts, [F.col("value")], F.col("n"), "ahead", ["measure", "quartile"])
    placed = placed.join(F.broadcast(below), ["measure", "quartile"])
    first = F.col("below") + F.col("ahead")

    def at(position: Column) -> Column:
        covers = (position >= first) & (position < first + F.col("n"))
        return F.max(F.when(covers, F.col("value")))

    low, high = at(F.floor("place")), at(F.ceil("place"))
    values = placed.groupBy("measure", "quartile").agg(
        (low + (high - low) * F.max(F.col("place") - F.floor("place"))).alias("value")
    )
    table = values.groupBy("measure").agg(
        *[F.max(F.when(F.col("quartile") == name, F.col("value"))).alias(name) for name in QUARTILES]
    )
    return stats.drop("_ends").join(table, "measure")


def describe(
    df: DataFrame,
    cols: Sequence[str] = DESCRIBED,
    exact: bool = False,
    accuracy: int = DIGEST_ACCURACY,
) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of each measure.

    The default reads the data once with approximate quartiles of the given
    accuracy; ``exact`` interpolates true quartiles and costs two more scans of the
    described columns. An accuracy finer than 10,000 would have one task merge digests of
    that length for each measure; the values at the quartiles' ranks are found as the exact
    quartiles are instead.
    """
    numbers = df.select(*cols)
    if exact:
        stats = _exact(numbers, cols, accuracy)
    elif accuracy > DIGEST_ACCURACY:
        stats = _exact(numbers, cols, DIGEST_ACCURACY, between=False)
    else:
        stats = _approximate(_long(numbers, cols), accuracy)
    return stats.select(
        "measure", "row_count", "mean", "stddev", "min", "q25", "q50", "q75", "max"
    )
