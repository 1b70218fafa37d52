"""Connected components of links between keys, by alternating star contractions.

Neighbourhoods are reduced to their minimum before they are shuffled and are never
gathered in one row or task; adaptive execution splits the join on a hub's key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesight.llm.tables import write_table


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours, and itself, to its smallest one."""
    both = links.select("u", "v")
    if large:
        both = both.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    moved = joined.filter("v > u" if large else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()


def _is_flat(links: DataFrame) -> bool:
    """Whether links u > v are stars: every u has one link, and no v has one of its own."""
    ends = links.select(F.col("u").alias("key"), F.lit(1).alias("own"))
    ends = ends.unionByName(links.select(F.col("v").alias("key"), F.lit(0).alias("own")))
    counts = ends.groupBy("key").agg(F.sum("own").alias("own"), F.count(F.lit(1)).alias("n"))
    return counts.agg(F.count_if((F.col("own") > 1) | F.col("own").between(1, F.col("n") - 1)).alias("n")).first().n == 0


def components(links: DataFrame) -> DataFrame:
    """``u`` and ``root`` (the smallest key reachable) for every linked key but the roots.

    ``links`` has columns u and v of one comparable type; direction, repeats and links
    of a key with itself do not matter. Stars, as a former call returns them, take no pass.
    """
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = write_table(down.filter("u <> v").distinct(), "links")
    while not _is_flat(now):
        now = write_table(_star(_star(now, large=True), large=False), "links")
    return now.select("u", F.col("v").alias("root"))
