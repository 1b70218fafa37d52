"""Ranks, tiles, running totals, lags and top-k that hold at any number of groups.

A window without partition keys sorts everything in one task, so none is used on
rows. Instead, always: rows are range-partitioned over the whole sort order (ties are
split by its last keys), every slice sums up on its own, and the slice totals give
each slice its start. The session's shuffle partitions set the number of slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import percent
from ..sources.staging import Staged, settle, stage


def _descending(column: str) -> Column:
    return F.col(column).desc_nulls_last()


def _join_same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys where NULL equals NULL; keys appear once."""
    marked = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(marked, reduce(lambda a, b: a & b, same)).drop(*[f"_r_{k}" for k in keys])


def running_before(
    df: DataFrame | Staged,
    order: Sequence[Column],
    weight: Column,
    out: str,
    partition_by: Sequence[str] = (),
    total: str | None = None,
) -> DataFrame:
    """Add the total weight of all rows that sort before each row, by group if there are any.

    ``order`` must be total (end it with a key) for the result to be unique. ``total``
    names a column for the weight of all rows (of the group).
    """
    frame = df.frame if isinstance(df, Staged) else df
    groups = list(partition_by)
    ranged = frame.repartitionByRange(*[F.col(k).asc_nulls_first() for k in groups], *order)
    # Written, so that totals and rows are sure to see the same slices.
    cut = stage(ranged.withColumn("_slice", F.spark_partition_id()), "slices").frame
    before = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_slice", *groups).orderBy(*order).rowsBetween(*before)
    rows = cut.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    # One row per slice and group in it: without groups, one for each shuffle partition.
    totals = cut.groupBy("_slice", *groups).agg(F.sum(weight).alias("_weight"))
    group = Window.partitionBy(*groups)
    earlier = F.sum("_weight").over(group.orderBy("_slice").rowsBetween(*before))
    figures = {"_start": F.coalesce(earlier, F.lit(0))}
    if total:
        figures["_total"] = F.sum("_weight").over(group)
    starts = totals.withColumns(figures).drop("_weight")
    placed = _join_same(rows, starts, ["_slice", *groups])
    added = [(F.col("_start") + F.col("_inside")).alias(out)]
    if total:
        added.append(F.col("_total").alias(total))
    return placed.select(*frame.columns, *added)


def _rank_table(
    frame: DataFrame, ranks: Mapping[str, str], partition_by: Sequence[str]
) -> list[DataFrame]:
    """For each rank its measure's distinct values (of each group) with their rank.

    Rank = 1 + rows with a larger measure, from the counts of distinct values: tied
    rows are one row here, so no tie is too large for a task. All ranks take one pass.
    """
    measures = list(ranks.values())
    types = dict(frame.dtypes)

    def entry(which: int) -> Column:
        values = [
            (F.col(m) if i == which else F.lit(None).cast(types[m])).alias(f"_v{i}")
            for i, m in enumerate(measures)
        ]
        return F.struct(F.lit(which).alias("_which"), *values)

    values = [f"_v{i}" for i in range(len(measures))]
    long = frame.select(*partition_by, F.inline(F.array(*map(entry, range(len(measures))))))
    counts = long.groupBy(*partition_by, "_which", *values).agg(F.count(F.lit(1)).alias("_n"))
    order = [_descending(v) for v in values]
    ahead = running_before(counts, order, F.col("_n"), "_ahead", [*partition_by, "_which"])
    return [
        ahead.where(F.col("_which") == i).select(
            *partition_by, F.col(f"_v{i}").alias(m), (F.col("_ahead") + 1).alias(out)
        )
        for i, (out, m) in enumerate(ranks.items())
    ]


def _join_ranks(
    rows: DataFrame, frame: DataFrame, ranks: Mapping[str, str], partition_by: Sequence[str] = ()
) -> DataFrame:
    """``rows`` with their ranks among the rows of ``frame``."""
    for table, measure in zip(_rank_table(frame, ranks, partition_by), ranks.values(), strict=True):
        rows = _join_same(rows, table, [*partition_by, measure])
    return rows


def with_ranks(
    df: DataFrame | Staged, ranks: Mapping[str, str], partition_by: Sequence[str] = ()
) -> DataFrame:
    """Add competition ranks, largest first; ``ranks`` maps output to measure."""
    frame = settle(df, "ranked").frame
    return _join_ranks(frame, frame, ranks, partition_by)


def _tile(position: str, rows: str, tiles: int) -> Column:
    """Tile of a 0-based position when the first ``rows % tiles`` tiles get one row more."""
    size, larger = f"({rows} div {tiles})", f"({rows} % {tiles})"
    split = f"({larger} * ({size} + 1))"
    in_larger = f"{position} div ({size} + 1) + 1"
    in_smaller = f"({position} - {split}) div greatest({size}, 1) + {larger} + 1"
    return F.expr(f"cast(if({position} < {split}, {in_larger}, {in_smaller}) as int)")


def with_tiles(
    df: DataFrame | Staged, tiles: Mapping[str, str], n: int, tie_break: Sequence[str]
) -> DataFrame:
    """Add equal-count tiles 1..n, largest first; ties go by the ``tie_break`` keys."""
    frame = df.frame if isinstance(df, Staged) else df
    keys = [F.col(k).asc_nulls_first() for k in tie_break]
    for out, measure in tiles.items():
        order = [_descending(measure), *keys]
        placed = running_before(frame, order, F.lit(1), "_position", total="_rows")
        frame = placed.withColumn(out, _tile("_position", "_rows", n)).drop("_position", "_rows")
    return frame


def top_with_ranks(
    df: DataFrame | Staged, k: int, order: Sequence[Column], ranks: Mapping[str, str]
) -> DataFrame:
    """The first ``k`` rows, each with its ranks among **all** rows."""
    frame = settle(df, "top").frame
    return _join_ranks(top_k(frame, k, order), frame, ranks)


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(k)


def with_growth(
    df: DataFrame, measure: str, order: str, previous: str, growth: str
) -> DataFrame:
    """Previous value in ``order`` and the change in percent (two decimals).

    For period series: the input is one row per calendar period, whose number is
    bounded by the calendar and not by the data, so one task can sort it.
    """
    series = Window.orderBy(order)
    change = percent(F.col(measure) - F.col(previous), F.col(previous))
    return df.withColumn(previous, F.lag(measure).over(series)).withColumn(
        growth, F.round(change, 2)
    )
