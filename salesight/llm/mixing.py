"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order. A document's virtual
finish time is the number of source words up to its end divided by the source's
target, so all queues advance at rates proportional to their targets. The mix is the
documents in order of finish time, truncated where the total budget is spent; the
document that a queue has in service at that time is cut there. A source whose target
exceeds its size is queued again, up to ``epochs`` times.

Rows: a null text has no words; a null source is a source of its own, ordered last; a
null id is ordered as an empty one; repeated rows are separate documents; an empty
table or one without words gives targets of 0 and nothing taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesight.llm.tables import column, free_names, write_table

WORD = r"[^\x20\x09-\x0D]+"
#: A queue is cut into this many slices of its shuffled order, each a window of its own,
#: so a source that holds a third of all rows is spread over as many tasks.
SLICE_DIGITS = 3


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, epochs: int
) -> DataFrame:
    """``target`` per row of ``sizes`` (source, source_size).

    ``weights`` repeat over the sources in code point order, null last. The budget of
    ``share`` times all sizes is dealt by weight; a target stops at ``epochs`` times its
    source's size and the excess goes to the others. With the sources in order of
    cap / weight, those up to the first unfilled one are capped, and the rest share what
    is left. One row per source: the windows over all rows are that small.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(cycle, (F.col("place") - 1) % len(weights) + 1))
        .withColumn("cap", F.lit(float(epochs)) * F.col("source_size"))
        .withColumn("fill", F.col("cap") / F.col("weight"))
    )
    by_fill = Window.orderBy("fill", "place")
    earlier = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    later = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    budget = F.lit(float(share)) * F.sum("source_size").over(everything)
    sources = sources.withColumn(
        "level",
        (budget - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
        / F.sum("weight").over(later),
    )
    unfilled = F.when(F.col("level") < F.col("fill"), F.struct("fill", "place", "level"))
    water = F.min(unfilled).over(everything).getField("level")
    target = F.coalesce(F.least("cap", F.col("weight") * water), F.col("cap"))
    return sources.withColumn("target", target).drop("place", "weight", "cap", "fill", "level")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    epochs: int = 2,
    seed: str = "mix",
    size: str = "size",
) -> DataFrame:
    """Add ``source_size``, ``target``, ``virtual_finish`` and ``taken`` to every row.

    ``docs`` has doc_id, source and words in the column ``size``; other columns pass
    through, and those of the added names are replaced. ``taken`` counts the words that the mix takes of the document, repeats included. Rows come
    range-sorted by virtual finish time, in which order the mix is read.
    """
    made = ("source_size", "target", "virtual_finish", "taken")
    docs = docs.drop(*made)
    used = [column(c) for c in docs.columns]
    queue_, order, slice_, words, start, end = free_names(
        docs, "_queue", "_order", "_slice", "_words", "_start", "_end"
    )
    queue = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.withColumns({queue_: queue, order: shuffled})
    rows = rows.withColumn(slice_, F.substring(order, 1, SLICE_DIGITS))
    slices = rows.groupBy(queue_, slice_).agg(
        F.first("source").alias("source"), F.sum(column(size)).alias(words)
    )
    slices = write_table(slices, "mix-slices")
    sizes = slices.groupBy(queue_).agg(
        F.first("source").alias("source"), F.sum(words).alias("source_size")
    )
    targets = source_targets(sizes, weights, share, epochs).drop("source")
    before = Window.partitionBy(queue_).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select(
        queue_,
        slice_,
        F.coalesce(F.sum(words).over(before), F.lit(0)).alias(start),
    ).join(targets, queue_)
    inside = (
        Window.partitionBy(queue_, slice_)
        .orderBy(order, "doc_id", column(size))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = rows.join(starts, [queue_, slice_]).withColumn(
        end, F.col(start) + F.sum(column(size)).over(inside)
    )
    quota = F.floor("target")
    taken = F.lit(0).cast("bigint")
    for epoch in range(epochs):
        left = quota - F.lit(epoch) * F.col("source_size") - (F.col(end) - column(size))
        taken = taken + F.greatest(F.lit(0).cast("bigint"), F.least(left, column(size)))
    mixed = placed.withColumns(
        {"virtual_finish": F.try_divide(F.col(end).cast("double"), "target"), "taken": taken}
    )
    return mixed.select(*used, *made).orderBy("virtual_finish", "doc_id")
