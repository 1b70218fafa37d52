"""The clean table kept in batches: bucketed by a hash of the row, history never reshuffled.

Cleaning compares whole rows, so a full run shuffles all of them. Here each batch is
cleaned by itself and then compared with the rows that share its bucket and its years:
the table is written in buckets of the row hash, within folders by year, so the history
enters the join where it lies. Only the batch moves, a year at a time: what a task sorts and
what a shuffle keeps on disk is one year's, and shuffle files go with each write. A batch that
is added again, whole or in part, adds nothing, which makes a failed run safe to repeat.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.prepare import (
    DATE_FORMAT,
    SALES_TYPES,
    date_parts,
    prepare_sales,
    with_margin,
)
from ..operators.quality import valid_rows
from ..sources.staging import SHUFFLE_CLEANUP, release, settings, stage_by

ROW_HASH = "row_hash"
MARGIN = "profit_margin_pct"
#: A margin that came with the input: it counts when rows are compared, so it is kept.
GIVEN_MARGIN = "given_margin_pct"
#: The folders of a staged batch.
YEAR = "_batch_year"


def _unseen(batch: DataFrame, history: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of the batch that the history lacks.

    Equal rows are found by their hash and then compared in all columns, NULL as a value.
    The comparison is written as two bounds: as an equality Catalyst would take it for a
    join key, and buckets by the hash alone would not do for it.
    """
    new, old = batch.alias("new"), history.alias("old").hint("merge")
    row, kept = (F.struct(*[F.col(f"{side}.`{c}`") for c in cols]) for side in ("new", "old"))
    same = (F.col(f"new.{ROW_HASH}") == F.col(f"old.{ROW_HASH}")) & (row <= kept) & (row >= kept)
    return new.join(old, same, "left_anti")


def new_rows(batch: DataFrame, history: DataFrame | None, buckets: int) -> DataFrame:
    """Distinct valid rows of a batch (with their hash) that are not in the history yet,
    dealt to the history's buckets."""
    cols = [c for c in batch.columns if c != ROW_HASH]
    dealt = batch.repartition(buckets, ROW_HASH)
    if history is None:
        return dealt
    # One value per calendar year of the batch.
    years = [r[0] for r in batch.select(F.year("order_date_parsed")).distinct().collect()]
    return _unseen(dealt, history.where(F.col("order_year").isin(years)), cols)


def add_batch(
    raw: DataFrame,
    table: str,
    buckets: int = 200,
    path: str | None = None,
    types: Mapping[str, str] = SALES_TYPES,
    date_format: str = DATE_FORMAT,
) -> DataFrame:
    """Prepare and clean raw sales and append the rows that ``table`` lacks; returns the table.

    The first batch creates the table, at ``path`` if given. Later batches must have its
    columns and name its number of buckets (Spark refuses another). The batch is shuffled
    twice: by whole rows, where repeats collapse before they move, and into its buckets, year
    by year. An empty batch adds nothing. Size ``buckets`` so that one of a year fits a task.
    """
    spark = raw.sparkSession
    valid = valid_rows(prepare_sales(raw, types, date_format))
    if MARGIN in valid.columns:
        valid = valid.withColumnRenamed(MARGIN, GIVEN_MARGIN)
    distinct = valid.dropDuplicates()
    hashed = distinct.withColumn(ROW_HASH, F.xxhash64(*[F.col(f"`{c}`") for c in valid.columns]))
    batch = stage_by(hashed.withColumn(YEAR, F.year("order_date_parsed")), YEAR, "batch")
    history = spark.table(table) if spark.catalog.tableExists(table) else None
    created = history is None
    # One value per calendar year of the batch; an empty one still creates the table.
    years = sorted(r[0] for r in batch.frame.select(YEAR).distinct().collect()) or [None]
    for year in years:
        rows = batch.frame.where(F.col(YEAR).eqNullSafe(F.lit(year))).drop(YEAR)
        writer = (
            with_margin(date_parts(new_rows(rows, history, buckets)))
            .write.format("parquet")
            .mode("append")
            .partitionBy("order_year")
            .bucketBy(buckets, ROW_HASH)
        )
        if path is not None and created:
            writer = writer.option("path", path)
        with settings(spark, **{SHUFFLE_CLEANUP: "true"}):
            writer.saveAsTable(table)
        created = False
    release(spark, batch.path)
    return clean_rows(spark.table(table))


def clean_rows(stored: DataFrame) -> DataFrame:
    """The stored table as the reports read it: without the row hash."""
    return stored.drop(ROW_HASH)
