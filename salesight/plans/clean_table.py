"""The clean table as a written, partitioned table that the reports read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..operators.prepare import DATE_FORMAT, SALES_TYPES, prepare_sales
from ..operators.quality import clean_sales
from ..sources.files import write_table


def write_clean_table(
    raw: DataFrame,
    path: str,
    types: Mapping[str, str] = SALES_TYPES,
    date_format: str = DATE_FORMAT,
    partition_by: Sequence[str] = ("order_year",),
    mode: str = "errorifexists",
) -> DataFrame:
    """Prepare, clean and write raw sales; returns the table to run reports on.

    Cleaning compares whole rows, so it is paid once here and not per report.
    The rebalance gathers each folder's rows into files of the advisory size and
    splits a folder that is too large for one task, whatever its share of the rows.
    """
    sales = clean_sales(prepare_sales(raw, types, date_format))
    if partition_by:
        sales = sales.hint("rebalance", *partition_by)
    write_table(sales, path, mode=mode, partition_by=partition_by)
    return raw.sparkSession.read.schema(sales.schema).parquet(path)
