"""Header normalisation, typing, dates and derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.labels import PRICE_CUTS, price_tier
from ..functions.measures import margin_pct

# Input column types and the text format of order dates.
SALES_TYPES = {
    "order_id": "bigint",
    "quantity": "int",
    "unit_price": "double",
    "revenue": "double",
    "profit": "double",
}
DATE_FORMAT = "MM-dd-yy"

WHOLE = ("bigint", "int")

# The same columns with exact money, for sums that do not depend on task order.
EXACT_SALES_TYPES = {**SALES_TYPES, "revenue": "decimal(12,2)", "profit": "decimal(18,4)"}


def snake_case(name: str) -> str:
    return "_".join(name.split()).lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Trim headers, join words with ``_`` and lower-case them.

    Two headers that end up equal are an error, not an ambiguous column.
    """
    names = [snake_case(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"headers collide after normalisation: {clashes}")
    return df.toDF(*names)


def _typed(df: DataFrame, column: str, kind: str) -> Column:
    """Text of a whole number may carry decimals (``3.0``); they are cut off."""
    value = F.col(column)
    if kind in WHOLE and isinstance(df.schema[column].dataType, StringType):
        value = value.try_cast("decimal(38,6)")
    return value.try_cast(kind)


def cast_columns(df: DataFrame, types: Mapping[str, str] = SALES_TYPES) -> DataFrame:
    """Type the named columns; values that do not parse become NULL, others stay untouched."""
    return df.withColumns({c: _typed(df, c, t) for c, t in types.items() if c in df.columns})


def parse_date(
    df: DataFrame,
    column: str = "order_date",
    fmt: str = DATE_FORMAT,
    out: str = "order_date_parsed",
) -> DataFrame:
    """Parse a text date; text that is no date becomes NULL and can be counted."""
    return df.withColumn(out, F.try_to_date(F.col(column), fmt))


def date_parts(df: DataFrame, column: str = "order_date_parsed", prefix: str = "order") -> DataFrame:
    """Year, month and the ``yyyy-MM`` month key of a date column."""
    day = F.col(column)
    return df.withColumns(
        {
            f"{prefix}_year": F.year(day),
            f"{prefix}_month": F.month(day),
            f"{prefix}_year_month": F.date_format(day, "yyyy-MM"),
        }
    )


def with_margin(df: DataFrame, out: str = "profit_margin_pct") -> DataFrame:
    """Row margin in percent, two decimals; NULL where revenue is zero."""
    return df.withColumn(out, F.round(margin_pct(), 2))


def calc_revenue() -> Column:
    """Quantity times unit price, two decimals."""
    return F.round(F.col("quantity") * F.col("unit_price"), 2)


def with_calc_revenue(df: DataFrame, out: str = "calc_revenue") -> DataFrame:
    return df.withColumn(out, calc_revenue())


def with_price_tier(
    df: DataFrame, cuts: Sequence[float] = PRICE_CUTS, out: str = "price_tier"
) -> DataFrame:
    return df.withColumn(out, price_tier(F.col("unit_price"), cuts))


def prepare_sales(
    raw: DataFrame, types: Mapping[str, str] = SALES_TYPES, fmt: str = DATE_FORMAT
) -> DataFrame:
    """Raw scan to typed sales rows with date columns (nothing is dropped)."""
    return date_parts(parse_date(cast_columns(snake_case_columns(raw), types), fmt=fmt))
