"""Data-quality checks (DataFrames out, one aggregate each) and the cleaning step."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.measures import count_where, margin_pct, percent
from .prepare import calc_revenue, date_parts, with_margin

# The columns a clean row must have, and their range rules.
REQUIRED = (
    "order_id",
    "order_date_parsed",
    "category",
    "sub_category",
    "product_name",
    "region",
    "state",
    "quantity",
    "unit_price",
    "revenue",
    "profit",
)
POSITIVE = ("quantity", "unit_price")
NON_NEGATIVE = ("revenue", "profit")
MEASURES = ("quantity", "unit_price", "revenue", "profit")

# Date parts, which follow from the parsed date and so need no comparing or shuffling.
DERIVED = ("order_year", "order_month", "order_year_month")


def preview(
    df: DataFrame, n: int = 10, cols: Sequence[str] | None = None, ordered: bool = False
) -> DataFrame:
    """First ``n`` rows as they come; ``ordered`` takes them in the order of the columns,
    which reads the whole table."""
    shown = df.select(*cols) if cols else df
    return (shown.orderBy(*shown.columns) if ordered else shown).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, type, nullability and null rows (one scan)."""
    fields = df.schema.fields
    described = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.nullable).alias("nullable"),
                F.col(f"_{i}").alias("null_rows"),
            )
            for i, f in enumerate(fields)
        ]
    )
    nulls = [count_where(F.col(f"`{f.name}`").isNull()).alias(f"_{i}") for i, f in enumerate(fields)]
    return df.agg(*nulls).select(F.inline(described))


def size_gate(df: DataFrame, min_rows: int = 100_000, min_cols: int = 10) -> DataFrame:
    """Row and column counts, each with a strictly-greater-than check."""
    width = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(width).alias("column_count"),
        (F.col("row_count") > min_rows).alias("enough_rows"),
        F.lit(width > min_cols).alias("enough_columns"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column as one wide row."""
    return df.agg(*[count_where(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def _repeats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Total, distinct and surplus rows of a column tuple; a NULL counts as a value.

    Counting copies before the shuffle keeps a heavily repeated tuple to one
    partial row per task.
    """
    copies = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    return _repeats(df, df.columns)


def duplicate_keys(df: DataFrame, key: str = "order_id") -> DataFrame:
    return _repeats(df, [key]).toDF("total_keys", "distinct_keys", "duplicate_keys")


def bad_dates(df: DataFrame, parsed: str = "order_date_parsed") -> DataFrame:
    """Rows whose date did not parse."""
    return df.agg(count_where(F.col(parsed).isNull()).alias("bad_date_rows"))


def range_profile(df: DataFrame, cols: Sequence[str] = MEASURES) -> DataFrame:
    """Minimum and maximum of each measure as one wide row."""
    bounds = [(f"{name}_{c}", fn(c)) for c in cols for name, fn in (("min", F.min), ("max", F.max))]
    return df.agg(*[value.alias(name) for name, value in bounds])


def revenue_mismatch(df: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Rows whose revenue differs from quantity times price by more than the tolerance."""
    gap = F.abs(calc_revenue() - F.col("revenue").cast("double"))
    return df.agg(count_where(gap > tolerance).alias("mismatch_rows"))


def margin_sanity(df: DataFrame) -> DataFrame:
    """Extreme row margins, and rows that earn more than they sell."""
    margin = F.round(margin_pct(), 2)
    return df.agg(
        F.min(margin).alias("min_margin_pct"),
        F.max(margin).alias("max_margin_pct"),
        count_where(F.col("profit") > F.col("revenue")).alias("profit_exceeds_revenue_rows"),
    )


def fd_violations(
    df: DataFrame,
    determinant: str = "product_name",
    dependent: str = "category",
    out: str = "distinct_categories",
) -> DataFrame:
    """Determinant values that occur with more than one dependent value."""
    return (
        df.groupBy(determinant)
        .agg(F.count_distinct(dependent).alias(out))
        .where(F.col(out) > 1)
    )


def filter_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def distinct_tuples(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def product_lookup(
    df: DataFrame,
    names: Sequence[str],
    cols: Sequence[str] = ("product_name", "category", "sub_category"),
) -> DataFrame:
    """Where chosen products sit in the hierarchy."""
    return distinct_tuples(filter_in(df, "product_name", names), cols)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _present(df: DataFrame, cols: Sequence[str]) -> Column:
    """Every column holds a value; NaN is none."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    missing = [~F.isnan(c) for c in cols if c in floats]
    return _all([F.col(c).isNotNull() for c in cols] + missing)


def _in_range(positive: Sequence[str], non_negative: Sequence[str]) -> Column:
    return _all([F.col(c) > 0 for c in positive] + [F.col(c) >= 0 for c in non_negative])


def require_non_null(df: DataFrame, cols: Sequence[str] = REQUIRED) -> DataFrame:
    return df.where(_present(df, cols))


def filter_ranges(
    df: DataFrame,
    positive: Sequence[str] = POSITIVE,
    non_negative: Sequence[str] = NON_NEGATIVE,
) -> DataFrame:
    return df.where(_in_range(positive, non_negative))


def _base_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in DERIVED]


def valid_rows(df: DataFrame) -> DataFrame:
    """Complete rows within range, without the derived date parts; repeats stay."""
    return filter_ranges(require_non_null(df.select(*[f"`{c}`" for c in _base_columns(df)])))


def clean_sales(df: DataFrame) -> DataFrame:
    """Drop incomplete and out-of-range rows and repeated rows; add date parts and margin.

    A margin column of the input counts when rows are compared and is computed anew
    afterwards. Filters come before the de-duplication, so rejected rows are never shuffled,
    and derived columns come after it, so they are not shuffled either. Rows with
    zero revenue stay, with a NULL margin. The de-duplication has to compare whole
    rows: write its result once and run reports on the written table.
    """
    return with_margin(date_parts(valid_rows(df).dropDuplicates()))


def cleaning_report(df: DataFrame) -> DataFrame:
    """Rows before and after cleaning, rows removed and removal in percent.

    One pass: equal rows collapse with their count, then each distinct row adds
    its copies to the total and one to the kept rows if it passes the rules.
    """
    base = _base_columns(df)
    copies = df.groupBy(*base).agg(F.count(F.lit(1)).alias("copies"))
    valid = _present(df, REQUIRED) & _in_range(POSITIVE, NON_NEGATIVE)
    return (
        copies.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
            count_where(valid).alias("rows_after"),
        )
        .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
        .withColumn(
            "removal_pct", F.round(percent(F.col("rows_removed"), F.col("rows_before")), 2)
        )
    )
