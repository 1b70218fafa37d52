"""Scan and write sales tables; views and SQL over DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_sales(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "csv",
    schema: StructType | str | None = None,
    infer: bool = False,
    **options: str,
) -> DataFrame:
    """Scan raw sales files from any path Spark can reach.

    A CSV without ``schema`` is read as text columns named by its header and
    typed later by ``cast_columns``. That reads the data once and keeps columns
    the library does not know; ``infer=True`` lets Spark guess types instead, at
    the price of one more pass over all files.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", str(infer).lower())
    if schema is not None:
        reader = reader.schema(schema)
    paths = path if isinstance(path, str) else list(path)
    return reader.options(**options).load(paths)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> None:
    """Write a DataFrame; ``partition_by`` lets later scans skip whole folders."""
    writer = df.write.format(fmt).mode(mode).options(**dict(options or {}))
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def register(df: DataFrame, name: str) -> DataFrame:
    """Expose a DataFrame to SQL under a session-local view name."""
    df.createOrReplaceTempView(name)
    return df


def query(spark: SparkSession, text: str, **inputs) -> DataFrame:
    """Run SQL; DataFrames passed by keyword are addressed as ``{name}``."""
    return spark.sql(text, **inputs)


def row_count(df: DataFrame) -> DataFrame:
    """``COUNT(*)`` of a frame through SQL, as one row."""
    return query(df.sparkSession, "SELECT COUNT(*) AS row_count FROM {sales}", sales=df)
