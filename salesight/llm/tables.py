"""Written intermediate tables and the Spark calls that all corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesight.sources.staging import staged_path

#: Spark's setting that shuffle files of a query are removed when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    It cuts lineage and survives lost executors: a later stage reads files again
    instead of running its inputs again. So the write's shuffle files go at its end, not
    when the driver happens to collect its garbage.
    """
    spark, path = df.sparkSession, staged_path(df.sparkSession, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(
    df: DataFrame,
    step: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` with a function of one batch; Spark bounds a batch in rows and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from step(batch)

    return df.mapInArrow(run, schema)


def text_key(text: Column) -> Column:
    """A hash that tells rows of one document id but different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def column(name: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, lengthened where ``df`` has such a column."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def records(**columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def pack_texts(docs: DataFrame) -> DataFrame:
    """doc_id, tk (see ``text_key``) and the text compressed, for a join that moves whole texts."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        packed = [squeeze((t.as_py() or "").encode()) for t in batch.column(2)]
        yield records(
            doc_id=batch.column(0), tk=batch.column(1), packed=pa.array(packed, pa.binary())
        )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("tk"), "text")
    return map_batches(rows, step, "doc_id bigint, tk bigint, packed binary")


def unpack(packed: object) -> str:
    """The text of a packed value of Arrow."""
    return zstandard.ZstdDecompressor().decompress(packed.as_py()).decode("utf-8", "replace")
