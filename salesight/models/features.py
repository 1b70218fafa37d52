"""Feature stages: label indexes, one-hot vectors, assembly and standardisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import group_counts
from ..operators.ordering import running_before
from ..sources.staging import stage

CATEGORICAL = ("category", "sub_category", "region")
NUMERIC = ("quantity", "unit_price", "revenue")
LABEL = "profit"

#: Rows of a partition that models train on, about.
ROWS_EACH = 100_000

#: Labels of a column that are looked up in a broadcast, at most.
FREQUENT = 10_000


def encoding_stages(categorical: Sequence[str] = CATEGORICAL) -> list[Estimator]:
    """One indexer and one encoder for all columns.

    Labels go by frequency, ties by name. Unseen labels get an index of their own,
    the slot the encoder leaves out, so every label of the training data has one.
    """
    index = [f"{c}_idx" for c in categorical]
    vectors = [f"{c}_vec" for c in categorical]
    return [
        StringIndexer(inputCols=list(categorical), outputCols=index, handleInvalid="keep"),
        OneHotEncoder(inputCols=index, outputCols=vectors),
    ]


def feature_pipeline(
    estimator: Estimator | None = None,
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
) -> Pipeline:
    """Index, encode and assemble into ``features``; an estimator may close the chain."""
    inputs = [*numeric, *[f"{c}_vec" for c in categorical]]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    first = encoding_stages(categorical) if categorical else []
    last = [] if estimator is None else [estimator]
    return Pipeline(stages=[*first, assembler, *last])


def label_index(df: DataFrame, cols: Sequence[str] = CATEGORICAL) -> DataFrame:
    """column_name, label, label_index, row_count of every label.

    Labels go by frequency, ties by name. The index is a distributed running count over
    the counted labels, so neither the rows nor the labels meet in one place.
    """
    labels = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    counts = group_counts(
        labels.unpivot([], list(cols), "column_name", "label").where("label IS NOT NULL"),
        ["column_name", "label"],
    )
    order = [F.desc("row_count"), F.col("label")]
    placed = running_before(counts, order, F.lit(1), "label_index", ["column_name"])
    return placed.select(
        "column_name", "label", F.col("label_index").cast("int").alias("label_index"), "row_count"
    )


def encode(
    df: DataFrame, labels: DataFrame, cols: Sequence[str] = CATEGORICAL, frequent: int = FREQUENT
) -> DataFrame:
    """Add ``<column>_idx``, the index of each column's label; null for a null or unseen one.

    ``labels`` is a written table as of ``label_index``. Indexes go by frequency, so those
    below ``frequent`` are the first tier: a broadcast of that many rows serves most rows
    without a shuffle. Only rows with a rarer label are joined with the rest of the table, which
    is spread by label; no label list is on the driver or in one task.
    """
    counts = labels.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()
    n_labels = {r.column_name: r.n for r in counts}
    for c in cols:
        marked, index = f"{c}_label_", f"{c}_idx"
        own = labels.where(F.col("column_name") == c).select(
            F.col("label").alias(marked), F.col("label_index").alias(index)
        )
        value = F.col(c).cast("string")
        plain = df.columns
        first = df.join(F.broadcast(own.where(F.col(index) < frequent)), value == F.col(marked), "left")
        if n_labels.get(c, 0) > frequent:
            first = stage(first.drop(marked), "encoded").frame
            rare = F.col(index).isNull() & F.col(c).isNotNull()
            found = first.where(rare).drop(index).join(
                own.where(F.col(index) >= frequent), value == F.col(marked), "left"
            )
            first = first.where(~rare).unionByName(found.select(*plain, index))
        df = first.select(*plain, index)
    return df


def one_hot(df: DataFrame, cols: Sequence[str] = CATEGORICAL, frequent: int = FREQUENT) -> DataFrame:
    """Encode the columns; adds ``<column>_vec`` (sparse) and the index behind it.

    A NULL gets an index of its own, the slot the encoder leaves out.
    """
    table = stage(label_index(df, cols), "label-index").frame
    most = {r.column_name: r.n for r in table.groupBy("column_name").agg(F.count("*").alias("n")).collect()}
    df = encode(df, table, cols, frequent)
    for c in cols:
        index = F.coalesce(F.col(f"{c}_idx").cast("double"), F.lit(float(most.get(c, 0))))
        names = _nominal(c, most.get(c, 0) + 1)
        df = df.withColumn(f"{c}_idx", index).withMetadata(f"{c}_idx", names)
    index, vectors = [f"{c}_idx" for c in cols], [f"{c}_vec" for c in cols]
    return OneHotEncoder(inputCols=index, outputCols=vectors).fit(df).transform(df)


def _nominal(name: str, n: int) -> dict:
    """Column metadata that states the number of labels, so that the encoder need not count."""
    return {"ml_attr": {"type": "nominal", "name": f"{name}_idx", "num_vals": n}}


def one_hot_slots(df: DataFrame, cols: Sequence[str] = CATEGORICAL) -> DataFrame:
    """``df`` with the columns' vectors written out, a digit for each slot, as ``<column>_slots``."""
    found = one_hot(df, cols)
    digits = {f"{c}_slots": F.array_join(vector_to_array(f"{c}_vec").cast("array<int>"), "") for c in cols}
    return found.withColumns(digits).select(*df.columns, *digits)


def laid_out(df: DataFrame, rows_each: int = ROWS_EACH) -> DataFrame:
    """The rows in a layout that follows from them alone, kept in memory and on disk.

    Training depends on which rows share a partition and on their order (start centres,
    bags of rows, sums). Here both follow from the rows: a hash deals them into a number
    of partitions that only their count decides, and partitions are sorted.
    """
    parts = max(1, -(-df.count() // rows_each))
    dealt = df.repartition(parts, F.xxhash64(*df.columns))
    return dealt.sortWithinPartitions(*df.columns).persist()


def standardize(
    df: DataFrame, cols: Sequence[str], out: str = "features"
) -> tuple[DataFrame, object]:
    """Z-scores (sample deviation) of the columns as one vector, with the fitted scaler."""
    assembled = VectorAssembler(inputCols=list(cols), outputCol="features_raw").transform(df)
    scaler = StandardScaler(inputCol="features_raw", outputCol=out, withMean=True, withStd=True)
    model = scaler.fit(assembled)
    return model.transform(assembled), model


def scores_as_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Vector elements as scalar columns."""
    values = vector_to_array(vector)
    return df.withColumns({name: values[i] for i, name in enumerate(names)})
