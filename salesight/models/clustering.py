"""Transaction clusters: elbow sweep, assignment, profiles and a 2-D projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import (
    crosstab_counts,
    dominant_value,
    group_counts,
    group_profile,
    profile_with_dominant,
)
from ..operators.quality import require_non_null
from ..operators.sampling import sample_rows
from ..sources.staging import stage
from . import lloyd
from .features import laid_out, standardize

# Clustering features and settings.
FEATURES = ("revenue", "profit", "quantity", "unit_price", "profit_margin_pct")
ELBOW = range(2, 9)
CLUSTERS = 4
SEED = 42
SAMPLE_FRACTION = 0.05

# Output columns of profiles.
AVERAGES = {
    "avg_revenue": "revenue",
    "avg_profit": "profit",
    "avg_quantity": "quantity",
    "avg_unit_price": "unit_price",
}


def cluster_input(sales: DataFrame, keep: Sequence[str] = ("order_id", "category")) -> DataFrame:
    """Staged rows with complete features, plus the standardised vector.

    K-Means re-reads its input per iteration: the narrow table is written once and
    kept in a layout that follows from its rows, so the same data gives the same start
    centres on any cluster, and all fits share one copy.
    """
    numbers = [F.col(c).cast("double").alias(c) for c in FEATURES]
    narrow = require_non_null(sales, FEATURES).select(*keep, *numbers)
    rows = laid_out(stage(narrow, "clusters").frame)
    return standardize(rows, FEATURES)[0].drop("features_raw")


def cluster_points(sales: DataFrame, keep: Sequence[str] = ("order_id", "category")) -> DataFrame:
    """Staged rows with complete features, plus ``z``, their scores in millionths."""
    numbers = [F.col(c).cast("double").alias(c) for c in FEATURES]
    narrow = stage(require_non_null(sales, FEATURES).select(*keep, *numbers), "clusters").frame
    return stage(lloyd.fixed_points(narrow, FEATURES), "points").frame


def kmeans_elbow(points: DataFrame, ks: Sequence[int] = ELBOW, steps: int = lloyd.STEPS) -> DataFrame:
    """Within-cluster sum of squares per k; a step of all fits is one scan of the points."""
    cost = lloyd.fit(points, ks, steps)[1]
    listed = [(k, float(cost[k])) for k in ks]
    return points.sparkSession.createDataFrame(listed, "k int, wcss double").orderBy("k")


def kmeans_assign(points: DataFrame, k: int = CLUSTERS, steps: int = lloyd.STEPS) -> DataFrame:
    """Add the cluster number as ``prediction``."""
    return lloyd.assign(points, lloyd.fit(points, [k], steps)[0][k])


def kmeans_facts(rows: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> DataFrame:
    """What must hold of any fit, as one row: rows clustered, rows in all clusters, rows not
    at their nearest centre, and the relative gap of the reported cost to the distances."""
    model = KMeans(featuresCol="features", k=k, seed=seed).fit(rows)
    placed = model.transform(rows).select("prediction", vector_to_array("features").alias("z"))
    centres = [[float(x) for x in c] for c in model.clusterCenters()]

    def distance(centre: Sequence[float]) -> Column:
        return sum((F.col("z")[i] - F.lit(x)) ** 2 for i, x in enumerate(centre))

    distances = F.array(*map(distance, centres))
    placed = placed.select("prediction", distances.alias("d"))
    sizes = placed.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("d")[F.col("prediction")] > F.array_min("d") + 1e-9).alias("off"),
        F.sum(F.col("d")[F.col("prediction")]).alias("cost"),
    )
    cost = F.lit(float(model.summary.trainingCost))
    return sizes.agg(
        F.lit(sum(model.summary.clusterSizes)).cast("bigint").alias("rows_clustered"),
        F.sum("n").alias("rows_in_clusters"),
        F.sum("off").alias("rows_off_centre"),
        F.round(F.abs(F.sum("cost") - cost) / cost, 6).alias("cost_gap"),
    )


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    return group_counts(clustered, ["prediction"], "row_count").orderBy("prediction")


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Size and mean measures per cluster, highest mean revenue first."""
    means = {**AVERAGES, "avg_margin_pct": "profit_margin_pct"}
    profile = group_profile(clustered, "prediction", means)
    return profile.withColumnRenamed("prediction", "cluster").orderBy(
        F.desc("avg_revenue"), "cluster"
    )


def cluster_category_counts(clustered: DataFrame) -> DataFrame:
    """Rows per cluster and category, largest first inside a cluster."""
    counts = crosstab_counts(clustered, "prediction", "category")
    return counts.withColumnRenamed("prediction", "cluster").orderBy(
        "cluster", F.desc("cnt"), "category"
    )


def cluster_profile_with_category(clustered: DataFrame) -> DataFrame:
    """Cluster profile with the category most of its rows belong to."""
    means = {**AVERAGES, "avg_profit_margin_pct": "profit_margin_pct"}
    profile = group_profile(clustered, "prediction", means)
    dominant = dominant_value(clustered, "prediction", "category")
    return profile_with_dominant(profile, dominant, "prediction").orderBy("prediction")


def silhouette(clustered: DataFrame) -> DataFrame:
    """One row: the mean silhouette (squared Euclidean distance) of the assignment."""
    return lloyd.silhouette(clustered)


def pca_scores(clustered: DataFrame, k: int = 2) -> DataFrame:
    """Principal-component scores beside the cluster and the money columns."""
    names = [f"pc{i + 1}" for i in range(k)]
    scored = lloyd.project(clustered, lloyd.principal(clustered, k)[0], names)
    kept = [c for c in ("order_id",) if c in clustered.columns]
    return scored.select(
        *kept, *names, F.col("prediction").alias("cluster"), "revenue", "profit", "profit_margin_pct"
    )


def pca_variance(points: DataFrame, k: int = 2) -> DataFrame:
    """Share of variance per principal component."""
    listed = [(i + 1, float(v)) for i, v in enumerate(lloyd.principal(points, k)[1])]
    return points.sparkSession.createDataFrame(
        listed, "component int, explained_variance double"
    ).orderBy("component")


def vector_pca_variance(rows: DataFrame, k: int = 2) -> DataFrame:
    """The same of a vector column ``features`` of any width, by Spark's own PCA."""
    fitted = PCA(k=k, inputCol="features", outputCol="pca_features").fit(rows)
    listed = [(i + 1, float(v)) for i, v in enumerate(fitted.explainedVariance.toArray())]
    return rows.sparkSession.createDataFrame(
        listed, "component int, explained_variance double"
    ).orderBy("component")


def pca_feed(
    scores: DataFrame,
    fraction: float = SAMPLE_FRACTION,
    cap: int | None = None,
    seed: int = SEED,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Sampled scatter points for a chart; ``cap`` limits them to the first ones by hash."""
    return sample_rows(scores, fraction, seed, cap, keys)
