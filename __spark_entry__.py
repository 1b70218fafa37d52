"""

Every query reads the star-schema tables of ``sf_dir`` and works on all of their
rows. Production jobs would write the clean table once and run the reports on it;
here each query stands alone and cleans for itself.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from salesight.models import clustering, features, regression  # noqa: E402
from salesight.operators import aggregate, describe, prepare, quality  # noqa: E402
from salesight.operators import cube, sampling, sketches  # noqa: E402
from salesight.operators.benchmark import overall_margin, with_benchmark  # noqa: E402
from salesight.plans import incremental, overviews, reports  # noqa: E402
from salesight.session import tune  # noqa: E402
from salesight.sources import files, rejects, star  # noqa: E402
from salesight.sources.staging import stage, staged_path  # noqa: E402

try:
    import corpus_pipeline
    from salesight.llm import queries as corpus
except ModuleNotFoundError as error:  # the training-data operators are an optional part
    if (error.name or "").split(".")[0] not in ("corpus_pipeline", "salesight"):
        raise
    corpus = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
HIGHER_CUTS = (1500, 3500)
BATCH_BUCKETS = 8
#: Bytes of input files for each bucket, beyond ``BATCH_BUCKETS`` of them: a bucket of a year fits a task.
BATCH_BYTES = 32 << 20
LOOKED_UP = ("small ring", "red widget")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.sales_raw(tune(spark), sf_dir)


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_sales(raw(spark, sf_dir), prepare.EXACT_SALES_TYPES)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_sales(typed(spark, sf_dir))


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.snake_case_columns(raw(spark, sf_dir))


def _money_as_double(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in ("revenue", "profit")})


def _scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staged_path(spark, "csv")
    files.write_table(raw(spark, sf_dir), path, fmt="csv")
    scanned = prepare.snake_case_columns(files.read_sales(spark, path))
    return prepare.cast_columns(scanned)


def _scan_csv_decimal_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV scan where whole numbers are written with decimals."""
    path = staged_path(spark, "csv")
    dotted = {c: F.concat(F.col(c).cast("string"), F.lit(".0")) for c in ("Order ID", "Quantity")}
    files.write_table(raw(spark, sf_dir).withColumns(dotted), path, fmt="csv")
    return prepare.cast_columns(prepare.snake_case_columns(files.read_sales(spark, path)))


def _cast_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _named(spark, sf_dir)
    return prepare.cast_columns(named.select(*[F.col(c).cast("string") for c in named.columns]))


def _range_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = quality.range_profile(typed(spark, sf_dir))
    return bounds.select(*[F.col(c).cast("double").alias(c) for c in bounds.columns])


def _region_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = ["region", "category", *clustering.AVERAGES.values()]
    sales = stage(clean(spark, sf_dir).select(*used), "profiled").frame
    profile = aggregate.group_profile(sales, "region", clustering.AVERAGES)
    dominant = aggregate.dominant_value(sales, "region", "category")
    return aggregate.profile_with_dominant(profile, dominant, "region")


def _describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_figures(describe.describe(clean(spark, sf_dir), exact=True))


def _rounded_figures(stats: DataFrame) -> DataFrame:
    figures = [c for c in stats.columns if c not in ("measure", "row_count")]
    return stats.withColumns({c: F.round(c, 4) for c in figures})


def _standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"z_{c}" for c in clustering.FEATURES]
    rows = clustering.cluster_input(clean(spark, sf_dir))
    scored = features.scores_as_columns(rows, "features", names)
    return scored.select("order_id", *[F.round(c, 6).alias(c) for c in names])


def _baseline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error figures of two predictors that SQL can state as well."""
    figures = {
        "rate": overall_margin("profit", "revenue") / 100,
        "mean_profit": F.avg(F.col("profit").cast("double")),
    }
    money = stage(clean(spark, sf_dir).select("revenue", "profit"), "money").frame
    rows = with_benchmark(money, figures)
    rows = rows.withColumn("expected", F.col("revenue").cast("double") * F.col("rate"))
    predictors = {"overall_margin": "expected", "mean_profit": "mean_profit"}
    found = regression.regression_metrics(rows, predictors)
    return found.select(
        "model",
        F.round("rmse", 4).alias("rmse"),
        F.round("mae", 4).alias("mae"),
        (F.round("r2", 6) + 0.0).alias("r2"),
    )


SPLIT_KEYS = ("order_id", "product_name", "state", "quantity")


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean(spark, sf_dir).select(*SPLIT_KEYS)
    return sampling.train_test_split(rows, keys=SPLIT_KEYS)


def _linear_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profit by revenue alone, on the training rows."""
    train = regression.part(regression.regression_input(clean(spark, sf_dir), keys=SPLIT_KEYS), "train")
    found = regression.linear_coefficients(regression.fit_linear(train, ["revenue"], []), ["revenue"])
    return found.select(F.round("intercept", 3).alias("intercept"), F.round("revenue", 6).alias("slope"))


def _pca_variance_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of two standardised features: their shares follow from the correlation."""
    rows = clustering.cluster_input(clean(spark, sf_dir)).drop("features")
    two = features.standardize(rows, ["revenue", "profit"])[0]
    found = clustering.vector_pca_variance(two)
    return found.withColumn("explained_variance", F.round("explained_variance", 6))


def _describe_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate quartiles at an accuracy at which they are values of the table."""
    return _rounded_figures(describe.describe(clean(spark, sf_dir), accuracy=10_000_000))


def _pca_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = clustering.pca_feed(clustering.pca_scores(_clustered(spark, sf_dir)), keys=["order_id"])
    return points.select("order_id", "revenue", "profit", "profit_margin_pct")


def _predict_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regression.regression_input(clean(spark, sf_dir))
    scored = regression.fit_forest(regression.part(rows, "train")).transform(regression.part(rows, "test"))
    return scored.select(*regression.INPUTS, "prediction")


def _linear_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regression.regression_input(clean(spark, sf_dir), keys=SPLIT_KEYS)
    return regression.predict_linear(rows).select(*regression.INPUTS, "prediction")


def _linear_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = regression.regression_metrics(_linear_predictions(spark, sf_dir), {"LinearRegression": "prediction"})
    return found.select("model", *[F.round(c, n).alias(c) for c, n in (("rmse", 4), ("mae", 4), ("r2", 6))])


def _model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regression.regression_input(clean(spark, sf_dir))
    names = {"LinearRegression": "linear", "RandomForestRegressor": "forest"}
    return regression.regression_metrics(regression.compare_models(rows), names)


def _importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regression.regression_input(clean(spark, sf_dir))
    model = regression.fit_forest(regression.part(rows, "train"))
    return regression.feature_importance(model, regression.part(rows, "train"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_input(clean(spark, sf_dir))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_points(clean(spark, sf_dir))


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.kmeans_assign(_points(spark, sf_dir))


def _rounded(operator: Callable[..., DataFrame], figures: dict[str, int]) -> Callable[..., DataFrame]:
    """An operator whose sums of doubles are rounded, as their order differs between engines."""
    return lambda df: operator(df).withColumns({c: F.round(c, n) + 0.0 for c, n in figures.items()})


def _on(source: Query, operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    """A query that applies one operator to one source."""
    return lambda spark, sf_dir: operator(source(spark, sf_dir), *args, **kwargs)


def _clean_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table in two batches that overlap, each repeating rows of its own."""
    rows, order = raw(spark, sf_dir), F.col("`Order ID`")
    table, path = f"sales_{uuid.uuid4().hex}", staged_path(spark, "batches")
    buckets = max(BATCH_BUCKETS, -(-star.sales_bytes(spark, sf_dir) // BATCH_BYTES))
    for part in (order % 3 != 0, (order % 3 == 0) | (order % 2 == 0)):
        stored = incremental.add_batch(
            rows.where(part), table, buckets, path, prepare.EXACT_SALES_TYPES
        )
    found = spark.read.schema(stored.schema).parquet(path)
    spark.sql(f"DROP TABLE {table}")  # the name only: the files are the staging folder's
    return _money_as_double(found)


def _cube(spark: SparkSession, sf_dir: str) -> cube.KpiCube:
    return cube.write_cube(clean(spark, sf_dir), staged_path(spark, "cube"))


def _cube_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cube.build_cube(clean(spark, sf_dir))
    return aggregate.rounded(found, ["total_revenue", "total_profit"])


def _planted_csv(spark: SparkSession, sf_dir: str) -> rejects.Scan:
    """Two CSV tables, one without states, with lines of a field too many and wrong values."""
    order = F.col("`Order ID`")
    rows = raw(spark, sf_dir).withColumns(
        {
            "Product Name": F.when(order % 43 == 0, F.concat("Product Name", F.lit(",x"))).otherwise(F.col("Product Name")),
            "Quantity": F.when(order % 47 == 0, F.lit("many")).otherwise(F.col("Quantity").cast("string")),
        }
    )
    rows, paths = stage(rows, "planted").frame, [staged_path(spark, "csv") for _ in range(2)]
    unquoted = {"quote": "\u0000"}
    files.write_table(rows.where(order % 2 == 0), paths[0], fmt="csv", options=unquoted)
    files.write_table(rows.where(order % 2 != 0).drop("State"), paths[1], fmt="csv", options=unquoted)
    return rejects.scan_with_rejects(spark, paths)


def _scan_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _planted_csv(spark, sf_dir).rejects
    return found.select(F.split("line", ",")[0].cast("bigint").alias("order_id"), "reason")


def _within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct products and orders by region, and whether sketches by day come near."""
    rows = stage(clean(spark, sf_dir).select(*sketches.COUNTED, *sketches.MEASURED, sketches.DAY, "category", "region"), "sold").frame
    days = stage(sketches.daily_sketches(rows), "days").frame
    exact = rows.groupBy("region").agg(*[F.count_distinct(c).alias(f"exact_{c}") for c in sketches.COUNTED])
    near = [
        (F.abs(F.col(f"distinct_{c}") - F.col(f"exact_{c}")) <= 0.06 * F.col(f"exact_{c}")).alias(f"near_{c}")
        for c in sketches.COUNTED
    ]
    both = exact.join(sketches.distinct_from(days, ["region"]), "region")
    return both.select("region", *[f"exact_{c}" for c in sketches.COUNTED], *near)


REPORTS = {
    "q01": reports.q01_category_ranking,
    "q02": reports.q02_region_strength,
    "q03": reports.q03_top_products,
    "q04": reports.q04_volume_without_margin,
    "q05": reports.q05_margin_ranking,
    "q06": reports.q06_price_tiers,
    "q07": reports.q07_share_without_margin,
    "q08": reports.q08_monthly_growth,
    "q09": reports.q09_region_category,
    "q10": reports.q10_state_segments,
    "q11": reports.q11_product_actions,
    "q12": reports.q12_corrective_actions,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: products and regions that need corrective action."""
    return reports.q12_corrective_actions(clean(spark, SMOKE_DIR))


def queries() -> dict[str, Query]:
    chart = overviews.chart_by_dimension
    found: dict[str, Query] = {
        # scans, prepared columns and profile of the raw table
        "scan_csv": _scan_csv,
        "scan_csv_decimal_text": _scan_csv_decimal_text,
        "snake_case": _on(_named, _money_as_double),
        "cast_types": _cast_types,
        "row_count": _on(_named, files.row_count),
        "clean_row_count": _on(clean, files.row_count),
        "size_gate": _on(raw, quality.size_gate),
        "preview": _on(_named, lambda df: _money_as_double(quality.preview(df, ordered=True))),
        "schema_report": _on(typed, quality.schema_report),
        "parse_dates": _on(
            typed,
            lambda df: df.select(
                "order_id", "order_date", "order_date_parsed",
                "order_year", "order_month", "order_year_month",
            ),
        ),
        "null_counts": _on(_named, quality.null_counts),
        "duplicate_rows": _on(_named, quality.duplicate_rows),
        "duplicate_keys": _on(_named, quality.duplicate_keys),
        "bad_dates": _on(typed, quality.bad_dates),
        "range_profile": _range_profile,
        "revenue_mismatch": _on(typed, quality.revenue_mismatch),
        "margin_sanity": _on(typed, quality.margin_sanity),
        "row_margin": _on(
            typed,
            lambda df: prepare.with_margin(df).select(
                "order_id", "product_name", "profit_margin_pct"
            ),
        ),
        "product_category_conflicts": _on(typed, quality.fd_violations),
        "product_lookup": _on(typed, quality.product_lookup, LOOKED_UP),
        "value_counts_raw": _on(
            typed, aggregate.value_counts, ("category", "region", "sub_category")
        ),
        # the clean table
        "clean_sales": _on(clean, _money_as_double),
        "cleaning_report": _on(typed, quality.cleaning_report),
        "price_tier": _on(
            clean,
            lambda df: prepare.with_price_tier(df, HIGHER_CUTS).select(
                "order_id", "product_name", "unit_price", "price_tier"
            ),
        ),
        "value_counts": _on(
            clean, aggregate.value_counts, ("category", "sub_category", "region", "state")
        ),
        "value_counts_top": _on(
            clean, aggregate.value_counts, ("category", "state", "quantity"), n=10
        ),
        "describe_measures": _describe,
        "describe_measures_approx": _describe_approx,
        "kpi_totals": _on(clean, overviews.kpi_totals),
        "region_overview": _on(clean, overviews.dimension_overview, "region"),
        "category_overview": _on(clean, overviews.dimension_overview, "category"),
        "price_tier_overview": _on(clean, overviews.price_tier_overview),
        "monthly_overview": _on(clean, overviews.monthly_overview),
        "region_quantity": _on(clean, chart, "region", "total_quantity"),
        "top_products": _on(clean, overviews.top_products),
        "tier_feed": _on(clean, overviews.tier_feed, HIGHER_CUTS),
        "crosstab_counts": _on(clean, aggregate.crosstab_counts, "region", "category"),
        "dominant_value": _on(clean, aggregate.dominant_value, "region", "category"),
        "profile_with_dominant": _region_profile,
        # chart data
        "chart_total_revenue_by_category": _on(clean, chart, "category", "total_revenue"),
        "chart_total_profit_by_category": _on(clean, chart, "category", "total_profit"),
        "chart_profit_margin_pct_by_category": _on(clean, chart, "category", "profit_margin_pct"),
        "chart_total_revenue_by_region": _on(clean, chart, "region", "total_revenue"),
        "chart_monthly_revenue": _on(clean, overviews.chart_monthly_revenue),
        # reports
        **{name: _on(clean, report) for name, report in REPORTS.items()},
        "q06_higher_cuts": _on(clean, reports.q06_price_tiers, HIGHER_CUTS),
        # model preparation and scoring
        "label_index": _on(clean, features.label_index),
        "one_hot": _on(
            clean,
            lambda df: features.one_hot_slots(df.select("order_id", "product_name", *features.CATEGORICAL)),
        ),
        "standardize": _standardize,
        "baseline_metrics": _baseline_metrics,
        "train_test_split": _split,
        "split_sizes": _on(_split, sampling.split_sizes),
        "predict_linear": lambda spark, sf_dir: _linear_predictions(spark, sf_dir).withColumn(
            "prediction", F.round("prediction", 2) + 0.0
        ),
        "linear_metrics": _linear_metrics,
        "predict_forest": _predict_forest,
        "regression_metrics": _model_metrics,
        "feature_importance": _importance,
        # clusters and projection
        "kmeans_elbow": _on(_points, _rounded(clustering.kmeans_elbow, {"wcss": 4})),
        "kmeans_assign": _on(_clustered, lambda df: df.drop("z")),
        "cluster_sizes": _on(_clustered, clustering.cluster_sizes),
        "cluster_profile": _on(_clustered, clustering.cluster_profile),
        "cluster_category_counts": _on(_clustered, clustering.cluster_category_counts),
        "cluster_profile_with_category": _on(
            _clustered, clustering.cluster_profile_with_category
        ),
        "kmeans_silhouette": _on(_clustered, _rounded(clustering.silhouette, {"silhouette": 6})),
        "pca_scores": _on(_clustered, _rounded(clustering.pca_scores, {"pc1": 5, "pc2": 5})),
        "pca_variance": _on(_points, _rounded(clustering.pca_variance, {"explained_variance": 6})),
        "pca_feed": _pca_feed,
        "pca_variance_two": _pca_variance_two,
        "kmeans_facts": _on(_vectors, clustering.kmeans_facts),
        "linear_revenue": _linear_revenue,
    }
    # kept tables: cleaning in batches, and the reports from one written cube
    found |= {"clean_in_batches": _clean_in_batches, "kpi_cube": _cube_rows}
    found |= {
        "scan_rejects": _scan_rejects,
        "scan_accepted": lambda spark, sf_dir: _planted_csv(spark, sf_dir).rows,
        "sketched_distinct": _within,
    }
    found |= {f"cube_{name}": _on(_cube, report) for name, report in REPORTS.items()}
    if corpus is not None:
        found |= corpus.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = oracles.oracle_sql()
    if corpus is not None:
        found |= corpus.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
