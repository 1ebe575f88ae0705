"""The four analyses end to end, each result a set of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from salesweft.operators import baskets, drivers, forecast, kmeans, segments, selection, series, tree
from salesweft.session import written


@dataclass(frozen=True)
class ForecastResult:
    history: DataFrame
    forecast: DataFrame
    models: DataFrame
    metrics: DataFrame
    skipped: DataFrame


def run_forecast(
    sales: DataFrame, keys: list[str], category=None, city=None, steps: int = 30,
    order: tuple[int, int, int] | None = None, fit_days: int = forecast.FIT_DAYS, minimum: int = forecast.MIN_POINTS,
    **options,
) -> ForecastResult:
    """Forecast every series of the (filtered) fact at once; one series without keys."""
    wanted = selection.filter_sales(sales, category=category, city=city)
    if not keys:
        keys, wanted = [forecast.WHOLE], wanted.withColumn(forecast.WHOLE, F.lit("all"))
    daily = written(series.daily_series(wanted, keys), "daily-series")
    windowed = series.fit_window(daily, keys, fit_days)
    rows, models = forecast.fit_models(daily, keys, order, fit_days=fit_days, minimum=minimum)
    models = written(models, "models")
    fitted = forecast.fitted_values(rows, models, keys)
    return ForecastResult(
        history=rows.select(*keys, "ds", "y"),
        forecast=forecast.forecast_models(rows, models, keys, steps, **options),
        models=models,
        metrics=forecast.fit_metrics(fitted, models, keys),
        skipped=series.skipped_series(windowed, keys, minimum).unionByName(forecast.unmodelled_series(rows, models, keys)),
    )


@dataclass(frozen=True)
class BasketResult:
    itemsets: DataFrame
    rules: DataFrame
    totals: DataFrame


def run_baskets(
    sales: DataFrame, keys=("order_date", "city"), item: str = "category",
    min_support: float = 0.01, min_confidence: float = 0.5, max_length: int = 3,
) -> BasketResult:
    """Frequent itemsets and rules of the baskets in the fact."""
    contents = baskets.baskets_from_sales(sales, keys, item)
    itemsets = baskets.frequent_itemsets(contents, min_support, max_length)
    rules = baskets.association_rules(itemsets, min_confidence, max_length)
    return BasketResult(itemsets, rules, baskets.headline_counts(contents, itemsets, rules))


@dataclass(frozen=True)
class SegmentResult:
    profile: DataFrame
    favourites: DataFrame
    assignments: DataFrame
    labelled: DataFrame
    metrics: dict[str, float]
    weights: DataFrame
    k: int


def run_segmentation(behaviour: DataFrame, k: int | None = 4, seeds=kmeans.SEEDS) -> SegmentResult:
    """K-means segments of a behaviour table; ``k=None`` picks k by silhouette."""
    spark = behaviour.sparkSession
    behaviour = written(behaviour, "behaviour")
    prepared = written(segments.prepared_features(behaviour), "features")
    model = kmeans.choose(prepared, seeds=seeds)[0] if k is None else kmeans.best_of(kmeans.fit(prepared, [k], seeds))[k]
    # The model's labels are kept as a table: every later step reads the same.
    labels = written(kmeans.assigned(prepared, model).select("customer_id", "cluster"), "labels")
    scaled = prepared.join(labels, "customer_id")
    labelled = behaviour.join(labels, "customer_id")
    profile = written(segments.cluster_profile(labelled), "profile")
    centroids = spark.createDataFrame(
        model.centres, ", ".join(f"{f} double" for f in segments.FEATURES)
    )
    metrics = {
        "silhouette": segments.silhouette(segments.vectors(scaled)),
        "calinski_harabasz": segments.calinski_harabasz(scaled).first()[0],
        "davies_bouldin": segments.davies_bouldin(scaled).first()[0],
        "inertia": model.inertia,
    }
    return SegmentResult(
        profile=profile,
        favourites=segments.cluster_favourites(labelled),
        assignments=segments.assignments(labels, profile),
        labelled=labelled,
        metrics=metrics,
        weights=segments.feature_weights(centroids),
        k=model.k,
    )


@dataclass(frozen=True)
class DriverResult:
    metrics: DataFrame
    cross_validated_mse: float
    importance: DataFrame
    rules: DataFrame
    insights: DataFrame
    sample: DataFrame
    sizes: DataFrame


def run_drivers(
    sales: DataFrame, max_depth: int = 5, min_samples_split: int = 20, low: float = 100.0, mid: float = 200.0
) -> DriverResult:
    """Feature table, regression tree, rules and stocking advice."""
    table = written(drivers.feature_table(sales, low, mid), "driver-features")
    options = {"max_depth": max_depth, "min_samples_split": min_samples_split}
    fitted = tree.train_tree(table, **options)
    return DriverResult(
        metrics=tree.tree_metrics(table, fitted),
        cross_validated_mse=tree.cross_validated_mse(table, **options),
        importance=tree.importance(table.sparkSession, fitted),
        rules=drivers.decision_rules(table),
        insights=drivers.stocking_insights(table),
        sample=tree.prediction_sample(table, fitted),
        sizes=selection.distinct_counts(
            table, {"Region": "regions", "Category": "categories", "Season": "seasons"}
        ),
    )
