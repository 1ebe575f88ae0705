"""Regional sales drivers without a model: features, rules, stocking advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesweft.functions import labels, numbers
from salesweft.operators import selection

# The encoded columns and the target.
FEATURE_COLUMNS = ["Region", "Season", "Category", "Price_Range"]
TARGET = "Sales_Volume"


def feature_table(df: DataFrame, low: float = 100.0, mid: float = 200.0) -> DataFrame:
    """City x category x season totals with a price tier.

    Everything below runs on this table; its size is the product of the
    three dimensions, not the number of sales rows.
    """
    present = selection.present_keys(df, ["city", "category", "season"])
    sums = present.groupBy("city", "category", "season").agg(
        numbers.money_sum(F.col("sales_amount")).alias("amount"),
        F.sum("order_count").cast("long").alias(TARGET),
        numbers.money_sum(F.col("profit")).alias("profit"),
    )
    price = numbers.per_at_least_one(F.col("amount"), F.col(TARGET))
    return sums.select(
        F.col("city").alias("Region"), F.col("season").alias("Season"), F.col("category").alias("Category"),
        labels.price_tier(price, low, mid).alias("Price_Range"), TARGET, "amount", "profit",
    )


def combination_stats(features: DataFrame) -> DataFrame:
    """Mean, sum and count per region, season, category and tier."""
    return features.groupBy(*FEATURE_COLUMNS).agg(
        F.avg(TARGET).alias("avg_sales"), F.sum(TARGET).alias("total_sales"), F.count(TARGET).alias("count")
    )


def active_features(columns: list[str] = FEATURE_COLUMNS) -> Column:
    """Names of the one-hot columns that are 1 in a row."""
    return F.array(*[F.concat(F.lit(f"{c}_"), F.col(c)) for c in columns])


def one_hot_long(features: DataFrame, columns: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """One row per active one-hot column."""
    return features.select(*columns, F.explode(active_features(columns)).alias("feature"))


def encoded_values(features: DataFrame, columns: list[str] = FEATURE_COLUMNS) -> dict[str, list[str]]:
    """The distinct values of every encoded column, in order: the columns of the wide form, so few."""
    long = features.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns])).alias("x"))
    rows = long.select("x.c", "x.v").where("v IS NOT NULL").distinct().collect()
    return {c: sorted(r["v"] for r in rows if r["c"] == c) for c in columns}


def one_hot_wide(features: DataFrame, values: dict[str, list[str]]) -> DataFrame:
    """0/1 columns ``<column>_<value>`` for the given values."""
    flags = [
        F.coalesce((F.col(c) == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c, found in values.items() for v in found
    ]
    return features.select("*", *flags)


def decision_rules(features: DataFrame, n: int = 20) -> DataFrame:
    """Best region x season x category rules by mean volume.

    Support is the share of rows; confidence is the mean relative to the
    region's mean, at most 1.
    """
    total = features.agg(F.count("*").alias("n")).scalar()
    groups = features.groupBy("Region", "Season", "Category").agg(
        F.avg(TARGET).alias("sales_impact"), F.count("*").alias("rows"), F.sum(TARGET).alias("volume")
    )
    region = Window.partitionBy("Region")
    region_mean = F.sum("volume").over(region) / F.sum("rows").over(region)
    ratio = F.when(F.col("region_mean") > 0, F.col("sales_impact") / F.col("region_mean")).otherwise(F.lit(1.0))
    rules = groups.withColumn("region_mean", region_mean).select(
        "Region", "Season", "Category",
        labels.rule_condition(F.col("Region"), F.col("Season"), F.col("Category")).alias("condition"),
        labels.rule_conclusion(F.col("sales_impact")).alias("conclusion"),
        (F.col("rows") / total).alias("support"),
        F.least(ratio, F.lit(1.0)).alias("confidence"),
        "sales_impact",
    )
    return selection.top(rules, n, F.desc("sales_impact"), F.asc("Region"), F.asc("Season"), F.asc("Category"))


def stocking_insights(features: DataFrame, n: int = 50) -> DataFrame:
    """Top combinations with priority and recommendation.

    Priorities come from the quartiles of those ``n`` rows alone.
    """
    best = selection.top(
        combination_stats(features), n, F.desc("avg_sales"), *[F.asc(c) for c in FEATURE_COLUMNS]
    )
    marks = best.agg(
        F.percentile("avg_sales", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("p")
    ).scalar()
    return best.select(
        *FEATURE_COLUMNS, F.col("avg_sales").alias("expected_sales"),
        labels.stocking_priority(F.col("avg_sales"), marks[1], marks[0]).alias("priority"),
        labels.stocking_text(
            F.col("Season"), F.col("Region"), F.col("Category"), F.col("Price_Range"), F.col("avg_sales")
        ).alias("recommendation"),
    )


def filter_insights(insights: DataFrame, region=None, season=None, priority=None) -> DataFrame:
    """Insights of a region, season or priority."""
    for column, value in (("Region", region), ("Season", season), ("priority", priority)):
        if value:
            insights = insights.where(F.col(column) == value)
    return insights


def heatmap_cells(insights: DataFrame) -> DataFrame:
    """Largest expected sales per region and category."""
    return insights.groupBy("Region", "Category").agg(F.max("expected_sales").alias("expected_sales"))


def heatmap_wide(insights: DataFrame, categories: list[str]) -> DataFrame:
    """The heat map with one column per given category."""
    return insights.groupBy("Region").pivot("Category", categories).agg(F.max("expected_sales"))


def top_features(importance: DataFrame, n: int = 8) -> DataFrame:
    """Most important encoded columns with their plain names."""
    best = selection.top(importance, n, F.desc("importance"), F.asc("feature"))
    return best.withColumn("name", labels.strip_feature_prefix(F.col("feature")))
