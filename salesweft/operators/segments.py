"""Customer behaviour, segmentation and segment quality."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from salesweft.functions import dates, labels, numbers
from salesweft.operators import quantiles, selection
from salesweft.session import written

# The features of the segmentation.
FEATURES = [
    "Total_Orders", "Total_Spend", "Avg_Order_Value", "Purchase_Frequency", "Days_Since_Last_Purchase",
]
# The most frequent value of each, ties by name.
TASTES = {"category": "Favorite_Category", "season": "Favorite_Season", "region": "Preferred_Region"}
# Smallest radar axis per measure.
RADAR_FLOORS = {
    "avg_total_orders": 10.0,
    "avg_total_spend": 5000.0,
    "avg_order_value": 500.0,
    "avg_purchase_frequency": 1.0,
    "avg_days_since_last_purchase": 50.0,
}


def behaviour_table(lines: DataFrame) -> DataFrame:
    """One row per customer from order lines.

    Needs ``customer_id, order_id, order_date, sales_amount, category,
    season, region``.  All measures come from one grouping by customer, and the
    favourites from counts per value that are merged like sums, so the lines
    are read once and what moves is partial results of orders.  A customer with
    a large share of all lines is spread over tasks by order.  The result, one
    narrow row per customer, is written: every later step reads that.
    """
    known = F.col("customer_id").isNotNull() & F.col("order_id").isNotNull()
    of = lambda column: F.when(known, F.col(column))
    grouped = lines.groupBy("customer_id").agg(
        F.count_distinct(of("order_id")).alias("Total_Orders"),
        numbers.money_total(of("sales_amount")).cast("double").alias("Total_Spend"),
        F.min(of("order_date")).alias("_first"), F.max(of("order_date")).alias("Last_Purchase_Date"),
        F.max("order_date").alias("_newest"),
        *[F.mode(of(column), True).alias(name) for column, name in TASTES.items()],
    )
    customers = written(grouped, "behaviour")
    newest = customers.agg(F.max("_newest")).scalar()
    months = F.greatest(dates.whole_months(F.col("_first"), F.col("Last_Purchase_Date")), F.lit(1))
    return customers.where("Total_Orders > 0").select(
        "customer_id", "Total_Orders", "Total_Spend",
        numbers.per_count_or_zero(F.col("Total_Spend"), F.col("Total_Orders")).alias("Avg_Order_Value"),
        (F.col("Total_Orders") / months).alias("Purchase_Frequency"),
        "Last_Purchase_Date",
        F.datediff(newest, "Last_Purchase_Date").cast("long").alias("Days_Since_Last_Purchase"),
        *TASTES.values(),
    )


def fill_features(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Missing features count as 0."""
    return df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})


def clip_outliers(df: DataFrame, features: list[str] = FEATURES, reach: float = 1.5, stored: bool = False) -> DataFrame:
    """Clip to the quartiles widened by ``reach`` times their distance."""
    known = quantiles.with_quantiles(df, df, features, {"q1": 0.25, "q3": 0.75}, stored=stored)

    def clipped(f: str) -> Column:
        q1, q3 = F.col("_q").getField(f"{f}_q1"), F.col("_q").getField(f"{f}_q3")
        low, high = q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)
        return F.least(F.greatest(F.col(f), low), high)

    return known.withColumns({f: clipped(f) for f in features}).drop("_q")


def scale(df: DataFrame, features: list[str] = FEATURES, sample: bool = False) -> DataFrame:
    """Zero mean, unit deviation (population unless ``sample``); 0 when constant."""
    deviation = F.stddev_samp if sample else F.stddev_pop
    stats = df.agg(
        *[F.avg(f).alias(f"{f}_m") for f in features], *[deviation(f).alias(f"{f}_s") for f in features]
    ).select(F.struct("*").alias("s")).scalar()

    def scaled(f: str) -> Column:
        mean, spread = F.col("_s").getField(f"{f}_m"), F.col("_s").getField(f"{f}_s")
        return F.when(spread > 0, (F.col(f) - mean) / spread).otherwise(F.lit(0.0))

    return df.withColumn("_s", stats).withColumns({f: scaled(f) for f in features}).drop("_s")


def prepared_features(behaviour: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Filled, clipped and scaled features next to the customer id.

    Each step first measures its whole input, so the inputs are written: one
    narrow row per customer instead of the order lines again.
    """
    filled = written(fill_features(behaviour.select("customer_id", *features), features), "features-filled")
    return scale(written(clip_outliers(filled, features, stored=True), "features-clipped"), features)


def vectors(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Add the MLlib feature vector."""
    return VectorAssembler(inputCols=features, outputCol="features").transform(df)


def silhouette(assigned: DataFrame, label: str = "cluster") -> float:
    """Mean silhouette (squared Euclidean, linear cost)."""
    return ClusteringEvaluator(featuresCol="features", predictionCol=label).evaluate(assigned)


def misplaced(assigned: DataFrame, centres: list[list[float]], features: list[str] = FEATURES, cluster: str = "cluster") -> DataFrame:
    """Customers, and how many of them are nearer to another of the (few) centres than to their own."""
    far = lambda centre: sum(((F.col(f) - float(x)) * (F.col(f) - float(x)) for f, x in zip(features, centre)), F.lit(0.0))
    distances = assigned.select(F.array(*[far(c) for c in centres]).alias("d"), F.col(cluster).alias("c"))
    return distances.agg(F.count("*").alias("customers"), F.count_if(F.get("d", F.col("c")) > F.array_min("d") + 1e-9).alias("misplaced"))


def moved(assigned: DataFrame, centres: list[list[float]], tolerance: float, features: list[str] = FEATURES, cluster: str = "cluster") -> DataFrame:
    """``(clusters, moved)``: centres with members, and how many lie further from their members' mean than a settled one may."""
    means = assigned.groupBy(cluster).agg(*[F.avg(f).alias(f) for f in features])
    told = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centres])
    apart = sum(((F.col(f) - F.get(F.get(told, F.col(cluster)), F.lit(i))) ** 2 for i, f in enumerate(features)), F.lit(0.0))
    return means.agg(F.count("*").alias("clusters"), F.count_if(apart > tolerance).alias("moved"))


def cluster_profile(labelled: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Size and mean of the raw features per cluster, with label and text."""
    means = labelled.groupBy(cluster).agg(
        F.count("*").alias("user_count"),
        F.avg("Total_Orders").alias("avg_total_orders"), F.avg("Total_Spend").alias("avg_total_spend"),
        F.avg("Avg_Order_Value").alias("avg_order_value"),
        F.avg("Purchase_Frequency").alias("avg_purchase_frequency"),
        F.avg("Days_Since_Last_Purchase").alias("avg_days_since_last_purchase"),
    )
    frequency, spend = F.col("avg_purchase_frequency"), F.col("avg_total_spend")
    return means.withColumn("portrait_label", labels.segment_label(frequency, spend)).withColumn(
        "description",
        labels.segment_text(F.col("user_count"), F.col("avg_total_orders"), spend, F.col("avg_order_value"), frequency),
    )


def cluster_favourites(labelled: DataFrame, cluster: str = "cluster", n: int = 3) -> DataFrame:
    """``(cluster, field, value, frequency, rank)``: top categories and regions."""
    fields = ["Favorite_Category", "Preferred_Region"]
    tops = [
        selection.top_values_per_group(labelled, [cluster], f, n)
        .select(cluster, F.lit(f).alias("field"), F.col(f).alias("value"), "frequency", "rank")
        for f in fields
    ]
    return reduce(DataFrame.unionByName, tops)


def assignments(labelled: DataFrame, profile: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Customer, cluster and segment label (one profile row per cluster)."""
    names = profile.select(cluster, F.col("portrait_label").alias("cluster_label"))
    return labelled.select("customer_id", cluster).join(names, cluster)


def customer_portrait(behaviour: DataFrame, assigned: DataFrame, customer_id, cluster: str = "cluster") -> DataFrame:
    """Behaviour and segment of one customer; the id filter reaches both scans."""
    one = F.col("customer_id") == customer_id
    return behaviour.where(one).join(assigned.where(one), "customer_id")


def cluster_stats(labelled: DataFrame, features: list[str] = FEATURES, cluster: str = "cluster") -> DataFrame:
    """Per cluster: size, centroid and sum of squares around it."""
    within = reduce(lambda a, b: a + b, [F.var_pop(f) for f in features]) * F.count("*")
    return labelled.groupBy(cluster).agg(
        F.count("*").alias("n"), within.alias("within"), *[F.avg(f).alias(f) for f in features]
    )


def calinski_harabasz(labelled: DataFrame, features: list[str] = FEATURES, cluster: str = "cluster") -> DataFrame:
    """``(B/(k-1)) / (W/(n-k))`` from one pass; the second sum is over k rows."""
    n, w = F.sum("n"), F.sum("within")
    between = reduce(
        lambda a, b: a + b,
        [F.sum(F.col("n") * F.col(f) * F.col(f)) - F.pow(F.sum(F.col("n") * F.col(f)), F.lit(2.0)) / n for f in features],
    )
    sums = cluster_stats(labelled, features, cluster).agg(
        F.count("*").alias("k"), n.alias("n"), w.alias("w"), between.alias("b")
    )
    score = (F.col("b") / (F.col("k") - 1)) / (F.col("w") / (F.col("n") - F.col("k")))
    usable = (F.col("k") > 1) & (F.col("n") > F.col("k")) & (F.col("w") > 0)
    return sums.select(F.when(usable, score).alias("calinski_harabasz"))


def inertia(labelled: DataFrame, features: list[str] = FEATURES, cluster: str = "cluster") -> DataFrame:
    """Sum of squared distances to the own centroid."""
    return cluster_stats(labelled, features, cluster).agg(F.sum("within").alias("inertia"))


def davies_bouldin(labelled: DataFrame, features: list[str] = FEATURES, cluster: str = "cluster") -> DataFrame:
    """Mean over clusters of the worst (scatter sum / centroid distance).

    Centroids are k rows; they are gathered into one small array, compared
    there, and no pair of data rows is ever formed.  Clusters whose centroids
    coincide count 0 against each other.
    """
    centre = cluster_stats(labelled, features, cluster).select(
        F.col(cluster).alias("_c"), F.array(*features).alias("centre")
    )
    point = F.array(*features)
    squared = lambda a, b: F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v
    )
    scatter = (
        labelled.join(centre, labelled[cluster] == centre["_c"])
        .groupBy("_c", "centre").agg(F.avg(F.sqrt(squared(point, F.col("centre")))).alias("s"))
    )
    gathered = scatter.agg(F.sort_array(F.collect_list(F.struct("_c", "s", "centre"))).alias("all"))
    worst = lambda i: F.array_max(
        F.transform(
            F.filter("all", lambda j: j["_c"] != i["_c"]),
            lambda j: F.coalesce(
                (i["s"] + j["s"]) / F.nullif(F.sqrt(squared(i["centre"], j["centre"])), F.lit(0.0)), F.lit(0.0)
            ),
        )
    )
    ratios = F.transform("all", worst)
    mean = F.aggregate(ratios, F.lit(0.0), lambda s, v: s + v) / F.size("all")
    return gathered.select(F.when(F.size("all") > 1, mean).alias("davies_bouldin"))


def feature_weights(centroids: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """``(feature, weight)``: deviation of the centroids, shares of 1."""
    spread = centroids.agg(*[F.stddev_pop(f).alias(f) for f in features])
    total = reduce(lambda a, b: a + b, [F.col(f) for f in features])
    shared = spread.select(*[F.when(total > 0, F.col(f) / total).otherwise(F.col(f)).alias(f) for f in features])
    return shared.unpivot([], features, "feature", "weight")


def radar_axes(profile: DataFrame) -> DataFrame:
    """``(measure, axis_max)``: 1.2 times the largest mean, at least the floor."""
    wide = profile.agg(*[
        F.greatest(F.max(F.coalesce(F.col(m), F.lit(0.0))) * 1.2, F.lit(floor)).alias(m)
        for m, floor in RADAR_FLOORS.items()
    ])
    return wide.unpivot([], list(RADAR_FLOORS), "measure", "axis_max")


def segment_shares(profile: DataFrame) -> DataFrame:
    """Customers per segment label and their share (k rows in)."""
    total = profile.agg(F.sum("user_count").alias("n")).scalar()
    return profile.groupBy("portrait_label").agg(F.sum("user_count").alias("customers")).withColumn(
        "share", F.col("customers") / total
    )
