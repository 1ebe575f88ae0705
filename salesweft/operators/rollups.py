"""Roll-ups of the sales fact and of the order records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from salesweft.functions import dates, labels, numbers
from salesweft.operators import selection

MEASURES = {
    "orders": lambda: F.sum("order_count").cast("long"),
    "revenue": lambda: numbers.money_sum(F.col("sales_amount")),
    "profit": lambda: numbers.money_sum(F.col("profit")),
    "customers": lambda: F.sum("customer_count").cast("long"),
    "products": lambda: F.sum("product_count").cast("long"),
}
_RATIO = {"avg_order_value", "avg_price"}


def _finish(sums: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Output rounding and the guarded average."""
    out: list[Column] = [F.col(k) for k in keys]
    for m in measures:
        if m in _RATIO:
            out.append(numbers.half_even(numbers.per_at_least_one(F.col("revenue"), F.col("orders")), 2).alias(m))
        elif m in ("revenue", "profit"):
            out.append(numbers.half_even(F.col(m), 2).alias(m))
        else:
            out.append(F.col(m))
    return sums.select(*out)


def sales_rollup(df: DataFrame, key: str, measures: list[str], as_name: str | None = None) -> DataFrame:
    """Sums per present key, rounded for output, unordered."""
    name = as_name or key
    base = [m for m in measures if m not in _RATIO]
    for m in ("orders", "revenue"):
        if m not in base:
            base.append(m)
    sums = (
        df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(name))
        .agg(*[MEASURES[m]().alias(m) for m in base])
    )
    return _finish(sums, [name], measures)


def sales_by_date(df: DataFrame) -> DataFrame:
    """Per day, oldest first."""
    daily = sales_rollup(
        df, "order_date", ["orders", "revenue", "profit", "customers", "products", "avg_order_value"], "date"
    )
    return daily.withColumn("date", dates.day_text(F.col("date"))).orderBy("date")


def sales_by_category(df: DataFrame) -> DataFrame:
    """Per category, largest revenue first."""
    rolled = sales_rollup(df, "category", ["orders", "revenue", "profit", "customers", "avg_price"])
    return rolled.orderBy(F.desc("revenue"), "category")


def sales_by_city(df: DataFrame) -> DataFrame:
    """Per city, largest revenue first."""
    rolled = sales_rollup(df, "city", ["orders", "revenue", "profit", "customers"])
    return rolled.orderBy(F.desc("revenue"), "city")


def sales_by_month(df: DataFrame) -> DataFrame:
    """Per ``YYYY-MM``, oldest first."""
    bucketed = df.withColumn("month", dates.month_bucket(F.col("order_date")))
    return sales_rollup(bucketed, "month", ["orders", "revenue", "profit", "customers"]).orderBy("month")


def sales_by_gender(df: DataFrame) -> DataFrame:
    """Per gender group, largest revenue first."""
    rolled = sales_rollup(df, "gender", ["orders", "revenue", "profit", "customers"])
    return rolled.orderBy(F.desc("revenue"), "gender")


def sales_by_age_group(df: DataFrame) -> DataFrame:
    """Per age group, largest revenue first."""
    rolled = sales_rollup(df, "age_group", ["orders", "revenue", "profit", "customers"])
    return rolled.orderBy(F.desc("revenue"), "age_group")


def _summary_columns() -> list[Column]:
    zero = F.lit(0)
    return [
        F.coalesce(F.col("orders"), zero).alias("total_orders"),
        F.coalesce(numbers.half_even(F.col("revenue"), 2), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.col("customers"), zero).alias("total_customers"),
        F.coalesce(numbers.half_even(F.col("profit"), 2), F.lit(0.0)).alias("total_profit"),
        F.coalesce(
            numbers.half_even(numbers.per_count_or_zero(F.col("revenue"), F.col("orders")), 2), F.lit(0.0)
        ).alias("avg_order_value"),
    ]


_SUMMARY = ["orders", "revenue", "customers", "profit"]


def sales_summary(df: DataFrame) -> DataFrame:
    """One row of totals; zeros on empty input."""
    return df.agg(*[MEASURES[m]().alias(m) for m in _SUMMARY]).select(*_summary_columns())


def yearly_summary(df: DataFrame) -> DataFrame:
    """Totals per year with rows, in one pass."""
    sums = df.where(F.col("year").isNotNull()).groupBy("year").agg(*[MEASURES[m]().alias(m) for m in _SUMMARY])
    return sums.select("year", *_summary_columns()).orderBy("year")


def overview(df: DataFrame, top_n: int = 5) -> DataFrame:
    """Totals, yearly totals, top categories and top cities as one long frame.

    The fact is read once and summed per (year, category, city); the
    grouping sets run over those few rows.
    """
    base = df.groupBy("year", "category", "city").agg(
        F.sum("order_count").alias("order_count"),
        numbers.money_total(F.col("sales_amount")).alias("sales_amount"),
        F.sum("customer_count").alias("customer_count"),
        numbers.money_total(F.col("profit")).alias("profit"),
    )
    sets = base.groupingSets(
        [[], [F.col("year")], [F.col("category")], [F.col("city")]],
        F.col("year"), F.col("category"), F.col("city"),
    ).agg(
        F.grouping_id().alias("gid"),
        F.sum("order_count").cast("long").alias("orders"),
        F.sum("sales_amount").cast("double").alias("revenue"),
        F.sum("customer_count").cast("long").alias("customers"),
        F.sum("profit").cast("double").alias("profit"),
    )
    # grouping_id has one bit per key, set when the key is rolled up.
    section = (
        F.when(F.col("gid") == 0b111, "total").when(F.col("gid") == 0b011, "year")
        .when(F.col("gid") == 0b101, "category").otherwise("city")
    )
    key = F.coalesce(F.col("year").cast("string"), F.col("category"), F.col("city"))
    named = (
        sets.withColumn("section", section).withColumn("key", F.when(F.col("gid") == 0b111, "all").otherwise(key))
        .where(F.col("key").isNotNull())
    )
    ranked = selection.first_per_group(
        named.where(F.col("section").isin("category", "city")),
        ["section"], [F.desc("revenue"), F.asc("key")], top_n,
    )
    plain = named.where(F.col("section").isin("total", "year")).withColumn("rank", F.lit(None).cast("int"))
    return ranked.unionByName(plain).select("section", "key", "rank", *_summary_columns())


# Order records -----------------------------------------------------------

DIMENSION_SETS = {
    "Region": ["Region"],
    "Date": ["Order_Date"],
    "Category": ["Category"],
    "Region_Date": ["Region", "Order_Date"],
    "Region_Category": ["Region", "Category"],
    "Season_Category": ["Season", "Category"],
}


def _order_sums(quantity: Column, amount: Column, count: Column) -> list[Column]:
    return [
        count.cast("long").alias("order_count"),
        quantity.cast("long").alias("total_quantity"),
        amount.cast("double").alias("total_amount"),
    ]


def _with_average(sums: DataFrame, keys: list[str]) -> DataFrame:
    average = numbers.per_count_or_zero(F.col("total_amount"), F.col("order_count"))
    return sums.select(
        *keys, "order_count", "total_quantity", "total_amount",
        numbers.half_even(average, 4).alias("avg_order_value"),
    )


def rollup_orders(df: DataFrame, dims: list[str]) -> DataFrame:
    """Order count, quantity, amount and average per present dimensions."""
    sums = selection.present_keys(df, dims).groupBy(*dims).agg(
        *_order_sums(
            F.sum("Quantity"), numbers.money_total(F.col("Total_Amount")), F.count("Order_ID")
        )
    )
    return _with_average(sums, dims)


def rollup_region(df: DataFrame) -> DataFrame:
    """By region."""
    return rollup_orders(df, DIMENSION_SETS["Region"])


def rollup_date(df: DataFrame) -> DataFrame:
    """By date, oldest first."""
    return rollup_orders(df, DIMENSION_SETS["Date"]).orderBy("Order_Date")


def rollup_category(df: DataFrame) -> DataFrame:
    """By category, largest amount first."""
    return rollup_orders(df, DIMENSION_SETS["Category"]).orderBy(F.desc("total_amount"), "Category")


def rollup_region_date(df: DataFrame) -> DataFrame:
    """By region and date."""
    return rollup_orders(df, DIMENSION_SETS["Region_Date"])


def rollup_region_category(df: DataFrame) -> DataFrame:
    """By region and category."""
    return rollup_orders(df, DIMENSION_SETS["Region_Category"])


def rollup_season_category(df: DataFrame) -> DataFrame:
    """By season and category."""
    return rollup_orders(df, DIMENSION_SETS["Season_Category"])


def _all_dims(sets: dict[str, list[str]]) -> list[str]:
    return list(dict.fromkeys(d for s in sets.values() for d in s))


def partial_sums(df: DataFrame, sets: dict[str, list[str]] = DIMENSION_SETS) -> DataFrame:
    """Order count, quantity and amount at the finest grain the sets need; such sums can be added up."""
    return df.groupBy(*_all_dims(sets)).agg(
        F.count("Order_ID").alias("n"),
        F.sum("Quantity").alias("q"),
        numbers.money_total(F.col("Total_Amount")).alias("a"),
    )


def rollup_all(df: DataFrame, sets: dict[str, list[str]] = DIMENSION_SETS) -> DataFrame:
    """Every roll-up in one pass, with its name in ``dimension``.

    Rows are summed once at the finest grain the sets need; the grouping
    sets then expand that small frame, not the order records.
    """
    return rollup_partials(partial_sums(df, sets), sets)


def rollup_partials(base: DataFrame, sets: dict[str, list[str]] = DIMENSION_SETS) -> DataFrame:
    """Every roll-up from partial sums; a group may come in several parts."""
    dims = _all_dims(sets)
    grouped = base.groupingSets([[F.col(d) for d in s] for s in sets.values()], *[F.col(d) for d in dims]).agg(
        F.grouping_id().alias("gid"), *_order_sums(F.sum("q"), F.sum("a"), F.sum("n"))
    )
    ids = {
        name: sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in s)
        for name, s in sets.items()
    }
    label = reduce(
        lambda expr, item: F.when(F.col("gid") == item[1], item[0]).otherwise(expr), ids.items(), F.lit(None)
    )
    complete = reduce(
        lambda a, b: a | b,
        [
            (F.col("gid") == ids[name]) & reduce(lambda x, y: x & y, [F.col(d).isNotNull() for d in s])
            for name, s in sets.items()
        ],
    )
    return _with_average(grouped.where(complete).withColumn("dimension", label), ["dimension", *dims])


def rollup_group_counts(rolled: DataFrame) -> DataFrame:
    """Number of groups per roll-up."""
    return rolled.groupBy("dimension").agg(F.count("*").alias("groups")).orderBy("dimension")


def keyed_reduce(df: DataFrame, *parts: str) -> DataFrame:
    """Totals per composite key; a missing part counts as ``Unknown``."""
    sums = df.groupBy(labels.composite_key(*[F.col(p) for p in parts]).alias("key")).agg(
        F.count("*").alias("total_orders"),
        F.coalesce(F.sum("Quantity"), F.lit(0)).cast("long").alias("total_quantity"),
        F.coalesce(numbers.money_sum(F.col("Total_Amount")), F.lit(0.0)).alias("total_amount"),
    )
    average = numbers.per_count_or_zero(F.col("total_amount"), F.col("total_orders"))
    return sums.withColumn("avg_order_value", numbers.half_even(average, 4))
