"""Named queries over the star-schema tables.

Each query takes ``(spark, folder)`` and returns a DataFrame.  Dates leave as
text and item lists as ``A+B`` so that results compare across engines.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, SparkSession, functions as F

from salesweft.functions import dates, labels, numbers
from salesweft.operators import (
    baskets, drivers, forecast, ingest, kmeans, quality, quantiles, rollups, segments, selection, series, tree,
)
from salesweft.plans import analyses, ledger, offline, upkeep
from salesweft.session import new_work_dir, written
from salesweft.sources import layout, order_files, sales_files, schemas, star
from salesweft.streaming import orders as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SERIES_KEYS = ["region", "category"]
SUPPORT, CONFIDENCE = 0.05, 0.3
TIERS = (49000.0, 51500.0)
# Wider than the default for discounts, which are line totals here.
BOUNDS = {**schemas.QUALITY_BOUNDS, "Discount": (0, 5000)}
# The product types of the star schema, one of them left out on purpose.
ENUMS = {**schemas.ENUMS, "Category": ["STANDARD", "ECONOMY", "SMALL", "LARGE", "MEDIUM"]}
STEPS = 30
BASKET_CAP = 5000


def query(fn: Query) -> Query:
    """Register a function under its name."""
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: numbers.half_even(F.col(c), d) for c, d in digits.items()})


def _dated(df: DataFrame, column: str = "ds") -> DataFrame:
    return df.withColumn(column, dates.day_text(F.col(column)))


# Sales --------------------------------------------------------------------

@query
def sales_by_date(spark, sf):
    return rollups.sales_by_date(star.sales(
        spark, sf, "order_date", "sales_amount", "profit", "order_count", "customer_count", "product_count"
    ))


def _grouped_sales(spark, sf, key):
    return star.sales(spark, sf, key, "sales_amount", "profit", "order_count", "customer_count")


@query
def sales_by_category(spark, sf):
    return rollups.sales_by_category(_grouped_sales(spark, sf, "category"))


@query
def sales_by_city(spark, sf):
    return rollups.sales_by_city(_grouped_sales(spark, sf, "city"))


@query
def sales_by_month(spark, sf):
    return rollups.sales_by_month(_grouped_sales(spark, sf, "order_date"))


@query
def sales_by_gender(spark, sf):
    return rollups.sales_by_gender(_grouped_sales(spark, sf, "gender"))


@query
def sales_by_age(spark, sf):
    return rollups.sales_by_age_group(_grouped_sales(spark, sf, "age_group"))


@query
def sales_summary(spark, sf):
    return rollups.sales_summary(star.sales(spark, sf, "sales_amount", "profit", "order_count", "customer_count"))


@query
def yearly_summary(spark, sf):
    return rollups.yearly_summary(_grouped_sales(spark, sf, "year"))


@query
def overview_topk(spark, sf):
    return rollups.overview(star.sales(
        spark, sf, "year", "category", "city", "sales_amount", "profit", "order_count", "customer_count"
    ))


@query
def filter_conjunction(spark, sf):
    fact = star.sales(
        spark, sf, "year", "order_date", "category", "city", "gender", "age_group", "channel",
        "sales_amount", "profit", "order_count", "customer_count", year=1997,
    )
    wanted = selection.filter_sales(fact, year=1997, category="PROMO", gender="MACHINERY", channel="2-HIGH")
    return rollups.sales_by_city(wanted)


@query
def filter_options(spark, sf):
    fields = ["category", "city", "gender", "age_group", "channel", "year"]
    return selection.filter_options(star.sales(spark, sf, *fields), fields)


@query
def distinct_channels(spark, sf):
    return selection.distinct_values(star.sales(spark, sf, "channel"), "channel")


@query
def distinct_counts(spark, sf):
    return selection.distinct_counts(
        _features(spark, sf), {"Region": "regions", "Category": "categories", "Season": "seasons"}
    )


@query
def year_pruned_sales(spark, sf):
    return rollups.sales_by_month(star.sales(
        spark, sf, "order_date", "sales_amount", "profit", "order_count", "customer_count", year=1998
    ))


@query
def laid_out_year_sales(spark, sf):
    """One year of the fact, read from tables laid out by year and order key."""
    fact = layout.lay_out(spark, sf)
    columns = ["order_date", "sales_amount", "profit", "order_count", "customer_count"]
    return rollups.sales_by_month(layout.sales(spark, fact, *columns, year=1998))


@query
def union_of_years(spark, sf):
    """The yearly files of the fact, written as such, united and summed up."""
    fact = star.sales(spark, sf, "year", "sales_amount", "profit", "order_count", "customer_count")
    folder = new_work_dir(spark, "yearly-files")
    fact.write.partitionBy("year").parquet(folder)
    return rollups.yearly_summary(spark.read.parquet(folder))


def _sales_file_text(spark, sf):
    """Text rows with the headers of sales files, some of them unreadable."""
    day, part = F.col("o_orderdate"), F.col("l_partkey")
    lines = star.table(spark, sf, "lineitem").join(
        star.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return lines.select(
        "o_orderdate",
        F.when(part % 101 == 0, "soon").otherwise(F.date_format(day, "yyyy年M月d日")).alias("订单日期"),
        F.when(part % 97 == 0, "n/a").otherwise(F.col("l_quantity").cast("string")).alias("购买的产品数量"),
        F.col("o_orderpriority").alias("渠道"),
    )


def _sales_file_totals(typed):
    return typed.groupBy("year", "month", "season", "channel").agg(
        F.count("*").alias("row_count"), F.sum("product_count").alias("products"), F.max("day").alias("last_day")
    )


@query
def sales_file_rows(spark, sf):
    text = _sales_file_text(spark, sf).drop("o_orderdate")
    return _sales_file_totals(sales_files.type_sales(sales_files.to_columns(text)))


@query
def sales_file_round_trip(spark, sf):
    """The rows of :func:`sales_file_rows`, written as yearly CSV files and read from them."""
    folder = new_work_dir(spark, "sales-files")
    text = _sales_file_text(spark, sf).withColumn("file_year", F.year("o_orderdate")).drop("o_orderdate")
    text.write.partitionBy("file_year").option("header", True).csv(folder)
    years = [r[0] for r in spark.read.parquet(f"{sf}/orders.parquet").select(F.year("o_orderdate")).distinct().collect()]
    return _sales_file_totals(sales_files.read_all_years(spark, folder, sorted(years), "file_year={year}"))


def _order_files(spark, sf) -> dict[str, str]:
    """Raw orders in each of the three file formats."""
    raw = written(star.raw_orders(spark, sf, "Order_ID", "Source", "Season", "Product_Name", "Quantity", "Unit_Price"), "raw-orders")
    paths = {fmt: new_work_dir(spark, f"orders-{fmt}") for fmt in ("json", "csv", "parquet")}
    order_files.write_raw_orders(raw, paths["json"])
    raw.write.options(**order_files.CSV).csv(paths["csv"])
    raw.write.parquet(paths["parquet"])
    return paths


@query
def order_file_formats(spark, sf):
    frames = [
        order_files.read_orders(spark, path, fmt).select(
            F.lit(fmt).alias("format"), "Order_ID", "Source", "Season", "Product_Name", "Quantity", "Unit_Price"
        )
        for fmt, path in _order_files(spark, sf).items()
    ]
    return _file_totals(ingest.union_sources(frames), ["format", "Source", "Season"])


def _file_totals(records, keys):
    """Records, distinct ids, quantity, negative prices and the last name by key.

    The largest text of a group cannot be kept in a hash table, and sorting all
    records for it is slow.  So records are first counted by name and by id,
    which needs whole numbers only; names are compared once they are distinct.
    """
    nothing = F.lit(None).cast("long")
    as_name = F.struct(F.lit(True).alias("is_name"), F.col("Product_Name").alias("value"), F.lit(1).cast("long").alias("records"), F.col("Quantity").alias("quantity"), (F.col("Unit_Price") < 0).cast("long").alias("negative"))
    as_id = F.struct(F.lit(False).alias("is_name"), F.col("Order_ID").alias("value"), nothing.alias("records"), nothing.alias("quantity"), nothing.alias("negative"))
    sums = [F.sum("records").alias("records"), F.sum("quantity").alias("quantity"), F.coalesce(F.sum("negative"), F.lit(0)).alias("negative")]
    values = records.select(*keys, F.inline(F.array(as_name, as_id))).groupBy(*keys, "is_name", "value").agg(*sums)
    names = values.groupBy(*keys, F.when(F.col("is_name"), F.col("value")).alias("name")).agg(*sums, F.count_if(~F.col("is_name") & F.col("value").isNotNull()).alias("ids"))
    return names.groupBy(*keys).agg(F.sum("records").alias("records"), F.sum("ids").alias("ids"), *sums[1:], F.max("name").alias("last_name"))


@query
def ingest_rejects(spark, sf):
    """Deliveries by source, one of them unknown and one missing: what was rejected or refused, and why."""
    folder, out = new_work_dir(spark, "deliveries"), new_work_dir(spark, "ingested")
    columns = ["Order_ID", "Region", "Order_Date", "Season", "Category", "Product_Code", "Quantity", "Unit_Price"]
    star.raw_orders(spark, sf, "Source", *columns).write.partitionBy("Source").options(**order_files.PACKED).json(folder)
    names = [*schemas.SOURCES, "FAX"]
    deliveries = [(name, f"{folder}/Source={name}") for name in names] + [("POS", f"{folder}/nothing.json")]
    result = offline.ingest_files(spark, deliveries, out, fmt="json")
    rejected = spark.read.schema("Source string, reject_reason string").json(result.rejected_path)
    listed = result.refused.select(F.col("source").alias("Source"), F.col("reason").alias("reject_reason"))
    counted = lambda df, kind: df.groupBy("Source", "reject_reason").agg(F.count("*").alias("records")).withColumn("kind", F.lit(kind))
    return counted(rejected, "record").unionByName(counted(listed, "delivery"))


@query
def ingest_ledger(spark, sf):
    """Three runs over growing deliveries in two formats: every file is taken once, a repeated run takes nothing."""
    folder, out = new_work_dir(spark, "ledger-deliveries"), new_work_dir(spark, "ledger")
    columns = ["Order_ID", "Region", "Order_Date", "Season", "Category", "Product_Code", "Quantity", "Unit_Price"]
    raw = written(star.raw_orders(spark, sf, "Source", *columns), "ledger-orders")
    raw.where("Source IN ('ERP', 'POS', 'FAX')").write.partitionBy("Source").json(f"{folder}/json")
    raw.where("Source NOT IN ('ERP', 'POS', 'FAX')").write.partitionBy("Source").option("header", True).csv(f"{folder}/csv")
    first = [(s, f"{folder}/json/Source={s}") for s in ("ERP", "FAX")]
    later = [("POS", f"{folder}/json/Source=POS"), *[(s, f"{folder}/csv/Source={s}") for s in ("ONLINE_EC", "APP", "MINI_PROGRAM")], ("APP", f"{folder}/nothing.csv")]
    runs = [ledger.take(spark, deliveries, out) for deliveries in (first, first + later, first + later)]
    taken = reduce(DataFrame.unionByName, [r.taken for r in runs])
    found = ledger.records(spark, out).join(taken.select("run", ledger.folder_of("file").alias("delivery")), "delivery")
    counted = found.groupBy("run", "Source", "reject_reason").agg(F.count("*").alias("records"))
    refused = reduce(DataFrame.unionByName, [r.refused.select(F.lit(r.run).alias("run"), F.col("source").alias("Source"), F.col("reason").alias("reject_reason"), F.lit(0).cast("long").alias("records")) for r in runs])
    return counted.unionByName(refused)


@query
def kept_rollups(spark, sf):
    """All roll-ups from the partial sums of two deliveries, the second of them added twice."""
    out = new_work_dir(spark, "kept-rollups")
    orders = _typed_orders(spark, sf, "Order_ID", "Region", "Order_Date", "Category", "Season", "Quantity", "Total_Amount")
    for delivery, rest in ((1, 0), (2, 1), (2, 1)):
        upkeep.add_delivery(orders.where(F.pmod(F.split("Order_ID", "-")[0].cast("long"), F.lit(2)) == rest), out, delivery)
    return _dated(upkeep.kept_rollups(spark, out), "Order_Date")


@query
def cleaning_stamps(spark, sf):
    """Cleaned orders, and how many carry a cleaning time outside the bounds of the run."""
    raw = star.raw_orders(spark, sf)
    before = datetime.datetime.now(datetime.timezone.utc).timestamp()
    stamps = written(quality.clean_orders(raw, BOUNDS).select("cleaned_at"), "stamps")
    after = datetime.datetime.now(datetime.timezone.utc).timestamp()
    at = F.col("cleaned_at").cast("double")
    return stamps.agg(F.count("*").alias("orders"), F.count_if(at.isNull() | ~at.between(before - 1, after + 1)).alias("outside"), F.count_distinct("cleaned_at").alias("stamps"))


@query
def cleaned_round_trip(spark, sf):
    """Cleaned orders, written by year and read back from the whole tree."""
    folder = new_work_dir(spark, "cleaned")
    order_files.write_cleaned_orders(quality.clean_orders(star.raw_orders(spark, sf), BOUNDS, stamp=False), folder)
    read = order_files.read_cleaned_tree(spark, folder)
    return read.groupBy("Season", "Size", "Gender").agg(
        F.count("*").alias("orders"), F.count("Order_Date").alias("dated"),
        numbers.half_even(F.sum("Quantity"), 4).alias("quantity"),
    )


@query
def report_round_trip(spark, sf):
    report, folder = quality.quality_report(star.raw_orders(spark, sf), BOUNDS), new_work_dir(spark, "report")
    order_files.write_report(report, folder)
    return spark.read.schema(report.schema).json(folder)


@query
def category_seasonality(spark, sf):
    names = selection.distinct_values(star.sales(spark, sf, "category"), "category")
    groups = {"Summer": ["PROMO"], "Winter": ["LARGE"], "Autumn/Winter": ["SMALL", "MEDIUM"]}
    return names.withColumn("seasonality", labels.category_season(F.col("category"), groups))


@query
def weekday_sales(spark, sf):
    fact = star.sales(spark, sf, "order_date", "sales_amount", "order_count")
    return fact.groupBy(
        dates.weekday_index(F.col("order_date")).alias("weekday"), dates.weekday_name(F.col("order_date")).alias("name")
    ).agg(F.sum("order_count").alias("orders"), numbers.half_even(numbers.money_sum(F.col("sales_amount")), 2).alias("revenue"))


# Quality ------------------------------------------------------------------

def _typed_orders(spark, sf, *columns):
    return quality.normalise_types(star.raw_orders(spark, sf, *columns))


@query
def missing_counts(spark, sf):
    raw = star.raw_orders(spark, sf)
    return quality.missing_counts(raw.drop("input_position"))


@query
def outlier_counts(spark, sf):
    return quality.outlier_counts(
        _typed_orders(spark, sf, "Quantity", "Unit_Price", "Discount", "Total_Amount"), BOUNDS
    )


@query
def enum_violations(spark, sf):
    return quality.enum_violations(
        star.raw_orders(spark, sf, "Source", "Season", "Category", "Size", "Gender", "Age_Group", "Payment_Method"),
        {**ENUMS, "Payment_Method": schemas.PAYMENT_METHODS},
    )


@query
def schema_violations(spark, sf):
    columns = [
        "Order_ID", "Source", "Region", "Order_Date", "Season", "Category", "Product_Code", "Size", "Gender",
        "Quantity", "Unit_Price", "Discount", "Total_Amount", "Age_Group", "Payment_Method",
    ]
    return quality.schema_violations(_typed_orders(spark, sf, *columns))


@query
def normalise_types(spark, sf):
    typed = _typed_orders(spark, sf, "Order_Date", "Quantity")
    return typed.groupBy(F.year("Order_Date").alias("year")).agg(
        F.count("*").alias("row_count"), F.count("Quantity").alias("quantities"),
        F.sum("Quantity").cast("long").alias("quantity"),
    )


@query
def median_fill(spark, sf):
    columns = ["Order_ID", "Quantity", "Unit_Price", "Discount", "Total_Amount", "input_position"]
    fields = ["Quantity", "Unit_Price", "Discount", "Total_Amount"]
    kept = quality.null_outliers(_typed_orders(spark, sf, *columns), BOUNDS)
    filled = quality.fill_medians(kept, fields)
    return _rounded(filled.select("Order_ID", *fields), Unit_Price=4, Discount=4, Total_Amount=4)


@query
def dedup_first(spark, sf):
    first = quality.keep_first(star.raw_orders(spark, sf, "Order_ID", "Quantity", "Discount", "input_position"))
    return first.drop("input_position")


@query
def clean_orders(spark, sf):
    cleaned = quality.clean_orders(star.raw_orders(spark, sf), BOUNDS, stamp=False)
    return _rounded(_dated(cleaned, "Order_Date"), Unit_Price=4, Discount=4, Total_Amount=4)


@query
def quality_report(spark, sf):
    return quality.quality_report(star.raw_orders(spark, sf), BOUNDS)


def _checked(spark, sf):
    columns = [
        "Order_ID", "Source", "Region", "Order_Date", "Season", "Category", "Product_Code", "Quantity", "Unit_Price",
    ]
    return ingest.validate(star.raw_orders(spark, sf, *columns))


@query
def validate_reasons(spark, sf):
    return _checked(spark, sf).groupBy("reject_reason").agg(F.count("*").alias("records"))


@query
def ingest_stats(spark, sf):
    return ingest.ingest_stats(_checked(spark, sf))


@query
def unknown_sources(spark, sf):
    known, unknown = selection.known_sources(star.raw_orders(spark, sf, "Order_ID", "Source"))
    counted = lambda df, reason: df.groupBy("Source").agg(F.count("*").alias("records")).withColumn("reason", reason)
    return counted(known, F.lit("")).unionByName(
        unknown.groupBy("Source").agg(F.count("*").alias("records"), F.first("reject_reason").alias("reason"))
    )


# Order roll-ups ------------------------------------------------------------

def _rollup_input(spark, sf, *dims):
    return _typed_orders(spark, sf, "Order_ID", "Quantity", "Total_Amount", *dims)


@query
def rollup_region(spark, sf):
    return rollups.rollup_region(_rollup_input(spark, sf, "Region"))


@query
def rollup_date(spark, sf):
    return _dated(rollups.rollup_date(_rollup_input(spark, sf, "Order_Date")), "Order_Date")


@query
def rollup_category(spark, sf):
    return rollups.rollup_category(_rollup_input(spark, sf, "Category"))


@query
def rollup_region_date(spark, sf):
    return _dated(rollups.rollup_region_date(_rollup_input(spark, sf, "Region", "Order_Date")), "Order_Date")


@query
def rollup_region_category(spark, sf):
    return rollups.rollup_region_category(_rollup_input(spark, sf, "Region", "Category"))


@query
def rollup_season_category(spark, sf):
    return rollups.rollup_season_category(_rollup_input(spark, sf, "Season", "Category"))


@query
def rollup_all(spark, sf):
    return _dated(
        rollups.rollup_all(_rollup_input(spark, sf, "Region", "Order_Date", "Category", "Season")), "Order_Date"
    )


@query
def rollup_sizes(spark, sf):
    return rollups.rollup_group_counts(
        rollups.rollup_all(_rollup_input(spark, sf, "Region", "Order_Date", "Category", "Season"))
    )


@query
def keyed_reduce(spark, sf):
    return rollups.keyed_reduce(_rollup_input(spark, sf, "Region", "Category"), "Region", "Category")


@query
def keyed_reduce_date(spark, sf):
    return rollups.keyed_reduce(_rollup_input(spark, sf, "Region", "Order_Date"), "Region", "Order_Date")


# Baskets -------------------------------------------------------------------

def _order_baskets(spark, sf):
    return baskets.baskets_from_sales(star.sales(spark, sf, "order_id", "category"), ["order_id"], "category")


def _itemsets(spark, sf):
    return baskets.frequent_itemsets(_order_baskets(spark, sf), SUPPORT, 3)


def _rules(spark, sf):
    return baskets.association_rules(_itemsets(spark, sf), CONFIDENCE)


def _item_text(df: DataFrame) -> DataFrame:
    return _rounded(df.withColumn("items", baskets.set_text("items")), support=9)


def _rule_text(df: DataFrame) -> DataFrame:
    sides = {c: baskets.set_text(c) for c in ("antecedent", "consequent")}
    finite = F.col("conviction") < float("inf")
    shown = df.withColumns(sides).withColumn("certain", ~finite).withColumn(
        "conviction", F.when(finite, F.col("conviction"))
    )
    return _rounded(shown, support=9, confidence=9, lift=9, leverage=9, conviction=6)


@query
def baskets_city_day(spark, sf):
    built = baskets.baskets_from_sales(star.sales(spark, sf, "order_date", "city", "category"))
    return _dated(built.withColumn("items", baskets.set_text("items")), "order_date")


@query
def baskets_order(spark, sf):
    built = baskets.baskets_from_sales(star.sales(spark, sf, "order_id", "product"), ["order_id"], "product")
    return built.select("order_id", baskets.set_text("items").alias("items"), F.size("items").alias("size"))


def _limited_baskets(spark, sf, n):
    built = baskets.baskets_from_sales(star.sales(spark, sf, "order_id", "product"), ["order_id"], "product")
    return baskets.limit_baskets(built, n, "order_id").select("order_id", baskets.set_text("items").alias("items"))


@query
def first_baskets(spark, sf):
    """The first baskets in key order, up to the analysis' cap."""
    return _limited_baskets(spark, sf, BASKET_CAP)


@query
def first_baskets_whole(spark, sf):
    """A cap beyond the table keeps every basket."""
    return _limited_baskets(spark, sf, 1 << 40).agg(F.count("*").alias("baskets"), F.max("order_id").alias("last_order"))


@query
def basket_matrix(spark, sf):
    types = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    return baskets.basket_matrix(_order_baskets(spark, sf), ["order_id"], types)


@query
def basket_item_text(spark, sf):
    """Comma-separated item texts read back as lists, empty ones dropped."""
    built = _order_baskets(spark, sf)
    texts = built.select("order_id", F.array_join("items", ",").alias("text"))
    lists = order_files.drop_empty_baskets(texts.withColumn("Items", order_files.split_items(F.col("text"))))
    return lists.groupBy(F.size("Items").alias("size")).agg(F.count("*").alias("baskets"))


@query
def itemset_1(spark, sf):
    built = _order_baskets(spark, sf)
    supports = baskets.item_supports(built).withColumn("support", F.col("n") / baskets.basket_total(built))
    return _rounded(supports, support=9)


@query
def itemset_2(spark, sf):
    return _item_text(_itemsets(spark, sf).where("size = 2")).drop("size")


@query
def itemset_3(spark, sf):
    return _item_text(_itemsets(spark, sf).where("size = 3")).drop("size")


def _long_sets(spark, sf, size):
    mined = baskets.frequent_itemsets(_order_baskets(spark, sf), 0.001, 5)
    return _item_text(mined.where(F.col("size") == size)).drop("size")


@query
def itemset_4(spark, sf):
    return _long_sets(spark, sf, 4)


@query
def itemset_5(spark, sf):
    return _long_sets(spark, sf, 5)


@query
def itemset_candidates(spark, sf):
    candidates = baskets.candidate_itemsets(_itemsets(spark, sf), 3)
    return candidates.select(baskets.set_text("items").alias("items"))


@query
def candidate_supports(spark, sf):
    candidates = baskets.candidate_itemsets(_itemsets(spark, sf), 3)
    counted = baskets.itemset_supports(_order_baskets(spark, sf), candidates)
    return counted.select(baskets.set_text("items").alias("items"), "n")


@query
def frequent_itemsets(spark, sf):
    return _item_text(_itemsets(spark, sf))


@query
def frequent_products(spark, sf):
    built = baskets.baskets_from_sales(star.sales(spark, sf, "order_id", "product"), ["order_id"], "product")
    return _item_text(baskets.frequent_itemsets(built, 0.01, 3))


@query
def fpgrowth_itemsets(spark, sf):
    return _item_text(baskets.fpgrowth_itemsets(_order_baskets(spark, sf), SUPPORT, 3))


@query
def top_itemsets(spark, sf):
    return _item_text(baskets.top_itemsets(_itemsets(spark, sf), 10, min_size=2))


@query
def assoc_rules(spark, sf):
    return _rule_text(_rules(spark, sf))


@query
def rules_min_lift(spark, sf):
    return _rule_text(baskets.top_rules(_rules(spark, sf), 20, min_lift=0.995))


@query
def rule_network_edges(spark, sf):
    return _rounded(baskets.rule_network_edges(_rules(spark, sf)), value=9, width=9)


@query
def rule_network_nodes(spark, sf):
    return baskets.rule_network_nodes(_rules(spark, sf))


@query
def basket_headline(spark, sf):
    itemsets = _itemsets(spark, sf)
    rules = baskets.association_rules(itemsets, CONFIDENCE)
    return baskets.headline_counts(_order_baskets(spark, sf), itemsets, rules)


# Drivers -------------------------------------------------------------------

def _features(spark, sf):
    return drivers.feature_table(
        star.sales(spark, sf, "city", "category", "season", "sales_amount", "order_count", "profit"), *TIERS
    )


@query
def feature_table(spark, sf):
    return _rounded(_features(spark, sf), amount=2, profit=2)


@query
def price_tiers(spark, sf):
    return _features(spark, sf).groupBy("Price_Range", "Season").agg(
        F.count("*").alias("combinations"), F.sum("Sales_Volume").alias("volume")
    )


@query
def combination_stats(spark, sf):
    return _rounded(drivers.combination_stats(_features(spark, sf)), avg_sales=4)


@query
def one_hot_long(spark, sf):
    return drivers.one_hot_long(_features(spark, sf))


@query
def one_hot_wide(spark, sf):
    table = written(_features(spark, sf), "driver-features")
    found = drivers.encoded_values(table)
    return drivers.one_hot_wide(table, found).drop("amount", "profit")


@query
def decision_rules(spark, sf):
    return _rounded(drivers.decision_rules(_features(spark, sf)), support=9, confidence=9, sales_impact=4)


@query
def stocking_insights(spark, sf):
    return _rounded(drivers.stocking_insights(_features(spark, sf)), expected_sales=4)


@query
def insight_filter(spark, sf):
    return _rounded(
        drivers.filter_insights(drivers.stocking_insights(_features(spark, sf)), priority=labels.PRIORITIES[0]),
        expected_sales=4,
    )


@query
def heatmap_cells(spark, sf):
    return _rounded(drivers.heatmap_cells(drivers.stocking_insights(_features(spark, sf))), expected_sales=4)


def _trained(spark, sf):
    table = written(_features(spark, sf), "driver-features")
    return table, tree.train_tree(table)


@query
def tree_metrics(spark, sf):
    return _rounded(tree.tree_metrics(*_trained(spark, sf)), rmse=6, mae=6, r2=9)


@query
def tree_importance(spark, sf):
    return _rounded(drivers.top_features(tree.importance(spark, _trained(spark, sf)[1])), importance=9)


@query
def tree_predictions(spark, sf):
    picked = tree.prediction_sample(*_trained(spark, sf))
    return picked.withColumn("features", F.array_join("features", "+"))


@query
def tree_checks(spark, sf):
    return tree.checks(*_trained(spark, sf))


def _cross_validated(spark, sf):
    return tree.cross_validation(_features(spark, sf))


@query
def tree_splits(spark, sf):
    """Every split of the tree over all rows and of the five that leave out a fold."""
    return _rounded(tree.split_table(spark, _cross_validated(spark, sf)[0]), mean=6, gain=3)


@query
def cv_mse(spark, sf):
    """Rows and held-out error of every fold."""
    return _rounded(_cross_validated(spark, sf)[1], mse=4)


@query
def driver_analysis(spark, sf):
    """Headline figures of the whole driver analysis."""
    sales = star.sales(spark, sf, "city", "category", "season", "sales_amount", "order_count", "profit")
    result = analyses.run_drivers(sales, low=TIERS[0], mid=TIERS[1])
    figures = result.metrics.crossJoin(result.sizes).withColumn("cv_mse", F.lit(result.cross_validated_mse))
    counts = {"rules": result.rules, "insights": result.insights, "sample": result.sample, "used_features": result.importance}
    for name, frame in counts.items():
        figures = figures.withColumn(name, F.lit(frame.count()))
    return _rounded(figures, rmse=6, mae=6, r2=9, cv_mse=4)


# Forecast ------------------------------------------------------------------

def _daily(spark, sf, keys=SERIES_KEYS):
    return series.daily_series(star.sales(spark, sf, *keys, "order_date", "sales_amount"), keys)


def _window(spark, sf):
    return series.long_enough(series.fit_window(_daily(spark, sf), SERIES_KEYS))


@query
def daily_series(spark, sf):
    return _rounded(_dated(_daily(spark, sf, ["category", "city"])), y=2)


@query
def fit_window(spark, sf):
    return _rounded(_dated(series.standardise(_window(spark, sf), SERIES_KEYS)), y=2, mean=2, sd=2, z=6)


@query
def stationarity(spark, sf):
    return series.stationarity(forecast.prepare(_daily(spark, sf), SERIES_KEYS), SERIES_KEYS)


@query
def diff_order(spark, sf):
    rows = forecast.with_model_input(forecast.prepare(_daily(spark, sf), SERIES_KEYS), SERIES_KEYS)
    return _rounded(_dated(rows.select(*SERIES_KEYS, "ds", "d", "x")), x=6)


@query
def ar_fit(spark, sf):
    rows, _ = forecast.fit_models(_daily(spark, sf), SERIES_KEYS)
    fitted = forecast.fit(rows, SERIES_KEYS)
    return _rounded(fitted, **{c: 6 for c in fitted.columns if c.startswith("ar")})


@query
def order_selection(spark, sf):
    _, models = forecast.fit_models(_daily(spark, sf), SERIES_KEYS)
    return _rounded(models, phi1=6, phi2=6, rss=6, sigma2=6, aic=6, bic=6)


@query
def fitted_series(spark, sf):
    rows, models = forecast.fit_models(_daily(spark, sf), SERIES_KEYS)
    return _rounded(_dated(forecast.fitted_values(rows, models, SERIES_KEYS)), y=2, x=6, fitted_x=6, fitted=2)


@query
def fitted_metrics(spark, sf):
    rows, models = forecast.fit_models(_daily(spark, sf), SERIES_KEYS)
    scored = forecast.fit_metrics(forecast.fitted_values(rows, models, SERIES_KEYS), models, SERIES_KEYS)
    return _rounded(scored, rmse=2, mae=2, smape=6, aic=6, bic=6)


@query
def ar_forecast(spark, sf):
    rows, models = forecast.fit_models(_daily(spark, sf), SERIES_KEYS)
    path = forecast.standardised_forecast(rows, models, SERIES_KEYS, STEPS)
    return _rounded(path.select(*SERIES_KEYS, "step", "x_hat", "z_hat"), x_hat=6, z_hat=6)


@query
def weekday_effects(spark, sf):
    return _rounded(series.weekday_effects(_window(spark, sf), SERIES_KEYS), effect=2)


@query
def holiday_factor(spark, sf):
    days = star.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("ds")).distinct()
    return _dated(_rounded(forecast.with_holiday_factor(days), factor=6))


def _shown_forecast(df):
    return _rounded(_dated(df), value=2, lower=2, upper=2)


@query
def forecast_interval(spark, sf):
    return _shown_forecast(forecast.forecast(_daily(spark, sf), SERIES_KEYS, STEPS))


@query
def forecast_explicit_order(spark, sf):
    return _shown_forecast(
        forecast.forecast(_daily(spark, sf), SERIES_KEYS, STEPS, order=(2, 1, 0), band="normal")
    )


@query
def forecast_total(spark, sf):
    return _shown_forecast(forecast.forecast(_daily(spark, sf, []), [], STEPS))


@query
def forecast_d0(spark, sf):
    return _shown_forecast(forecast.forecast(_daily(spark, sf), SERIES_KEYS, STEPS, order=(1, 0, 0)))


@query
def forecast_d1(spark, sf):
    return _shown_forecast(forecast.forecast(_daily(spark, sf), SERIES_KEYS, STEPS, order=(1, 1, 0)))


@query
def ar_fit_p3(spark, sf):
    _, models = forecast.fit_models(_daily(spark, sf), SERIES_KEYS, (3, 1, 0))
    shown = models.withColumn("phi3", F.get("phis", F.lit(2))).drop("phis")
    return _rounded(shown, **{c: 6 for c in ("phi1", "phi2", "phi3", "rss", "sigma2", "aic", "bic")})


@query
def fitted_series_p3(spark, sf):
    return _fitted(spark, sf, (3, 1, 0))


def _fitted(spark, sf, order):
    rows, models = forecast.fit_models(_daily(spark, sf), SERIES_KEYS, order)
    return _rounded(_dated(forecast.fitted_values(rows, models, SERIES_KEYS)), y=2, x=6, fitted_x=6, fitted=2)


@query
def fitted_series_d0(spark, sf):
    return _fitted(spark, sf, (1, 0, 0))


@query
def fitted_series_d1(spark, sf):
    return _fitted(spark, sf, (1, 1, 0))


@query
def skipped_series(spark, sf):
    keys = ["city", "product"]
    windowed = series.fit_window(_daily(spark, sf, keys), keys)
    return series.skipped_series(windowed, keys, minimum=100)


@query
def linear_trend(spark, sf):
    return _rounded(series.linear_trend(_window(spark, sf), SERIES_KEYS), slope=4, intercept=2)


@query
def weekly_season(spark, sf):
    return _rounded(series.weekly_season(_window(spark, sf), SERIES_KEYS), season=2)


@query
def residual_season(spark, sf):
    return _rounded(series.residual_season(_window(spark, sf), SERIES_KEYS), season=2)


@query
def acf(spark, sf):
    flat = series.detrended(_window(spark, sf), SERIES_KEYS)
    return _rounded(series.autocorrelation(flat, SERIES_KEYS, 5), acf=6)


@query
def moving_average(spark, sf):
    trailing = series.trailing_change_mean(_window(spark, sf), SERIES_KEYS, 3)
    both = series.centred_mean(trailing, SERIES_KEYS, "dy", 4, "centred")
    return _rounded(_dated(both.select(*SERIES_KEYS, "ds", "ma", "centred")), ma=2, centred=2)


@query
def season_decompose(spark, sf):
    return _rounded(
        _dated(series.decompose(_window(spark, sf), SERIES_KEYS)), y=2, trend=2, seasonal=2, residual=2
    )


@query
def trend_season_fit(spark, sf):
    fitted = forecast.trend_season_models(_window(spark, sf), SERIES_KEYS)
    return _rounded(forecast.trend_season_criteria(fitted, SERIES_KEYS).drop("rss"), aic=4, bic=4)


@query
def trend_season_forecast(spark, sf):
    return _rounded(
        _dated(forecast.trend_season_forecast(_window(spark, sf), SERIES_KEYS, STEPS)), value=2
    )


@query
def chart_series(spark, sf):
    daily = written(_daily(spark, sf), "daily-series")
    predicted = forecast.forecast(daily, SERIES_KEYS, STEPS)
    return _rounded(_dated(forecast.chart_series(_history(daily), predicted, SERIES_KEYS)), value=2)


def _history(daily):
    return series.finite_points(daily)


# Segments ------------------------------------------------------------------

def _behaviour(spark, sf):
    return segments.behaviour_table(star.sales(
        spark, sf, "customer_id", "order_id", "order_date", "sales_amount", "category", "season", "region"
    ))


def _fixed_labels(spark, sf):
    """Market segment as a fixed label, so the metrics have exact answers."""
    return star.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("cluster")
    )


def _labelled(spark, sf):
    return _behaviour(spark, sf).join(_fixed_labels(spark, sf), "customer_id")


def _scaled(spark, sf):
    return segments.prepared_features(_behaviour(spark, sf)).join(_fixed_labels(spark, sf), "customer_id")


@query
def behaviour_table(spark, sf):
    return _rounded(
        _dated(_behaviour(spark, sf), "Last_Purchase_Date"), Total_Spend=2, Avg_Order_Value=4, Purchase_Frequency=6
    )


@query
def iqr_clip(spark, sf):
    filled = segments.fill_features(_behaviour(spark, sf).select("customer_id", *segments.FEATURES))
    return _rounded(segments.clip_outliers(filled), **{f: 4 for f in segments.FEATURES})


@query
def feature_quartiles(spark, sf):
    long = quantiles.exact_quantiles(_behaviour(spark, sf), segments.FEATURES, [0.25, 0.5, 0.75])
    return _rounded(long, value=4)


@query
def scaled_features(spark, sf):
    return _rounded(segments.prepared_features(_behaviour(spark, sf)), **{f: 6 for f in segments.FEATURES})


def _profile(spark, sf):
    return segments.cluster_profile(_labelled(spark, sf))


PROFILE_DIGITS = {
    "avg_total_orders": 4, "avg_total_spend": 2, "avg_order_value": 2,
    "avg_purchase_frequency": 6, "avg_days_since_last_purchase": 4,
}


@query
def cluster_profile(spark, sf):
    return _rounded(_profile(spark, sf), **PROFILE_DIGITS)


@query
def cluster_top3(spark, sf):
    return segments.cluster_favourites(_labelled(spark, sf))


@query
def segment_assignments(spark, sf):
    labelled = _labelled(spark, sf)
    return segments.assignments(labelled, segments.cluster_profile(labelled))


@query
def customer_portrait(spark, sf):
    labelled = _labelled(spark, sf)
    assigned = segments.assignments(labelled, segments.cluster_profile(labelled))
    one = segments.customer_portrait(_behaviour(spark, sf), assigned, 42)
    return _rounded(_dated(one, "Last_Purchase_Date"), Total_Spend=2, Avg_Order_Value=4, Purchase_Frequency=6)


@query
def ch_score(spark, sf):
    return _rounded(segments.calinski_harabasz(_scaled(spark, sf)), calinski_harabasz=6)


@query
def db_score(spark, sf):
    return _rounded(segments.davies_bouldin(_scaled(spark, sf)), davies_bouldin=6)


@query
def inertia(spark, sf):
    return _rounded(segments.inertia(_scaled(spark, sf)), inertia=4)


@query
def feature_weight(spark, sf):
    centroids = segments.cluster_stats(_scaled(spark, sf))
    return _rounded(segments.feature_weights(centroids), weight=6)


@query
def radar_axes(spark, sf):
    return _rounded(segments.radar_axes(_profile(spark, sf)), axis_max=4)


@query
def segment_share(spark, sf):
    return _rounded(segments.segment_shares(_profile(spark, sf)), share=6)


def _prepared(spark, sf):
    return written(segments.prepared_features(_behaviour(spark, sf)), "prepared")


@query
def kmeans_assignments(spark, sf):
    return analyses.run_segmentation(_behaviour(spark, sf), k=4).assignments


@query
def kmeans_restarts(spark, sf):
    """Iterations and inertia of every number of clusters and seed."""
    models = kmeans.fit(_prepared(spark, sf))
    rows = [(m.k, m.seed, m.iterations, m.inertia) for m in models]
    return _rounded(spark.createDataFrame(rows, "k int, seed int, iterations int, inertia double"), inertia=4)


@query
def kmeans_checks(spark, sf):
    """Customers, those nearer to another centre, and centres away from the mean of their members."""
    prepared = _prepared(spark, sf)
    model = kmeans.best_of(kmeans.fit(prepared, [4]))[4]
    placed = kmeans.assigned(prepared, model)
    return segments.misplaced(placed, model.centres).crossJoin(segments.moved(placed, model.centres, kmeans.TOL))


@query
def silhouette_fixed(spark, sf):
    """Silhouette of the fixed labels."""
    labelled = segments.vectors(written(_scaled(spark, sf), "scaled-labels"))
    numbered = StringIndexer(inputCol="cluster", outputCol="number").fit(labelled).transform(labelled)
    value = segments.silhouette(numbered, "number")
    return _rounded(spark.createDataFrame([(value,)], "silhouette double"), silhouette=6)


@query
def choose_k(spark, sf):
    """Silhouette of every number of clusters tried, and the one chosen."""
    chosen, best = kmeans.choose(_prepared(spark, sf))
    rows = [(k, m.silhouette, k == chosen.k) for k, m in best.items()]
    return _rounded(spark.createDataFrame(rows, "k int, silhouette double, chosen boolean"), silhouette=6)


# Streaming -----------------------------------------------------------------

def _order_stream(spark, sf, *columns):
    """Order lines as a file stream, joined to the static tables."""
    schema = star.table(spark, sf, "lineitem").schema
    lines = streams.file_stream(spark, sf, schema, name_filter="lineitem.parquet")
    return star.raw_orders(spark, sf, *columns, lines=lines)


STREAM_COLUMNS = [
    "Order_ID", "Source", "Region", "Order_Date", "Season", "Category", "Product_Code", "Quantity", "Unit_Price",
]


@query
def stream_ingest(spark, sf):
    stored = streams.ingest_now(_order_stream(spark, sf, *STREAM_COLUMNS))
    return stored.groupBy("Source", "outcome", "reject_reason").agg(
        F.count("*").alias("records"), F.sum("Quantity").alias("quantity")
    )


@query
def stream_source_counts(spark, sf):
    return streams.source_counts_now(_order_stream(spark, sf, *STREAM_COLUMNS))


def _event_stream(spark, sf):
    schema = star.table(spark, sf, "events").schema
    return streams.file_stream(spark, sf, schema, name_filter="events.parquet").withColumn(
        "ts", F.col("ts").cast("timestamp")
    )


@query
def stream_daily_sales(spark, sf):
    return _rounded(streams.daily_rollup_now(_event_stream(spark, sf), "ts", "value"), revenue=2)


@query
def stream_first_sightings(spark, sf):
    raw = _order_stream(spark, sf, "Order_ID", "Order_Date")
    timed, _ = streams.dated(raw, "Order_Date", "at")
    seen = streams.first_sightings_now(timed, "Order_ID", "at", "7 days")
    return seen.select("Order_ID", "Order_Date")


@query
def stream_first_records(spark, sf):
    """The first event of every user over many batches in any order of time."""
    folder = new_work_dir(spark, "event-files")
    events = star.table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    events.withColumn("ts", F.col("ts").cast("timestamp")).repartition(5, F.col("event_id") % 5).write.parquet(folder)
    stream = streams.file_stream(spark, folder, spark.read.parquet(folder).schema, files_per_batch=2)
    return streams.first_records_now(stream, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query
def stream_undated(spark, sf):
    _, undated = streams.dated(_order_stream(spark, sf, "Order_ID", "Order_Date"), "Order_Date", "at")
    return streams.rejected_now(undated)


def catalogue() -> dict[str, Query]:
    """All registered queries."""
    return dict(QUERIES)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue, profit and average price per category."""
    return sales_by_category(spark, sf)
