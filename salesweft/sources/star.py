"""Sales fact and order records over a star schema of order lines.

The fact is normally one wide table.  Here its columns come from several
tables, so each column names the table it needs and only those tables are
joined: revenue by category never touches customers.  Dimension joins carry no
hint; Spark broadcasts a side only when its known or measured size is below
the configured threshold, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesweft.functions import dates, numbers
from salesweft.sources import schemas

# column -> tables it needs besides the order lines
FACT_TABLES = {
    "store_id": (),
    "city": ("orders", "customer", "nation"),
    "region": ("orders", "customer", "nation", "region"),
    "channel": ("orders",),
    "gender": ("orders", "customer"),
    "age_group": ("orders", "customer"),
    "category": ("part",),
    "product": ("part",),
    "customer_count": (),
    "order_count": (),
    "product_count": (),
    "sales_amount": (),
    "cost": ("part",),
    "profit": ("part",),
    "unit_price": (),
    "order_id": (),
    "customer_id": ("orders",),
    "order_date": ("orders",),
    "year": ("orders",),
    "month": ("orders",),
    "day": ("orders",),
    "season": ("orders",),
    "weekday": ("orders",),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of the star schema."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def age_band(balance: Column) -> Column:
    """Stand-in age group from the account balance."""
    return (
        F.when(balance < 0, "<0")
        .when(balance < 2500, "0-2500")
        .when(balance < 5000, "2500-5000")
        .when(balance < 7500, "5000-7500")
        .otherwise(">=7500")
    )


def _expressions() -> dict[str, Column]:
    amount = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    cost = F.col("l_quantity") * F.col("p_retailprice")
    day = F.col("o_orderdate").cast("date")
    return {
        "store_id": F.col("l_suppkey"),
        "city": F.col("n_name"),
        "region": F.col("r_name"),
        "channel": F.col("o_orderpriority"),
        "gender": F.col("c_mktsegment"),
        "age_group": age_band(F.col("c_acctbal")),
        "category": F.col("p_type"),
        "product": F.col("p_brand"),
        "customer_count": F.lit(1).cast("long"),
        "order_count": F.lit(1).cast("long"),
        "product_count": F.col("l_quantity"),
        "sales_amount": amount,
        "cost": cost,
        "profit": amount - cost,
        "unit_price": F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0)),
        "order_id": F.col("l_orderkey"),
        "customer_id": F.col("o_custkey"),
        "order_date": day,
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "season": dates.season_of_month(F.month(day)),
        "weekday": dates.weekday_name(day),
    }


def _with_places(spark: SparkSession, folder: str, orders: DataFrame, needed: set[str]) -> DataFrame:
    # Each dimension is joined by itself, so that Spark judges its size by
    # itself: a join of dimensions would be estimated as their product.
    if "customer" in needed:
        customer = table(spark, folder, "customer")
        orders = orders.join(customer, orders.o_custkey == customer.c_custkey)
        if "nation" in needed:
            nation = table(spark, folder, "nation")
            orders = orders.join(nation, orders.c_nationkey == nation.n_nationkey)
            if "region" in needed:
                region = table(spark, folder, "region")
                orders = orders.join(region, orders.n_regionkey == region.r_regionkey)
    return orders


def _with_part(spark: SparkSession, folder: str, line: DataFrame, needed: set[str]) -> DataFrame:
    if "part" in needed:
        part = table(spark, folder, "part")
        line = line.join(part, line.l_partkey == part.p_partkey)
    return line


def _join_tables(spark: SparkSession, folder: str, needed: set[str], year: int | None, lines: DataFrame | None):
    line = lines if lines is not None else table(spark, folder, "lineitem")
    if "orders" in needed:
        orders = table(spark, folder, "orders")
        if year:
            orders = orders.where(year_range(F.col("o_orderdate").cast("date"), year))
        orders = _with_places(spark, folder, orders, needed)
        line = line.join(orders, line.l_orderkey == orders.o_orderkey)
    return _with_part(spark, folder, line, needed)


def fact_of(spark: SparkSession, folder: str, lines_and_orders: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The wanted columns of the fact over lines that are joined with their orders already."""
    columns = columns or tuple(FACT_TABLES)
    needed = {t for c in columns for t in FACT_TABLES[c]}
    joined = _with_part(spark, folder, _with_places(spark, folder, lines_and_orders, needed), needed)
    expressions = _expressions()
    return joined.select(*[expressions[c].alias(c) for c in columns])


def year_range(day: Column, year: int) -> Column:
    """Year test as a date range, which reaches the file statistics."""
    return (day >= F.lit(f"{year}-01-01").cast("date")) & (day < F.lit(f"{year + 1}-01-01").cast("date"))


def sales(spark: SparkSession, folder: str, *columns: str, year: int | None = None) -> DataFrame:
    """The sales fact with the wanted columns (all when none are named)."""
    columns = columns or tuple(FACT_TABLES)
    needed = {t for c in columns for t in FACT_TABLES[c]}
    if year:
        needed.add("orders")
    expressions = _expressions()
    joined = _join_tables(spark, folder, needed, year, None)
    return joined.select(*[expressions[c].alias(c) for c in columns])


# Stand-ins for the raw order records.  Faults are put in by fixed rules on
# the part key, so that every engine sees the same dirty rows.
_SOURCE_OF_PRIORITY = {
    "1-URGENT": "ERP",
    "2-HIGH": "POS",
    "3-MEDIUM": "ONLINE_EC",
    "4-NOT SPECIFIED": "APP",
    "5-LOW": "MINI_PROGRAM",
}
_SIZES = ["XS", "S", "M", "L", "XL", "XXL", "Free"]


def _choice(value: Column, mapping: dict) -> Column:
    picked = F.lit(None).cast("string")
    for key, name in mapping.items():
        picked = F.when(value == key, name).otherwise(picked)
    return picked


def _raw_expressions() -> dict[str, tuple[tuple[str, ...], Column]]:
    part, day = F.col("l_partkey"), F.col("o_orderdate").cast("date")
    customer = F.col("o_custkey")
    amount = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    quantity = F.col("l_quantity").cast("long").cast("string")
    return {
        "Order_ID": ((), F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))),
        "Source": (
            ("orders",),
            F.when(part % 83 == 0, "FAX").otherwise(_choice(F.col("o_orderpriority"), _SOURCE_OF_PRIORITY)),
        ),
        "Region": (("orders", "customer", "nation", "region"), F.when(part % 97 != 0, F.col("r_name"))),
        "Store_Code": ((), F.concat(F.lit("S-"), F.col("l_suppkey").cast("string"))),
        "Order_Date": (("orders",), F.when(part % 101 == 0, "soon").otherwise(dates.day_text(day))),
        "Season": (("orders",), dates.season_of_month(F.month(day), dates.SEASONS_EN)),
        "Category": (("part",), F.when(part % 103 != 0, F.col("p_type"))),
        "Product_Code": (("part",), F.concat_ws("-", F.col("p_brand"), part)),
        "Product_Name": (("part",), F.col("p_name")),
        "Size": (
            ("part",),
            F.when(F.col("p_size") % 11 != 0, _choice(F.col("p_size") % 7, dict(enumerate(_SIZES)))),
        ),
        "Quantity": (
            (),
            F.when(part % 89 == 0, "1000").when(part % 79 == 0, "0").when(part % 73 == 0, "n/a")
            .otherwise(quantity),
        ),
        "Unit_Price": (
            (),
            F.when(part % 71 == 0, F.lit(-1.0)).otherwise(F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0))),
        ),
        "Discount": ((), numbers.half_even(F.col("l_extendedprice") * F.col("l_discount"), 4)),
        "Total_Amount": ((), numbers.half_even(amount, 4)),
        "Payment_Method": (
            (),
            F.when(part % 61 == 0, "Barter").when(part % 67 != 0, _choice(F.col("l_suppkey") % 5, dict(enumerate(schemas.PAYMENT_METHODS)))),
        ),
        "Age_Group": (
            ("orders",),
            F.when(customer % 19 == 0, "Old").when(customer % 23 != 0, _choice(customer % 6, dict(enumerate(schemas.ENUMS["Age_Group"])))),
        ),
        "Customer_ID": (("orders",), F.concat(F.lit("CUST-"), customer.cast("string"))),
        "Gender": (
            ("orders",),
            F.when(customer % 17 == 0, "X").when(customer % 13 == 0, F.lit(None).cast("string"))
            .when(customer % 3 == 0, "Male").when(customer % 3 == 1, "Female").otherwise("Unknown"),
        ),
        "input_position": (
            (),
            F.struct(
                "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"
            ),
        ),
    }


def raw_orders(
    spark: SparkSession, folder: str, *columns: str, lines: DataFrame | None = None
) -> DataFrame:
    """Raw order records: text dates and quantities, faults included.

    ``lines`` replaces the order-line table, for example by a stream.
    """
    expressions = _raw_expressions()
    columns = columns or tuple(expressions)
    needed = {t for c in columns for t in expressions[c][0]}
    joined = _join_tables(spark, folder, needed, None, lines)
    return joined.select(*[expressions[c][1].alias(c) for c in columns])
