"""Yearly sales files: header map, tolerant typing, union over years."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from salesweft.functions import dates, numbers

log = logging.getLogger(__name__)

# File header -> column name.
COLUMN_NAMES = {
    "商店ID": "store_id",
    "门店所在城市": "city",
    "渠道": "channel",
    "性别群体": "gender",
    "年龄群体": "age_group",
    "产品类别": "category",
    "客户数量": "customer_count",
    "销售金额": "sales_amount",
    "订单数量": "order_count",
    "购买的产品数量": "product_count",
    "成本": "cost",
    "单价": "unit_price",
    "利润": "profit",
    "订单日期": "order_date",
    "星期": "weekday",
}
DISPLAY_NAMES = {name: header for header, name in COLUMN_NAMES.items()}
NUMERIC_COLUMNS = [
    "customer_count", "sales_amount", "order_count", "product_count", "cost", "unit_price", "profit",
]
# The years on file.
FILE_YEARS = (2023, 2024, 2025)


def to_columns(df: DataFrame) -> DataFrame:
    """File headers -> column names; unknown headers stay as they are."""
    return df.withColumnsRenamed({h: n for h, n in COLUMN_NAMES.items() if h in df.columns})


def to_headers(df: DataFrame) -> DataFrame:
    """Column names -> file headers, for display."""
    return df.withColumnsRenamed({n: h for n, h in DISPLAY_NAMES.items() if n in df.columns})


def type_sales(df: DataFrame) -> DataFrame:
    """Typed sales rows from text columns, with calendar parts added."""
    present = [c for c in NUMERIC_COLUMNS if c in df.columns]
    typed = df.withColumns({
        "order_date": dates.sales_file_date(F.col("order_date")),
        **{c: numbers.number_or_zero(F.col(c)) for c in present},
    })
    return typed.withColumns({
        "year": F.year("order_date"),
        "month": F.month("order_date"),
        "day": F.dayofmonth("order_date"),
        "season": dates.season_of_month(F.month("order_date")),
    })


def read_sales_file(spark: SparkSession, path: str) -> DataFrame:
    """One sales file (or a folder of equally headed parts).

    Columns are matched by header, so they are read as text and converted
    with ``try_`` functions; nothing is inferred from the data.
    """
    raw = spark.read.options(header=True, encoding="UTF-8", escape='"').csv(path)
    return type_sales(to_columns(raw))


def read_all_years(
    spark: SparkSession, folder: str, years=FILE_YEARS, pattern: str = "{year}_sales.csv"
) -> DataFrame | None:
    """Union of the yearly files; missing years are skipped with a warning."""
    frames = []
    for year in years:
        path = f"{folder}/{pattern.format(year=year)}"
        try:
            frames.append(read_sales_file(spark, path))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("no sales file %s, year skipped", path)
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_sales_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The fact as Parquet by year, so that a year filter prunes folders."""
    df.write.mode(mode).partitionBy("year").parquet(path)


def read_sales_year(spark: SparkSession, path: str, year: int) -> DataFrame:
    """One year of a table written by :func:`write_sales_table`."""
    return spark.read.parquet(path).where(F.col("year") == year)
