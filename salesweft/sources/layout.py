"""Order lines and orders laid out by year and order key.

A sales fact that is read again and again is written once: both tables are
split into folders by order year and, within a year, into buckets by order key
in key order.  A year of the fact then reads that year's files of both tables,
and a join of lines with their orders needs no exchange, since equal keys are
in buckets of equal number.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesweft.session import new_work_dir
from salesweft.sources import star

BUCKET_ROWS = 4_000_000


@dataclass(frozen=True)
class Layout:
    """Names of the two tables in the session's catalogue."""

    orders: str
    lines: str
    folder: str  # of the star-schema tables that are not laid out


def _write(df: DataFrame, key: str, buckets: int, name: str, path: str) -> str:
    # One task per bucket, so a bucket of a year is one file in key order.
    (
        df.repartition(buckets, key).sortWithinPartitions("order_year", key)
        .write.partitionBy("order_year").bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    )
    return name


def lay_out(spark: SparkSession, folder: str, out: str | None = None, buckets: int | None = None) -> Layout:
    """Write orders and lines below ``out`` (a work folder by default) and register both tables."""
    out = out or new_work_dir(spark, "layout")
    name = "fact_" + re.sub(r"\W", "_", out.rstrip("/").rsplit("/", 1)[-1])
    year = F.year(F.col("o_orderdate").cast("date")).alias("order_year")
    orders = star.table(spark, folder, "orders").select("*", year)
    lines = star.table(spark, folder, "lineitem")
    buckets = buckets or max(1, -(-lines.count() // BUCKET_ROWS))
    dated = lines.join(orders.select("o_orderkey", "order_year"), lines.l_orderkey == F.col("o_orderkey")).drop("o_orderkey")
    return Layout(
        _write(orders, "o_orderkey", buckets, f"{name}_orders", f"{out}/orders"),
        _write(dated, "l_orderkey", buckets, f"{name}_lines", f"{out}/lines"),
        folder,
    )


def sales(spark: SparkSession, layout: Layout, *columns: str, year: int | None = None) -> DataFrame:
    """The sales fact over the laid-out tables; a year is read from its own folders."""
    orders, lines = spark.table(layout.orders), spark.table(layout.lines)
    # The order key alone joins, as it alone makes the buckets; the year of a
    # line is that of its order, so each side is pruned by itself.
    if year:
        orders, lines = orders.where(F.col("order_year") == year), lines.where(F.col("order_year") == year)
    joined = lines.drop("order_year").join(orders.drop("order_year"), F.col("l_orderkey") == F.col("o_orderkey"))
    return star.fact_of(spark, layout.folder, joined, columns)
