"""Holiday and promotion days with their sales multipliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values: (month, day, lowest multiplier, highest multiplier).
HOLIDAYS = [
    (1, 1, 1.2, 1.4),
    (1, 28, 1.3, 1.6), (1, 29, 1.3, 1.6), (1, 30, 1.3, 1.6), (1, 31, 1.3, 1.6),
    (2, 1, 1.3, 1.6), (2, 2, 1.3, 1.6), (2, 3, 1.3, 1.6), (2, 4, 1.2, 1.5),
    (2, 14, 1.1, 1.3),
    (3, 8, 1.1, 1.3),
    (4, 4, 1.1, 1.3), (4, 5, 1.1, 1.3), (4, 6, 1.1, 1.3),
    (5, 1, 1.2, 1.5), (5, 2, 1.2, 1.5), (5, 3, 1.1, 1.4), (5, 4, 1.1, 1.3), (5, 10, 1.1, 1.3),
    (6, 15, 1.2, 1.5), (6, 16, 1.2, 1.5), (6, 17, 1.2, 1.5), (6, 18, 1.3, 1.6), (6, 19, 1.1, 1.3),
    (6, 21, 1.1, 1.3),
    (8, 25, 1.1, 1.3),
    (9, 15, 1.2, 1.5), (9, 16, 1.2, 1.5), (9, 17, 1.1, 1.4),
    (10, 1, 1.4, 1.7), (10, 2, 1.4, 1.7), (10, 3, 1.3, 1.6), (10, 4, 1.2, 1.5),
    (10, 5, 1.2, 1.5), (10, 6, 1.1, 1.4), (10, 7, 1.1, 1.3),
    (11, 10, 1.3, 1.6), (11, 11, 1.5, 2.0), (11, 12, 1.2, 1.5),
    (12, 12, 1.3, 1.6), (12, 25, 1.1, 1.3),
    (12, 28, 1.1, 1.3), (12, 29, 1.1, 1.3), (12, 30, 1.2, 1.4), (12, 31, 1.2, 1.4),
]


def holiday_map() -> Column:
    """Literal map of 100 * month + day to (low, high)."""
    pairs = [
        x for month, day, low, high in HOLIDAYS
        for x in (F.lit(100 * month + day), F.struct(F.lit(low).alias("low"), F.lit(high).alias("high")))
    ]
    return F.create_map(*pairs)


def holiday_table(spark: SparkSession) -> DataFrame:
    """``(h_month, h_day, low, high)``; a caller may pass its own instead."""
    return spark.createDataFrame(HOLIDAYS, "h_month int, h_day int, low double, high double")
