"""Roll-ups kept up to date as deliveries arrive.

A delivery's orders are summed at the finest grain of the roll-ups, and these
partial sums, one row per group of the delivery, are kept in a folder of their
own.  Sums and counts of partial sums are those of the rows, so a roll-up is
made from the folders alone: a new delivery costs reading its own rows, and a
delivery that is added again replaces its folder and counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesweft.operators import rollups


def add_delivery(orders: DataFrame, out: str, delivery: int) -> None:
    """Keep the partial sums of a delivery's orders; added again, it replaces itself."""
    sums = rollups.partial_sums(orders).withColumn("delivery", F.lit(delivery))
    sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("delivery").parquet(out)


def kept_rollups(spark: SparkSession, out: str) -> DataFrame:
    """All roll-ups over every delivery so far."""
    return rollups.rollup_partials(spark.read.parquet(out).drop("delivery"))
