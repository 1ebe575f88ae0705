"""Validation of incoming order records (batch and streaming alike)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from salesweft.functions import numbers
from salesweft.sources import order_files, schemas

AMOUNTS = ("Unit_Price", "Discount", "Total_Amount")


def unreadable(field: str) -> Column:
    """A value is there but is no number."""
    return F.col(field).isNotNull() & F.col(field).try_cast("double").isNull()


def unusable(field: str) -> Column:
    """A number that no exact sum can hold: not finite, or of 1e26 and more."""
    number = F.col(field).try_cast("double")
    return number.isNotNull() & ~(numbers.is_finite(number) & (F.abs(number) < F.lit(1e26)))


def reject_reason(required: list[str] = schemas.REQUIRED_FIELDS, amounts: tuple[str, ...] = ("Unit_Price",)) -> Column:
    """First failing rule of a record; null when the record is valid.

    A date only has to be present here; cleaning judges whether it is one.
    """
    # The reasons for missing fields, quantities and prices.
    missing = [
        F.when(F.coalesce(F.col(f).cast("string"), F.lit("")) == "", f"Missing required field: {f}")
        for f in required
    ]
    return F.coalesce(
        *missing,
        F.when(unreadable("Quantity"), "Unreadable number: Quantity"),
        F.when(F.col("Quantity").try_cast("double") < 1, "Quantity must be at least 1"),
        F.when(unreadable("Unit_Price"), "Unreadable number: Unit_Price"),
        F.when(F.col("Unit_Price").try_cast("double") < 0, "Unit_Price cannot be negative"),
        *[F.when(unusable(f), f"Number out of range: {f}") for f in amounts],
    )


def unknown_source(sources: list[str] = schemas.SOURCES) -> Column:
    """Reason for records whose source is not a known one."""
    name = F.coalesce(F.col("Source"), F.lit(""))
    return F.when(~name.isin(sources), F.concat(F.lit("Unknown source type: "), name))


def validate(df: DataFrame, sources: list[str] = schemas.SOURCES) -> DataFrame:
    """Defaults filled in, ``reject_reason`` added, number fields typed.

    Takes records as they came, numbers as text or typed.
    """
    filled = order_files.fill_defaults(df)
    amounts = tuple(f for f in AMOUNTS if f in filled.columns)
    judged = filled.withColumn("reject_reason", F.coalesce(unknown_source(sources), reject_reason(amounts=amounts)))
    return order_files.type_numbers(judged)


def valid_records(checked: DataFrame) -> DataFrame:
    """Records without a reject reason."""
    return checked.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_records(checked: DataFrame) -> DataFrame:
    """Records with their reject reason."""
    return checked.where(F.col("reject_reason").isNotNull())


def tag_source(df: DataFrame, source: str) -> DataFrame:
    """All records of a file belong to the source it was delivered by."""
    return df.withColumn("Source", F.lit(source))


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Tagged reads of several sources as one frame."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _record_counts() -> list[Column]:
    return [
        F.count("*").alias("total"),
        F.count_if(F.col("reject_reason").isNull()).alias("valid"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("invalid"),
    ]


def source_counts(checked: DataFrame) -> DataFrame:
    """Total, valid and invalid records per source."""
    return checked.groupBy("Source").agg(*_record_counts())


def ingest_stats(checked: DataFrame) -> DataFrame:
    """:func:`source_counts` plus one row ``ALL`` for the whole input."""
    named = checked.withColumn("Source", F.coalesce("Source", F.lit("")))
    return (
        named.rollup("Source").agg(*_record_counts(), F.grouping("Source").alias("_all"))
        .withColumn("source", F.when(F.col("_all") == 1, "ALL").otherwise(F.col("Source")))
        .select("source", "total", "valid", "invalid")
    )
