"""Column expressions and table reads that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a null key falls into fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.encode(key.cast("string"), "UTF-8")), F.lit(parts)), F.lit(0))


def spread(*columns: Column | str) -> Column:
    """A value in [0, 1) that depends only on the columns' values."""
    return (F.pmod(F.xxhash64(*columns), F.lit(1 << 53)) / F.lit(float(1 << 53))).cast("double")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body over a value that is computed once.

    Lambdas that need another column get it this way, as a lambda variable:
    the optimizer fails on unions below a lambda that holds a column itself.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))
    return F.filter(F.split(plain, " ", -1), lambda w: w != "")
