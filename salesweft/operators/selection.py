"""Filters, distinct values, top-k and last-n."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesweft.session import written
from salesweft.sources import schemas
from salesweft.sources.star import year_range

# Rows whose marks are broadcast at once: 64 rows are one pair of longs.
MARKED_ROWS = 1 << 27


def filter_sales(
    df: DataFrame, year=None, category=None, city=None, gender=None, age_group=None, channel=None
) -> DataFrame:
    """Conjunction of the given equality filters; absent ones do not filter.

    Year 0 counts as absent.  Without a ``year`` column the year becomes a
    date range, which Parquet statistics can use.
    """
    if year:
        df = df.where(F.col("year") == year if "year" in df.columns else year_range(F.col("order_date"), year))
    wanted = {"category": category, "city": city, "gender": gender, "age_group": age_group, "channel": channel}
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def present_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose grouping keys are all present."""
    return df.dropna(subset=list(keys))


def distinct_values(df: DataFrame, field: str) -> DataFrame:
    """Sorted distinct present values; no such field gives no rows."""
    if field not in df.columns:
        return df.sparkSession.createDataFrame([], f"`{field}` string")
    return df.select(field).where(F.col(field).isNotNull()).distinct().orderBy(field)


def filter_options(df: DataFrame, fields: list[str]) -> DataFrame:
    """All distinct values of several fields as ``(field, value)``.

    Unpivoted first: every task then keeps at most the sum of the fields'
    distinct values, where distinct combinations would be their product.
    """
    return (
        df.select(*[F.col(f).cast("string").alias(f) for f in fields]).unpivot([], fields, "field", "value")
        .where(F.col("value").isNotNull()).distinct().orderBy("field", "value")
    )


def distinct_counts(df: DataFrame, fields: dict[str, str], approximate: bool = False) -> DataFrame:
    """Distinct counts of ``field -> output name``; sketches on request."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(f)).alias(name) for f, name in fields.items()])


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows of a total order (kept per task before the merge)."""
    return df.orderBy(*order).limit(n)


def placed(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """Add every row's place in the order, from 0, and the number of rows as ``<name>_of``.

    Rows are range-sorted and written; a place is the count of the slices
    before a row's own plus the place in it, so no task orders the table.
    """
    cut = f"_{name}_slice"
    sliced = written(df.repartitionByRange(*order).withColumn(cut, F.spark_partition_id()), "slices")
    counts = sliced.groupBy(cut).agg(F.count("*").alias("_n"))
    before = counts.select(
        cut, (F.sum("_n").over(Window.orderBy(cut)) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias(f"{name}_of"),
    )
    here = F.row_number().over(Window.partitionBy(cut).orderBy(*order)) - 1
    return sliced.withColumn("_here", here).join(F.broadcast(before), cut).withColumn(name, F.col("_before") + F.col("_here")).drop(cut, "_here", "_before")


def first_rows(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows of a total order, for an ``n`` too large for one task."""
    return placed(df, order, "_place").where(F.col("_place") < n).drop("_place", "_place_of")


def first_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of each group with their rank.

    Spark keeps at most ``n`` rows per group and task before the shuffle, so
    a group with a large share of all rows does not meet in one task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, place).where(F.col(rank) <= n)


def _slices(sizes: dict[int, int]) -> list[int]:
    """First ids of slices of at most ``MARKED_ROWS`` rows, for ids that count up from ``number << 33`` in each written part."""
    cuts, room = [], 0
    for number, size in sorted(sizes.items()):
        for begin in range(0, size, MARKED_ROWS):
            taken = min(MARKED_ROWS, size - begin)
            if taken > room:
                cuts.append((number << 33) + begin)
                room = MARKED_ROWS
            room -= taken
    return cuts


def first_stored_row_per_key(df: DataFrame, key: str, position: str, row: str) -> DataFrame:
    """First row of each key by position, for wide rows that are stored with ``row``, their ``monotonically_increasing_id``.

    Only key, position and id are shuffled.  The first rows come back as one
    bit per row, 64 in a long, which is broadcast in slices of at most
    ``MARKED_ROWS`` rows to the stored rows; a slice reads its own ids.
    """
    first = first_per_group(df.select(key, position, row), [key], [F.col(position).asc()], 1, "_place")
    bit = F.expr(f"shiftleft(1L, CAST(`{row}` & 63 AS INT))")
    marks = written(first.groupBy(F.shiftright(row, 6).alias("_word")).agg(F.bit_or(bit).alias("_marks")), "first-rows")
    parts = df.groupBy(F.shiftright(row, 33).alias("number")).agg((F.max(row).bitwiseAND((1 << 33) - 1) + 1).alias("size"))
    cuts = _slices({r["number"]: r["size"] for r in parts.collect()})
    slices = []
    for begin, end in zip(cuts, [*cuts[1:], None]):
        here, words = F.col(row) >= begin, F.col("_word") >= begin >> 6
        if end is not None:
            here, words = here & (F.col(row) < end), words & (F.col("_word") <= end >> 6)
        marked = df.where(here).join(F.broadcast(marks.where(words)), F.shiftright(row, 6) == F.col("_word"))
        slices.append(marked.where(F.getbit("_marks", F.col(row).bitwiseAND(63)) == 1).select(*df.columns))
    return reduce(DataFrame.unionAll, slices) if slices else df


def top_values_per_group(df: DataFrame, keys: list[str], value: str, n: int = 3) -> DataFrame:
    """Most frequent present values per group, ties by value."""
    counted = (
        present_keys(df, [*keys, value]).groupBy(*keys, value).agg(F.count("*").alias("frequency"))
    )
    return first_per_group(counted, keys, [F.desc("frequency"), F.asc(value)], n)


def known_sources(df: DataFrame, column: str = "Source", sources: list[str] = schemas.SOURCES):
    """Split into rows of known sources and the rest (with a reason)."""
    known = F.coalesce(F.col(column).isin(sources), F.lit(False))
    reason = F.concat(F.lit("Unknown source type: "), F.coalesce(F.col(column), F.lit("")))
    return df.where(known), df.where(~known).withColumn("reject_reason", reason)
