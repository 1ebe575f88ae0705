"""Data quality checks and cleaning of order records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesweft.functions import dates, numbers
from salesweft.operators import quantiles, selection
from salesweft.session import compilable, written
from salesweft.sources import schemas

Bounds = dict[str, tuple[float, float]]


def _count_rows(df: DataFrame, counts: dict[str, Column], label: str, value: str, keep_zero: bool) -> DataFrame:
    """One pass over ``df`` for all counts, then one row per count."""
    if not counts:
        return df.sparkSession.createDataFrame([], f"{label} string, {value} long")
    wide = df.agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    long = wide.unpivot([], list(counts), label, value)
    return long if keep_zero else long.where(F.col(value) > 0)


def missing_counts(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """``(field, missing)`` for every column with missing values."""
    fields = fields or df.columns
    return _count_rows(df, {f: F.col(f).isNull() for f in fields}, "field", "missing", False)


def _outside(field: str, bounds: tuple[float, float]) -> Column:
    low, high = bounds
    return F.coalesce((F.col(field) < low) | (F.col(field) > high), F.lit(False))


def outlier_counts(df: DataFrame, bounds: Bounds = schemas.QUALITY_BOUNDS) -> DataFrame:
    """``(field, outliers)`` for every bounded field with values out of bounds."""
    checks = {f: _outside(f, b) for f, b in bounds.items() if f in df.columns}
    return _count_rows(df, checks, "field", "outliers", False)


def enum_violations(df: DataFrame, enums: dict[str, list[str]] = schemas.ENUMS) -> DataFrame:
    """``(field, invalid)``: present values outside the allowed list."""
    checks = {
        f: F.col(f).isNotNull() & ~F.col(f).isin(list(allowed))
        for f, allowed in enums.items()
        if f in df.columns
    }
    return _count_rows(df, checks, "field", "invalid", True)


def enum_violation_total(df: DataFrame, enums: dict[str, list[str]] = schemas.ENUMS) -> DataFrame:
    """Sum of :func:`enum_violations` over all fields."""
    return enum_violations(df, enums).agg(F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid"))


def schema_violations(df: DataFrame, schema=schemas.ORDER) -> DataFrame:
    """``(check, violations)`` of every constraint a declared schema carries."""
    return _count_rows(df, schemas.constraint_checks(schema, df.columns), "check", "violations", True)


def require_fields(df: DataFrame, fields: list[str] = schemas.REQUIRED_FIELDS) -> DataFrame:
    """Drop rows that miss a required field."""
    return df.dropna(subset=[f for f in fields if f in df.columns])


def null_outliers(df: DataFrame, bounds: Bounds = schemas.QUALITY_BOUNDS) -> DataFrame:
    """Values out of bounds become null."""
    return df.withColumns({
        f: F.when(F.col(f).between(*b), F.col(f)) for f, b in bounds.items() if f in df.columns
    })


def fill_medians(df: DataFrame, fields: list[str], stored: bool = False) -> DataFrame:
    """Null numbers become the column median (exact, interpolated); ``stored`` frames are read again, not copied."""
    fields = [f for f in fields if f in df.columns]
    if not fields:
        return df
    known = quantiles.with_quantiles(df, df, fields, {"p50": 0.5}, stored=stored)
    filled = {f: F.coalesce(F.col(f).cast("double"), F.col("_q").getField(f"{f}_p50")) for f in fields}
    return known.withColumns(filled).drop("_q")


def fill_unknown(df: DataFrame, fields=tuple(schemas.ENUMS)) -> DataFrame:
    """Missing enum values become ``Unknown``; invalid ones stay."""
    return df.fillna("Unknown", subset=[f for f in fields if f in df.columns])


def normalise_types(df: DataFrame) -> DataFrame:
    """Date and number fields get their type; unreadable values are null."""
    casts: dict[str, Column] = {}
    for f in schemas.DATE_FIELDS:
        if f in df.columns:
            casts[f] = dates.iso_date(F.col(f))
    for f in schemas.NUMERIC_FIELDS:
        if f in df.columns:
            casts[f] = numbers.number_or_null(F.col(f))
    return df.withColumns(casts) if casts else df


def keep_first(df: DataFrame, key: str = "Order_ID", position: str = "input_position") -> DataFrame:
    """First record per key in input order.

    ``dropDuplicates`` has no order.  The rank filter is applied per task
    before the shuffle too, so a key repeated very often shuffles one row
    per task.
    """
    return selection.first_per_group(df, [key], [F.col(position).asc()], 1, "_place").drop("_place")


def clean_orders(
    df: DataFrame,
    bounds: Bounds = schemas.QUALITY_BOUNDS,
    position: str = "input_position",
    stamp: bool = True,
) -> DataFrame:
    """Required fields, out-of-bound values to null, medians, enum fill, types, first record per order, cleaning time.

    The usable rows are written once: the medians, the choice of first records
    and the cleaning all read that table, and what the rows come from is
    computed once.  No later step shuffles or sorts whole rows.
    """
    compilable(df.sparkSession)
    numeric = list(bounds)
    typed = df.withColumns({f: numbers.number_or_null(F.col(f)) for f in numeric if f in df.columns})
    kept = null_outliers(require_fields(typed), bounds)
    stored = written(kept.withColumn("_row", F.monotonically_increasing_id()), "cleaning")
    filled = normalise_types(fill_unknown(fill_medians(stored, numeric, stored=True)))
    cleaned = selection.first_stored_row_per_key(filled, "Order_ID", position, "_row").drop(position, "_row")
    return cleaned.withColumn("cleaned_at", F.current_timestamp()) if stamp else cleaned


def quality_report(df: DataFrame, bounds: Bounds = schemas.QUALITY_BOUNDS, key: str = "Order_ID") -> DataFrame:
    """``(metric, field, value)``: totals, missing values and outliers.

    Totals, missing counts and outlier counts come from one pass; the
    distinct order count needs one pass more (grouped by order, then summed).
    """
    numeric = [f for f in bounds if f in df.columns]
    fields = [c for c in df.columns if c != "input_position"]
    typed = df.select(*fields).withColumns({f: numbers.number_or_null(F.col(f)) for f in numeric})
    kept = F.lit(True)
    for f in schemas.REQUIRED_FIELDS:
        if f in fields:
            kept = kept & F.col(f).isNotNull()
    totals = [F.count("*").alias("total_records||"), F.count_if(kept).alias("_kept")]
    missing = [F.count_if(F.col(f).isNull()).alias(f"missing_values||{f}") for f in fields]
    outliers = [F.count_if(kept & _outside(f, bounds[f])).alias(f"outliers||{f}") for f in numeric]
    orders = typed.where(kept).groupBy(key).agg(F.lit(1).alias("one")).agg(F.count("*").alias("n"))
    wide = (
        typed.agg(*totals, *missing, *outliers)
        .withColumn("valid_records||", orders.scalar())
        .withColumn("dropped_records||", F.col("total_records||") - F.col("_kept"))
        .withColumn("duplicates||", F.col("_kept") - F.col("valid_records||"))
        .drop("_kept")
    )
    long = wide.unpivot([], wide.columns, "name", "value")
    parts = F.split("name", r"\|\|")
    return long.select(
        parts[0].alias("metric"), parts[1].alias("field"), "value"
    ).where((F.col("field") == "") | (F.col("value") > 0))
