"""Numeric column helpers: exact money, guarded ratios, rounding, coercion."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_UNITS = 10_000  # money is exact to four places
_SPLIT = 1_000_000
_WIDE = 1e14


def money_total(value: Column) -> Column:
    """Aggregate: exact sum to four places, as ``decimal(38,4)``.

    Each amount becomes a whole number of 1/10000 and is summed in two long
    parts, so no row builds a decimal, the order of rows does not matter and
    the sum cannot overflow at any realistic table size.  Amounts of 1e14 and
    more, which no long part can hold, are summed as decimals of their own; a
    double has no places below one there.  Missing amounts are skipped, and so
    are non-finite ones and those of 1e26 and more: ingest rejects records with
    such numbers, with the reason, before anything is summed.
    """
    amount = value.cast("double")
    plain = is_finite(amount) & (F.abs(amount) < F.lit(_WIDE))
    units = F.when(plain, F.rint(amount * float(_UNITS))).cast("long")
    high = (units / float(_SPLIT)).cast("long")
    low = units - high * F.lit(_SPLIT)
    wide = F.when(~plain & (F.abs(amount) < F.lit(1e26)), amount).cast("decimal(27,0)")
    whole = F.sum(high).cast("decimal(20,0)") * F.lit(_SPLIT).cast("decimal(7,0)") + F.sum(low).cast("decimal(20,0)")
    small = (whole.cast("decimal(32,0)") * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(38,4)")
    large = F.sum(wide).cast("decimal(38,4)")
    return F.when(large.isNull(), small).otherwise(F.coalesce(small, F.lit(0).cast("decimal(38,4)")) + large).cast("decimal(38,4)")


def money_sum(value: Column) -> Column:
    """:func:`money_total` as a double."""
    return money_total(value).cast("double")


def half_even(value: Column, digits: int) -> Column:
    """Round half to even on the scaled double.

    Stays a plain IEEE computation (no decimal detour), as numeric array
    libraries round, so any engine repeats it bit for bit.
    """
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def per_at_least_one(value: Column, count: Column) -> Column:
    """``value / max(count, 1)``."""
    return value.cast("double") / F.greatest(count.cast("double"), F.lit(1.0))


def per_count_or_zero(value: Column, count: Column) -> Column:
    """``value / count`` where ``count > 0``, else 0."""
    return F.when(count > 0, value.cast("double") / count.cast("double")).otherwise(F.lit(0.0))


def number_or_zero(text: Column) -> Column:
    """Number, with unreadable, missing and not-a-number values as 0."""
    number = text.try_cast("double")
    return F.when(number.isNull() | F.isnan(number), F.lit(0.0)).otherwise(number)


def number_or_null(text: Column) -> Column:
    """Number, with unreadable values as null."""
    return text.try_cast("double")


def is_finite(value: Column) -> Column:
    """True for a present value that is neither NaN nor infinite."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
