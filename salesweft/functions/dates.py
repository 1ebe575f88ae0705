"""Date parsing, calendar parts and seasons."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Season names of the two vocabularies, in the order
# spring, summer, autumn, winter.
SEASONS_ZH = ("春季", "夏季", "秋季", "冬季")
SEASONS_EN = ("Spring", "Summer", "Autumn", "Winter")

# Fixed value: date text of the yearly sales files.
SALES_DATE_FORMAT = "yyyy年M月d日"


def sales_file_date(text: Column) -> Column:
    """Date of a sales file; unreadable text gives null."""
    return F.try_to_timestamp(text, F.lit(SALES_DATE_FORMAT)).cast("date")


def iso_date(text: Column) -> Column:
    """``YYYY-MM-DD`` text to date; unreadable text gives null."""
    return text.try_cast("date")


def season_of_month(month: Column, names: tuple[str, str, str, str] = SEASONS_ZH) -> Column:
    """Season name; everything outside 3..11, null included, is winter."""
    spring, summer, autumn, winter = names
    return (
        F.when(month.between(3, 5), spring)
        .when(month.between(6, 8), summer)
        .when(month.between(9, 11), autumn)
        .otherwise(winter)
    )


def month_bucket(day: Column) -> Column:
    """``YYYY-MM``."""
    return F.date_format(day, "yyyy-MM")


def day_text(day: Column) -> Column:
    """``YYYY-MM-DD``."""
    return day.cast("date").cast("string")


def weekday_index(day: Column) -> Column:
    """0 = Monday … 6 = Sunday."""
    return F.weekday(day)


def weekday_name(day: Column) -> Column:
    """Short English day name."""
    return F.date_format(day, "E")


def whole_months(first: Column, last: Column) -> Column:
    """Calendar months from ``first`` to ``last``."""
    return (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)
