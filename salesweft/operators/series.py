"""Daily series: build, cut, standardise, difference, decompose.

A series is a long frame ``(keys..., ds date, y double)``.  It is summed per
key and day first, so every later window holds at most one row per day,
whatever the share of a key in the raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesweft.functions import dates, numbers
from salesweft.operators import selection

WEEK = 7


def by_key(keys: list[str]):
    """Whole series."""
    return Window.partitionBy(*keys)


def by_day(keys: list[str]):
    """Series in date order."""
    return Window.partitionBy(*keys).orderBy("ds")


def running(keys: list[str]):
    """Series up to the current day."""
    return by_day(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def daily_series(df: DataFrame, keys: list[str], day: str = "order_date", value: str = "sales_amount") -> DataFrame:
    """Sum per key and observed day; absent days stay absent."""
    present = selection.present_keys(df, [*keys, day])
    return present.groupBy(*keys, F.col(day).alias("ds")).agg(numbers.money_sum(F.col(value)).alias("y"))


def finite_points(series: DataFrame) -> DataFrame:
    """Drop missing, NaN and infinite values."""
    return series.where(numbers.is_finite(F.col("y")))


def last_points(series: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Last ``n`` observed days of each series."""
    return selection.first_per_group(series, keys, [F.desc("ds")], n, "_back").drop("_back")


def fit_window(series: DataFrame, keys: list[str], n: int = 180) -> DataFrame:
    """Last ``n`` points, finite ones only, with the number of points left."""
    recent = finite_points(last_points(series, keys, n))
    return recent.withColumn("points", F.count("*").over(by_key(keys)))


def long_enough(windowed: DataFrame, minimum: int = 30) -> DataFrame:
    """Series with enough points to model."""
    return windowed.where(F.col("points") >= minimum)


def skipped_series(windowed: DataFrame, keys: list[str], minimum: int = 30) -> DataFrame:
    """Series with too few points, with the reason."""
    short = windowed.where(F.col("points") < minimum).groupBy(*keys).agg(F.first("points").alias("points"))
    return short.withColumn("reason", F.lit(f"fewer than {minimum} points"))


def standardise(series: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``mean``, ``sd`` (sample, 0 becomes 1) and ``z``."""
    deviation = F.coalesce(F.stddev_samp("y").over(by_key(keys)), F.lit(0.0))
    return (
        series.withColumn("mean", F.avg("y").over(by_key(keys)))
        .withColumn("sd", F.when(deviation == 0, F.lit(1.0)).otherwise(deviation))
        .withColumn("z", (F.col("y") - F.col("mean")) / F.col("sd"))
    )


def difference(series: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """First difference; null on the first point."""
    return series.withColumn(name, F.col(column) - F.lag(column).over(by_day(keys)))


def with_differences(standardised: DataFrame, keys: list[str]) -> DataFrame:
    """Add the first and second difference of ``z``."""
    return difference(difference(standardised, keys, "z", "dz"), keys, "dz", "ddz")


def stationary(level: str, change: str) -> Column:
    """Aggregate: mean change near 0 and changes calmer than levels.

    Needs at least ten levels.  ``change`` is null where it has no
    predecessor, so the aggregates run over the changes only.
    """
    spread = F.stddev_samp(level)
    calm = (F.abs(F.avg(change)) < spread * 0.05) & (F.stddev_samp(change) < spread * 0.7)
    return F.coalesce((F.count(level) >= 10) & calm, F.lit(False))


def stationarity(differenced: DataFrame, keys: list[str]) -> DataFrame:
    """Per series: both tests and the differencing order 0, 1 or 2."""
    tests = differenced.groupBy(*keys).agg(
        F.count("*").alias("points"),
        stationary("z", "dz").alias("level_stationary"),
        stationary("dz", "ddz").alias("change_stationary"),
    )
    order = F.when(F.col("level_stationary"), 0).when(F.col("change_stationary"), 1).otherwise(2)
    return tests.withColumn("d", order)


def weekday_effects(series: DataFrame, keys: list[str], window: int = 56, minimum: int = 14) -> DataFrame:
    """Mean per weekday minus overall mean over the last days."""
    recent = last_points(series, keys, window).withColumn("weekday", dates.weekday_index(F.col("ds")))
    sums = recent.groupBy(*keys, "weekday").agg(F.sum("y").alias("total"), F.count("*").alias("n"))
    whole = by_key(keys)
    return (
        sums.withColumn("points", F.sum("n").over(whole))
        .withColumn("overall", F.sum("total").over(whole) / F.sum("n").over(whole))
        .where(F.col("points") >= minimum)
        .select(*keys, "weekday", (F.col("total") / F.col("n") - F.col("overall")).alias("effect"))
    )


def indexed(series: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``idx``, the zero-based place in the series."""
    return series.withColumn("idx", F.row_number().over(by_day(keys)) - 1)


def linear_trend(series: DataFrame, keys: list[str]) -> DataFrame:
    """Least-squares line over the place in the series."""
    return indexed(series, keys).groupBy(*keys).agg(
        F.count("*").alias("points"),
        F.coalesce(F.regr_slope("y", "idx"), F.lit(0.0)).alias("slope"),
        F.coalesce(F.regr_intercept("y", "idx"), F.avg("y")).alias("intercept"),
    )


def detrended(series: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``idx``, the line and the residual ``r`` around it."""
    whole = by_key(keys)
    slope = F.coalesce(F.regr_slope("y", "idx").over(whole), F.lit(0.0))
    intercept = F.coalesce(F.regr_intercept("y", "idx").over(whole), F.avg("y").over(whole))
    return (
        indexed(series, keys)
        .withColumn("slope", slope).withColumn("intercept", intercept)
        .withColumn("trend", F.col("slope") * F.col("idx") + F.col("intercept"))
        .withColumn("r", F.col("y") - F.col("trend"))
    )


def phase_means(frame: DataFrame, keys: list[str], column: str, centred: bool, period: int = WEEK) -> DataFrame:
    """Mean of ``column`` per place in the period; optionally around 0."""
    means = frame.groupBy(*keys, (F.col("idx") % period).alias("phase")).agg(F.avg(column).alias("season"))
    if centred:
        means = means.withColumn("season", F.col("season") - F.avg("season").over(by_key(keys)))
    return means


def weekly_season(series: DataFrame, keys: list[str]) -> DataFrame:
    """Centred mean of the raw values per place modulo seven."""
    return phase_means(indexed(series, keys), keys, "y", centred=True)


def residual_season(series: DataFrame, keys: list[str]) -> DataFrame:
    """Mean of the detrended values per place modulo seven, not centred."""
    return phase_means(detrended(series, keys), keys, "r", centred=False)


def autocorrelation(residuals: DataFrame, keys: list[str], lags: int) -> DataFrame:
    """``(keys, lag, acf)`` for lag 0..``lags`` of column ``r``, biased form."""
    centred = residuals.withColumn("e", F.col("r") - F.avg("r").over(by_key(keys)))
    shifted = {f"_e{k}": (F.lag("e", k).over(by_day(keys)) if k else F.col("e")) for k in range(lags + 1)}
    products = centred.withColumns(shifted).groupBy(*keys).agg(
        F.sum(F.col("e") * F.col("e")).alias("_scale"),
        *[F.coalesce(F.sum(F.col("e") * F.col(f"_e{k}")), F.lit(0.0)).alias(f"_p{k}") for k in range(lags + 1)],
    )
    entries = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_p{k}").alias("p")) for k in range(lags + 1)])
    value = F.when(F.col("_scale") > 0, F.col("e.p") / F.col("_scale")).otherwise(F.lit(0.0))
    return products.select(*keys, "_scale", F.explode(entries).alias("e")).select(
        *keys, F.col("e.lag").alias("lag"), value.alias("acf")
    )


def trailing_change_mean(series: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Trailing mean of the day-to-day change; the mean change until full."""
    changed = difference(series, keys, "y", "dy").where(F.col("dy").isNotNull())
    frame = by_day(keys).rowsBetween(-(width - 1), 0)
    full = F.count("*").over(frame) == width
    return changed.withColumn(
        "ma", F.when(full, F.avg("dy").over(frame)).otherwise(F.avg("dy").over(by_key(keys)))
    )


def centred_mean(frame: DataFrame, keys: list[str], column: str, width: int, name: str) -> DataFrame:
    """Centred window mean, outside points counting as 0."""
    ahead = (width - 1) // 2
    window = by_day(keys).rowsBetween(ahead - (width - 1), ahead)
    return frame.withColumn(name, F.sum(column).over(window) / F.lit(float(width)))


def decompose(series: DataFrame, keys: list[str], period: int = WEEK) -> DataFrame:
    """Additive decomposition: centred mean, phase means, rest.

    Trend and residual are null where the window is not full.
    """
    if period % 2 == 0:
        raise ValueError("the centred window needs an odd period")
    half = period // 2
    frame = by_day(keys).rowsBetween(-half, half)
    trended = indexed(series, keys).withColumn(
        "trend", F.when(F.count("*").over(frame) == period, F.avg("y").over(frame))
    ).withColumn("_detrended", F.col("y") - F.col("trend")).withColumn("phase", F.col("idx") % period)
    seasons = phase_means(trended, keys, "_detrended", centred=True, period=period)
    return trended.join(seasons, [*keys, "phase"]).select(
        *keys, "ds", "y", "trend", F.col("season").alias("seasonal"),
        (F.col("y") - F.col("trend") - F.col("season")).alias("residual"),
    )
