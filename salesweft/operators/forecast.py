"""Autoregressive daily forecasts, all series in one job.

Every series is at most its fit window long (180 days by default), so the
per-series steps are windows and aggregates over small groups that share one
partitioning by the series keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesweft.functions import dates, holidays
from salesweft.operators import series as S
from salesweft.session import written

FIT_DAYS = 180
MIN_POINTS = 30
NORMAL_95 = 1.96
# Shares of both parts in the forecast of trend and season.
AR_WEIGHT, MA_WEIGHT = 0.5, 0.09
# Key of the one series when a forecast is asked for without keys.
WHOLE = "_whole"


def check_order(order: tuple[int, int, int]) -> tuple[int, int, int]:
    """Explicit orders: p from 1, d 0 to 2; q only adds to the penalty."""
    p, d, q = order
    if p < 1 or d not in (0, 1, 2) or q < 0:
        raise ValueError(f"unsupported order {order}: p is at least 1, d is 0 to 2")
    return order


def prepare(daily: DataFrame, keys: list[str], fit_days: int = FIT_DAYS, minimum: int = MIN_POINTS) -> DataFrame:
    """Fit window, standardised, with both differences and the order d."""
    windowed = S.long_enough(S.fit_window(daily, keys, fit_days), minimum)
    return S.with_differences(S.standardise(windowed, keys), keys)


def with_model_input(differenced: DataFrame, keys: list[str], d: int | None = None) -> DataFrame:
    """Add ``d``, the series ``x`` differenced d times, and its two lags."""
    if d is None:
        chosen = differenced.join(S.stationarity(differenced, keys).select(*keys, "d"), keys)
    else:
        chosen = differenced.withColumn("d", F.lit(d))
    x = F.when(F.col("d") == 0, F.col("z")).when(F.col("d") == 1, F.col("dz")).otherwise(F.col("ddz"))
    lag = lambda n: F.lag("x", n).over(S.by_day(keys))
    return chosen.withColumn("x", x).withColumn("l1", lag(1)).withColumn("l2", lag(2))


def _phi_one() -> Column:
    """Least squares on one lag; 0 when the lag is all zero."""
    return F.when(F.col("s11") > 0, F.col("b1") / F.col("s11")).otherwise(F.lit(0.0))


def _phi_two(first: bool) -> Column:
    """Least squares on two lags; least-norm solution when they are collinear."""
    a11, a12, a22 = F.col("a11"), F.col("a12"), F.col("a22")
    c1, c2 = F.col("c1"), F.col("c2")
    det, trace = a11 * a22 - a12 * a12, a11 + a22
    regular = (c1 * a22 - c2 * a12) / det if first else (c2 * a11 - c1 * a12) / det
    collinear = (a11 * c1 + a12 * c2 if first else a12 * c1 + a22 * c2) / (trace * trace)
    return (
        F.when(trace <= 0, F.lit(0.0))
        .when(det > trace * trace * 1e-15, regular)
        .otherwise(collinear)
    )


def coefficients(model_input: DataFrame, keys: list[str]) -> DataFrame:
    """AR(1) and AR(2) coefficients per series, no intercept."""
    x, l1, l2 = F.col("x"), F.col("l1"), F.col("l2")
    both = lambda expr: F.coalesce(F.sum(F.when(l2.isNotNull(), expr)), F.lit(0.0))
    one = lambda expr: F.coalesce(F.sum(F.when(l1.isNotNull(), expr)), F.lit(0.0))
    sums = model_input.groupBy(*keys).agg(
        F.first("d").alias("d"), F.count("x").alias("n"),
        one(l1 * l1).alias("s11"), one(x * l1).alias("b1"),
        both(l1 * l1).alias("a11"), both(l1 * l2).alias("a12"), both(l2 * l2).alias("a22"),
        both(x * l1).alias("c1"), both(x * l2).alias("c2"),
    )
    return sums.select(
        *keys, "d", "n", _phi_one().alias("ar1_phi1"),
        _phi_two(True).alias("ar2_phi1"), _phi_two(False).alias("ar2_phi2"),
    )


def criterion(rss: Column, n: Column, k: int, penalty: Column) -> Column:
    """``n ln(rss/n + 1e-10) + penalty``; 0 when there is nothing to judge."""
    return F.when((rss > 0) & (n > k), n * F.ln(rss / n + 1e-10) + penalty).otherwise(F.lit(0.0))


def fit(model_input: DataFrame, keys: list[str], q: int = 0) -> DataFrame:
    """Both candidate fits per series: coefficients, RSS, variance, AIC, BIC.

    Residuals are formed from the data, not from the sums, so a close fit
    keeps its precision.
    """
    phis = coefficients(model_input, keys)
    rows = model_input.select(*keys, "x", "l1", "l2").join(phis, keys)
    r1 = F.col("x") - F.col("ar1_phi1") * F.col("l1")
    r2 = F.col("x") - F.col("ar2_phi1") * F.col("l1") - F.col("ar2_phi2") * F.col("l2")
    judged = rows.withColumn("r1", r1).withColumn("r2", r2).groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in ("d", "n", "ar1_phi1", "ar2_phi1", "ar2_phi2")],
        *[
            e
            for p in (1, 2)
            for e in (
                F.coalesce(F.sum(F.col(f"r{p}") * F.col(f"r{p}")), F.lit(1.0)).alias(f"ar{p}_rss"),
                F.coalesce(F.var_pop(f"r{p}"), F.lit(1.0)).alias(f"ar{p}_sigma2"),
            )
        ],
    )
    for p in (1, 2):
        k, n, rss = p + q + 1, F.col("n"), F.col(f"ar{p}_rss")
        judged = judged.withColumn(f"ar{p}_aic", criterion(rss, n, k, F.lit(2.0 * k)))
        judged = judged.withColumn(f"ar{p}_bic", criterion(rss, n, k, k * F.ln(n)))
    return judged


def select_order(fitted: DataFrame, keys: list[str], p: int | None = None, q: int = 0) -> DataFrame:
    """One model per series.

    Moving-average terms are never estimated and only add to the penalty, so
    the smallest criterion is always at q = 0 and the choice is p = 1 or 2.
    An AIC of 0 means the candidate could not be judged.
    """
    if p is None:
        usable = lambda i: F.col(f"ar{i}_aic") != 0
        better = usable(2) & (~usable(1) | (F.col("ar2_aic") < F.col("ar1_aic")))
        chosen = F.when(better, 2).otherwise(1)
    else:
        chosen = F.lit(p)
    two = F.col("p") == 2
    pick = lambda name: F.when(two, F.col(f"ar2_{name}")).otherwise(F.col(f"ar1_{name}"))
    return fitted.withColumn("p", chosen).select(
        *keys, "p", "d", F.lit(q).alias("q"), "n",
        pick("phi1").alias("phi1"), F.when(two, F.col("ar2_phi2")).otherwise(F.lit(0.0)).alias("phi2"),
        pick("rss").alias("rss"), pick("sigma2").alias("sigma2"),
        pick("aic").alias("aic"), pick("bic").alias("bic"),
    ).where(F.col("n") > F.col("p") + q + 5)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _scaled(a: Column | str, factor: Column) -> Column:
    return F.transform(a, lambda x: factor * x)


def _less(a: Column | str, factor: Column, b: Column | str) -> Column:
    """The array a - factor * b."""
    return F.zip_with(a, b, lambda x, y: x - factor * y)


def least_norm(matrix: Column, target: Column, size: int) -> Column:
    """The solution of least norm of symmetric normal equations, as an array.

    Conjugate gradients from 0 stay in the span of the equations, so collinear
    lags give the solution of least norm without a rank decision; what is left
    of the target at 1e-13 of its length counts as solved.
    """
    zeros = F.array(*[F.lit(0.0)] * size)
    start = _dot(target, target)
    state = F.struct(zeros.alias("phi"), target.alias("r"), target.alias("d"), start.alias("rr"))

    def step(s: Column, _: Column) -> Column:
        image = F.transform(matrix, lambda row: _dot(row, s["d"]))
        held = F.struct(s["phi"].alias("phi"), s["r"].alias("r"), s["d"].alias("d"), s["rr"].alias("rr"), image.alias("g"), _dot(image, s["d"]).alias("dg"))
        return F.transform(F.array(held), moved)[0]

    def moved(s: Column) -> Column:
        length = s["rr"] / s["dg"]
        phi = F.zip_with(s["phi"], s["d"], lambda a, b: a + length * b)
        rest = F.zip_with(s["r"], s["g"], lambda a, b: a - length * b)
        there = F.transform(F.array(F.struct(rest.alias("r"), _dot(rest, rest).alias("rr"))), lambda n: F.struct(
            phi.alias("phi"), n["r"].alias("r"), F.zip_with(n["r"], s["d"], lambda a, b: a + n["rr"] / s["rr"] * b).alias("d"), n["rr"].alias("rr")
        ))[0]
        stay = F.struct(s["phi"].alias("phi"), s["r"].alias("r"), s["d"].alias("d"), s["rr"].alias("rr"))
        return F.when((s["rr"] > start * 1e-26) & (s["dg"] > 0), there).otherwise(stay)

    return F.aggregate(F.sequence(F.lit(1), F.lit(3 * size)), state, step, lambda s: s["phi"])


def _least_squares(df: DataFrame, p: int) -> DataFrame:
    """Add ``phis`` and the residuals ``rest``; ``y`` and ``l1`` to ``lp`` are arrays of one length.

    Lag by lag, the rest of the other lags and of the series is made
    orthogonal to it (modified Gram-Schmidt, as stable as the reflections of
    numeric libraries), and back substitution gives the coefficients.  A lag of
    which nothing is left is a combination of the earlier ones; then the
    normal equations give the solution of least norm.
    """
    lags = [f"l{i}" for i in range(1, p + 1)]
    plain = df.select("*", *[F.col(c).alias(f"v_{c}") for c in (*lags, "y")], *[F.sqrt(_dot(F.col(c), F.col(c))).alias(f"size_{c}") for c in lags])
    for i, lag in enumerate(lags):
        left = F.sqrt(_dot(F.col(f"v_{lag}"), F.col(f"v_{lag}")))
        plain = plain.withColumn(f"r_{lag}", F.when(left > F.col(f"size_{lag}") * 1e-13, left).otherwise(F.lit(0.0)))
        plain = plain.withColumn("q", _scaled(f"v_{lag}", F.when(F.col(f"r_{lag}") > 0, 1 / F.col(f"r_{lag}")).otherwise(F.lit(0.0))))
        others = [*lags[i + 1 :], "y"]
        plain = plain.withColumns({f"r_{lag}_{o}": _dot(F.col("q"), F.col(f"v_{o}")) for o in others})
        plain = plain.withColumns({f"v_{o}": _less(f"v_{o}", F.col(f"r_{lag}_{o}"), "q") for o in others})
    for i in reversed(range(p)):
        above = sum((F.col(f"r_{lags[i]}_{o}") * F.col(f"phi_{o}") for o in lags[i + 1 :]), F.lit(0.0))
        plain = plain.withColumn(f"phi_{lags[i]}", (F.col(f"r_{lags[i]}_y") - above) / F.nullif(F.col(f"r_{lags[i]}"), F.lit(0.0)))
    matrix = F.array(*[F.array(*[_dot(F.col(a), F.col(b)) for b in lags]) for a in lags])
    target = F.array(*[_dot(F.col(a), F.col("y")) for a in lags])
    full = reduce(lambda a, b: a & b, [F.col(f"r_{c}") > 0 for c in lags])
    phis = F.when(full, F.array(*[F.col(f"phi_{c}") for c in lags])).otherwise(least_norm(matrix, target, p))
    rest = F.col("y")
    for i, c in enumerate(lags):
        rest = _less(rest, F.get("phis", F.lit(i)), c)
    return plain.withColumn("phis", phis).withColumn("rest", rest).select(*df.columns, "phis", "rest")


def fit_long(rows: DataFrame, keys: list[str], p: int, q: int = 0) -> DataFrame:
    """Models of any order p: least squares on p lags, no intercept, least norm when collinear.

    A series is one fit window at most, so it is one array, and all that
    follows are array expressions on it.
    """
    line = F.transform(F.sort_array(F.collect_list(F.when(F.col("x").isNotNull(), F.struct("ds", "x")))), lambda r: r["x"])
    series = rows.groupBy(*keys).agg(F.first("d").alias("d"), line.alias("line")).withColumn("n", F.size("line").cast("long")).where(F.col("n") > p + q + 5)
    part = lambda start: F.slice("line", F.lit(start), F.size("line") - p)
    solved = _least_squares(series.select(*keys, "d", "n", part(p + 1).alias("y"), *[part(p - i + 1).alias(f"l{i}") for i in range(1, p + 1)]), p)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    judged = solved.withColumn("rss", _dot(F.col("rest"), F.col("rest"))).withColumn("mean", total("rest") / F.size("rest"))
    spread = total(F.transform("rest", lambda v: (v - F.col("mean")) * (v - F.col("mean")))) / F.size("rest")
    k, n, rss = p + q + 1, F.col("n"), F.col("rss")
    return judged.select(
        *keys, F.lit(p).alias("p"), "d", F.lit(q).alias("q"), "n",
        F.get("phis", F.lit(0)).alias("phi1"), F.coalesce(F.get("phis", F.lit(1)), F.lit(0.0)).alias("phi2"),
        "rss", spread.alias("sigma2"), criterion(rss, n, k, F.lit(2.0 * k)).alias("aic"), criterion(rss, n, k, k * F.ln(n)).alias("bic"), "phis",
    )


def fit_models(daily: DataFrame, keys: list[str], order: tuple[int, int, int] | None = None, **window):
    """``(model input rows, one model per series)``."""
    p, d, q = check_order(order) if order else (None, None, 0)
    # At most one fit window per series; read by every later step.
    rows = written(with_model_input(prepare(daily, keys, **window), keys, d), "fit-window")
    if p is not None and p > 2:
        return rows, written(fit_long(rows, keys, p, q), "long-models")
    return rows, select_order(fit(rows, keys, q), keys, p, q)


def unmodelled_series(rows: DataFrame, models: DataFrame, keys: list[str]) -> DataFrame:
    """Series of the fit window that are too short for their model's order, with the reason."""
    points = rows.groupBy(*keys).agg(F.first("points").alias("points"))
    return points.join(models.select(*keys), keys, "left_anti").withColumn("reason", F.lit("too few changes for the model order"))


def fitted_values(rows: DataFrame, models: DataFrame, keys: list[str]) -> DataFrame:
    """One-step fitted values, differenced and in sales units.

    The first p points have no fit of their own and are left out.
    """
    long = "phis" in models.columns
    joined = rows.select(*keys, "ds", "y", "mean", "sd", "x", "l1", "l2").join(
        models.select(*keys, "p", "d", "phi1", "phi2", *["phis"] * long), keys
    )
    if long:
        # The p values before a point, newest first; no fit before there are p of them.
        before = F.collect_list("x").over(S.by_day(keys).rowsBetween(Window.unboundedPreceding, -1))
        products = F.zip_with("phis", F.slice(F.reverse("_before"), 1, F.col("p")), lambda a, b: a * b)
        joined = joined.withColumn("_before", before)
        step = F.when(F.size("_before") >= F.col("p"), F.aggregate(products, F.lit(0.0), lambda s, v: s + v))
    else:
        step = F.when(
            F.col("p") == 2, F.col("phi1") * F.col("l1") + F.col("phi2") * F.col("l2")
        ).otherwise(F.col("phi1") * F.col("l1"))
    back = lambda n: F.lag("y", n).over(S.by_day(keys))
    level = (
        F.when(F.col("d") == 0, F.col("mean") + F.col("sd") * F.col("fitted_x"))
        .when(F.col("d") == 1, F.col("_y1") + F.col("sd") * F.col("fitted_x"))
        .otherwise(2 * F.col("_y1") - F.col("_y2") + F.col("sd") * F.col("fitted_x"))
    )
    return (
        joined.withColumn("fitted_x", step).withColumn("_y1", back(1)).withColumn("_y2", back(2))
        .withColumn("fitted", level).where(F.col("fitted").isNotNull())
        .select(*keys, "ds", "y", "x", "fitted_x", "fitted")
    )


def fit_metrics(fitted: DataFrame, models: DataFrame, keys: list[str], floor: float = 0.05) -> DataFrame:
    """RMSE, MAE and symmetric MAPE per series, with the model's AIC and BIC.

    Days below ``floor`` times the mean are left out of the percentage.
    """
    error = F.col("y") - F.col("fitted")
    share = F.abs(error) / ((F.abs("y") + F.abs("fitted")) / 2)
    marked = fitted.withColumn("_mean", F.avg("y").over(S.by_key(keys)))
    counted = F.when((F.col("y") > F.col("_mean") * floor) & (F.abs("y") + F.abs("fitted") > 0), share)
    scored = marked.groupBy(*keys).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"),
        (F.coalesce(F.avg(counted), F.lit(0.0)) * 100).alias("smape"),
    )
    return scored.join(models.select(*keys, "aic", "bic"), keys)


def ar_path(phi1: Column, phi2: Column, last: Column, before_last: Column, steps: int) -> Column:
    """Array of ``steps`` values of the recursion, oldest first."""
    start = F.array(before_last.cast("double"), last.cast("double"))
    grow = lambda done, _: F.array_append(
        done, phi1 * F.element_at(done, -1) + phi2 * F.element_at(done, -2)
    )
    return F.slice(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, grow), 3, steps)


def long_path(phis: Column, newest: Column, p: Column, steps: int) -> Column:
    """:func:`ar_path` for any number of lags; ``newest`` holds the last p values, oldest first."""
    grow = lambda done, _: F.array_append(
        done,
        F.aggregate(
            F.zip_with(phis, F.slice(F.reverse(done), F.lit(1), p), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v
        ),
    )
    return F.slice(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), newest, grow), p + 1, F.lit(steps))


def last_values(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The last ``n`` model inputs of each series, oldest first (a fit window at most is gathered)."""
    ordered = F.sort_array(F.collect_list(F.struct("ds", "x")))
    known = rows.where(F.col("x").isNotNull()).groupBy(*keys).agg(F.transform(ordered, lambda r: r["x"]).alias("_all"))
    return known.select(*keys, F.slice("_all", -n, n).alias("newest"))


def last_state(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Last date, levels and scale of each series."""
    newest = lambda c: F.max_by(c, "ds").alias(f"last_{c}")
    return rows.groupBy(*keys).agg(
        F.max("ds").alias("last_ds"), newest("z"), newest("dz"), newest("x"), newest("l1"),
        F.first("mean").alias("mean"), F.first("sd").alias("sd"),
    )


def standardised_forecast(rows: DataFrame, models: DataFrame, keys: list[str], steps: int) -> DataFrame:
    """``(keys, step, x_hat, z_hat)``: recursion, then summed back d times."""
    state = models.join(last_state(rows, keys), keys)
    if "phis" in models.columns:
        p = models.agg(F.max("p")).first()[0] or 1  # one explicit order for all series
        state = state.join(last_values(rows, keys, p), keys)
        path = long_path(F.col("phis"), F.col("newest"), F.col("p"), steps)
    else:
        path = ar_path(F.col("phi1"), F.col("phi2"), F.col("last_x"), F.coalesce("last_l1", F.lit(0.0)), steps)
    walked = state.withColumn("_path", path).select("*", F.posexplode("_path").alias("i", "x_hat")).drop("_path")
    order = Window.partitionBy(*keys).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    once = F.sum("x_hat").over(order)
    summed = walked.withColumn("_once", once)
    # d = 1: level + sum.  d = 2: change + sum gives changes, summed again.
    changes = F.sum(F.col("last_dz") + F.col("_once")).over(order)
    z_hat = (
        F.when(F.col("d") == 0, F.col("x_hat"))
        .when(F.col("d") == 1, F.col("last_z") + F.col("_once"))
        .otherwise(F.col("last_z") + changes)
    )
    return summed.withColumn("z_hat", z_hat).withColumn("step", F.col("i") + 1).drop("_once")


def with_future_dates(frame: DataFrame) -> DataFrame:
    """Date of every step: the days after the last observed one."""
    return frame.withColumn("ds", F.date_add("last_ds", F.col("step")))


def with_holiday_factor(frame: DataFrame, table: DataFrame | None = None, jitter_seed: int | None = None) -> DataFrame:
    """Add ``factor``: the middle of the day's range, 1 on ordinary days.

    With a seed, the factor is drawn from the range and varied by 15 %.
    """
    if table is None:
        # The built-in days are a literal map: nothing is joined or shuffled.
        span = F.try_element_at(holidays.holiday_map(), F.month("ds") * 100 + F.dayofmonth("ds"))
        joined = frame.withColumns({"low": span["low"], "high": span["high"]})
    else:
        joined = frame.join(
            table, (F.month("ds") == F.col("h_month")) & (F.dayofmonth("ds") == F.col("h_day")), "left"
        )
    middle = (F.col("low") + F.col("high")) / 2
    if jitter_seed is not None:
        drawn = F.col("low") + (F.col("high") - F.col("low")) * F.rand(jitter_seed)
        middle = drawn * (F.lit(0.85) + F.lit(0.3) * F.rand(jitter_seed + 1))
    return joined.withColumn("factor", F.coalesce(middle, F.lit(1.0))).drop("h_month", "h_day", "low", "high")


def interval(value: Column, step: Column, steps: int) -> tuple[Column, Column]:
    """Percentage band that widens with the step (first step is 0)."""
    growth = 1.0 + (step - 1) / F.lit(float(steps)) * 0.3
    return F.greatest(F.lit(0.0), value * (F.lit(0.65) / growth)), value * 1.35 * growth


def normal_interval(value: Column, step: Column, spread: Column, every_step: bool = False) -> tuple[Column, Column]:
    """95 % band from the residual spread; half a step per day by default."""
    half = NORMAL_95 * spread * F.sqrt(step * (1.0 if every_step else 0.5))
    return F.greatest(F.lit(0.0), value - half), value + half


def forecast(
    daily: DataFrame,
    keys: list[str],
    steps: int = 30,
    order: tuple[int, int, int] | None = None,
    holiday_table: DataFrame | None = None,
    band: str = "percent",
    jitter_seed: int | None = None,
    fit_days: int = FIT_DAYS,
    minimum: int = MIN_POINTS,
) -> DataFrame:
    """``(keys, step, ds, value, lower, upper)`` for every modelled series.

    Without keys the whole frame is one series.
    """
    if not keys:
        one = daily.withColumn(WHOLE, F.lit("all"))
        return forecast(one, [WHOLE], steps, order, holiday_table, band, jitter_seed, fit_days, minimum).drop(WHOLE)
    rows, models = fit_models(daily, keys, order, fit_days=fit_days, minimum=minimum)
    return forecast_models(rows, models, keys, steps, holiday_table, band, jitter_seed)


def forecast_models(
    rows: DataFrame,
    models: DataFrame,
    keys: list[str],
    steps: int = 30,
    holiday_table: DataFrame | None = None,
    band: str = "percent",
    jitter_seed: int | None = None,
) -> DataFrame:
    """The forecast of fitted models.

    Order of steps: recursion, summing back, scale, weekday effect, holiday
    factor, floor at 0, band.
    """
    ahead = with_future_dates(standardised_forecast(rows, models, keys, steps))
    weekday = S.weekday_effects(rows.select(*keys, "ds", "y"), keys)
    scaled = ahead.withColumn("weekday", dates.weekday_index(F.col("ds"))).join(weekday, [*keys, "weekday"], "left")
    base = F.col("z_hat") * F.col("sd") + F.col("mean")
    wobble = F.lit(1.0) if jitter_seed is None else F.lit(0.5) + F.rand(jitter_seed + 2)
    raw = base + F.coalesce("effect", F.lit(0.0)) * wobble
    dated = with_holiday_factor(scaled.withColumn("raw", raw), holiday_table, jitter_seed)
    valued = dated.withColumn("value", F.greatest(F.col("raw") * F.col("factor"), F.lit(0.0)))
    if band == "percent":
        lower, upper = interval(F.col("value"), F.col("step"), steps)
    else:
        spread = F.sqrt("sigma2") * F.col("sd")
        lower, upper = normal_interval(F.col("value"), F.col("step"), spread, band == "normal_full")
    return valued.select(*keys, "step", "ds", "value", lower.alias("lower"), upper.alias("upper"))


def trend_season_models(series: DataFrame, keys: list[str], p: int = 2, d: int = 1, q: int = 2) -> DataFrame:
    """Trend + weekly season + residual terms: fitted values per day."""
    flat = S.detrended(series, keys).withColumn("phase", F.col("idx") % S.WEEK)
    season = F.avg("r").over(Window.partitionBy(*keys, "phase"))
    acf = S.autocorrelation(flat, keys, p).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("lag", "acf"))).alias("acf")
    )
    smooth = S.centred_mean(flat, keys, "r", q, "ma") if q > 0 else flat.withColumn("ma", F.lit(0.0))
    weighted = F.lit(0.0)
    for lag in range(1, p + 1):
        weighted = weighted + F.when(F.col("idx") >= lag, F.col("acf")[lag] * F.col("r")).otherwise(0.0)
    return (
        smooth.withColumn("season", season).join(acf, keys)
        .withColumn("fitted", F.col("trend") + F.col("season") + AR_WEIGHT * weighted + MA_WEIGHT * F.col("ma"))
    )


def trend_season_criteria(fitted: DataFrame, keys: list[str], p: int = 2, d: int = 1, q: int = 2) -> DataFrame:
    """RSS, AIC and BIC of :func:`trend_season_models`, never below 0."""
    k = p + d + q + 1
    rss, n = F.col("rss"), F.col("n")
    scored = fitted.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum(F.pow(F.col("y") - F.col("fitted"), F.lit(2.0))).alias("rss")
    )
    score = lambda penalty: F.when(rss == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), n * F.ln(rss / n) + penalty)
    )
    return scored.withColumn("aic", score(F.lit(2.0 * k))).withColumn("bic", score(k * F.ln(n)))


def trend_season_forecast(series: DataFrame, keys: list[str], steps: int = 30, p: int = 2) -> DataFrame:
    """``(keys, step, ds, value)``: line, weekly phase and damped residuals.

    The last p residuals, newest with lag 1, weigh in with half their mean.
    """
    flat = S.detrended(series, keys)
    season = S.phase_means(flat, keys, "r", centred=False)
    acf = S.autocorrelation(flat, keys, p)
    newest = flat.withColumn("lag", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("ds"))))
    push = (
        newest.where(F.col("lag") <= p).select(*keys, "lag", "r").join(acf, [*keys, "lag"])
        .groupBy(*keys).agg((0.5 * F.sum(F.col("r") * F.col("acf")) / F.count("*")).alias("push"))
    )
    ends = flat.groupBy(*keys).agg(
        F.max("ds").alias("last_ds"), F.count("*").alias("n"),
        F.first("slope").alias("slope"), F.first("intercept").alias("intercept"),
    )
    ahead = with_future_dates(
        ends.join(push, keys).select("*", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    ).withColumn("idx", F.col("n") + F.col("step") - 1).withColumn("phase", F.col("idx") % S.WEEK)
    value = F.col("slope") * F.col("idx") + F.col("intercept") + F.coalesce("season", F.lit(0.0)) + F.col("push")
    return ahead.join(season, [*keys, "phase"], "left").select(*keys, "step", "ds", value.alias("value"))


def chart_series(history: DataFrame, predicted: DataFrame, keys: list[str], days: int = 60) -> DataFrame:
    """Last history points, forecast and upper band on one date axis.

    Forecast and band start at the last history point, as the lines do.
    """
    recent = S.last_points(history, keys, days).select(*keys, "ds", F.lit("history").alias("kind"), F.col("y").alias("value"))
    joint = S.last_points(history, keys, 1)
    lines = [recent]
    for kind, column in (("forecast", "value"), ("upper", "upper")):
        lines.append(joint.select(*keys, "ds", F.lit(kind).alias("kind"), F.col("y").alias("value")))
        lines.append(predicted.select(*keys, "ds", F.lit(kind).alias("kind"), F.col(column).alias("value")))
    out = lines[0]
    for line in lines[1:]:
        out = out.unionByName(line)
    return out
