"""Series operators and the forecast against a plain array computation."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesweft.operators import forecast as Fc, series as S
from salesweft.plans import analyses

KEYS = ["k"]
START = dt.date(2024, 1, 1)


def frame(spark, **series):
    rows = [(k, START + dt.timedelta(i), float(v)) for k, ys in series.items() for i, v in enumerate(ys)]
    return spark.createDataFrame(rows, "k string, ds date, y double")


def noise(n, seed=1, mean=1000.0, sd=50.0):
    rng = random.Random(seed)
    return [mean + rng.gauss(0, sd) for _ in range(n)]


def smooth(n):
    return [1000 + 300 * math.sin(i / 9) for i in range(n)]


def quadratic_like(n):
    """Levels that drift fast while the changes move slowly."""
    return [5 * i + 0.05 * i * i + 20 * math.sin(i / 15) for i in range(n)]


def d_of(y):
    z = (np.array(y) - np.mean(y)) / (np.std(y, ddof=1) or 1)
    for d in (0, 1):
        dz = np.diff(z)
        if len(z) >= 10 and abs(dz.mean()) < 0.05 * z.std(ddof=1) and dz.std(ddof=1) < 0.7 * z.std(ddof=1):
            return d
        z = dz
    return 2


def expected(y, steps):
    """d, p, coefficients and the path on the standardised scale."""
    mean, sd = np.mean(y), np.std(y, ddof=1) or 1.0
    z = (np.array(y) - mean) / sd
    d = d_of(y)
    x = np.diff(z, d) if d else z
    best = None
    for p in (1, 2):
        design = np.column_stack([x[p - 1 - i: len(x) - 1 - i] for i in range(p)])
        phi = np.linalg.pinv(design.T @ design) @ design.T @ x[p:]
        rss = float(np.sum((x[p:] - design @ phi) ** 2))
        aic = len(x) * math.log(rss / len(x) + 1e-10) + 2 * (p + 1) if rss > 0 else 0
        if aic and (best is None or aic < best[0]):
            best = (aic, p, phi)
    aic, p, phi = best
    last, path = list(x[-p:]), []
    for _ in range(steps):
        path.append(float(sum(c * v for c, v in zip(phi, last[::-1][:p]))))
        last.append(path[-1])
    path = np.array(path)
    if d >= 1:
        path = np.cumsum(path)
        if d == 2:
            path = np.cumsum(np.diff(z)[-1] + path)
        path = z[-1] + path
    return d, p, phi, aic, path


SHAPES = {"noise": noise(120), "smooth": smooth(150), "drift": quadratic_like(90), "walk": list(np.cumsum(noise(200, 5, 0, 3)) + 500)}


def test_order_fit_and_path(spark):
    rows, models = Fc.fit_models(frame(spark, **SHAPES), KEYS)
    got = {r["k"]: r for r in models.collect()}
    paths = {}
    for r in Fc.standardised_forecast(rows, models, KEYS, 12).orderBy("k", "step").collect():
        paths.setdefault(r["k"], []).append(r["z_hat"])
    seen = set()
    for k, y in SHAPES.items():
        d, p, phi, aic, path = expected(y[-180:], 12)
        seen.add(d)
        assert (got[k]["d"], got[k]["p"]) == (d, p), k
        assert abs(got[k]["phi1"] - phi[0]) < 1e-6 and abs(got[k]["aic"] - aic) < 1e-5
        assert np.allclose(paths[k], path, atol=1e-6), k
    assert {0, 2} <= seen


def test_change_stationary_gives_order_one(spark):
    y = quadratic_like(90)
    order = {r["k"]: r["d"] for r in S.stationarity(Fc.prepare(frame(spark, a=y, b=noise(90), c=smooth(90)), KEYS), KEYS).collect()}
    assert order == {"a": d_of(y), "b": d_of(noise(90)), "c": d_of(smooth(90))}


def test_constant_series_stays_constant(spark):
    out = Fc.forecast(frame(spark, c=[5.0] * 40), KEYS, 3, holiday_table=None).collect()
    assert [round(r["value"], 9) for r in out] == [5.0, 5.0, 5.0]


def test_short_and_dirty_series(spark):
    df = frame(spark, nine=noise(9), twenty_nine=noise(29), thirty=noise(30), dirty=[float("nan"), float("inf")] + noise(30))
    skipped = {r["k"]: r["points"] for r in S.skipped_series(S.fit_window(df, KEYS), KEYS).collect()}
    assert skipped == {"nine": 9, "twenty_nine": 29}
    _, models = Fc.fit_models(df, KEYS)
    assert {r["k"] for r in models.collect()} == {"thirty", "dirty"}


def test_weekday_effects_need_two_weeks(spark):
    df = frame(spark, short=noise(13), long=[float(i % 7) for i in range(70)])
    effects = {(r["k"], r["weekday"]): r["effect"] for r in S.weekday_effects(df, KEYS).collect()}
    assert {k for k, _ in effects} == {"long"}
    assert abs(effects[("long", 0)] + 3.0) < 1e-9 and abs(effects[("long", 6)] - 3.0) < 1e-9


def test_band_and_floor(spark):
    df = frame(spark, a=noise(60, 2, 10, 200))
    for band in ("percent", "normal"):
        for r in Fc.forecast(df, KEYS, 30, band=band).collect():
            assert 0 <= r["lower"] <= r["value"] <= r["upper"]


def test_seeded_jitter_stays_in_range(spark):
    df = spark.createDataFrame([(dt.date(2024, 11, 11),), (dt.date(2024, 11, 20),)], "ds date")
    mid = {r["ds"].day: r["factor"] for r in Fc.with_holiday_factor(df).collect()}
    drawn = {r["ds"].day: r["factor"] for r in Fc.with_holiday_factor(df, jitter_seed=3).collect()}
    assert mid == {11: 1.75, 20: 1.0} and drawn[20] == 1.0
    assert 1.5 * 0.85 <= drawn[11] <= 2.0 * 1.15


def test_bad_orders_are_refused():
    for order in ((1, 3, 0), (0, 1, 1), (2, 1, -1)):
        with pytest.raises(ValueError):
            Fc.check_order(order)


def test_longer_orders_solve_all_lags(spark):
    p = 4
    rows, models = Fc.fit_models(frame(spark, **SHAPES), KEYS, (p, 1, 0))
    got = {r["k"]: r for r in models.collect()}
    paths = {}
    for r in Fc.standardised_forecast(rows, models, KEYS, 6).orderBy("k", "step").collect():
        paths.setdefault(r["k"], []).append(r["x_hat"])
    fitted = {}
    for r in Fc.fitted_values(rows, models, KEYS).orderBy("k", "ds").collect():
        fitted.setdefault(r["k"], []).append(r["fitted_x"])
    for k, y in SHAPES.items():
        y = np.array(y[-180:])
        x = np.diff((y - y.mean()) / y.std(ddof=1))
        lags = np.stack([x[p - lag : len(x) - lag] for lag in range(1, p + 1)], axis=1)
        phis = np.linalg.lstsq(lags, x[p:], rcond=None)[0]
        assert np.allclose(got[k]["phis"], phis, atol=1e-8), k
        assert np.allclose(fitted[k], lags @ phis, atol=1e-8), k
        done = list(x)
        for _ in range(6):
            done.append(float(phis @ np.array(done[: -p - 1 : -1])))
        assert np.allclose(paths[k], done[-6:], atol=1e-8), k


@pytest.mark.parametrize("p", [1, 3, 6])
def test_least_norm_solves_regular_and_collinear_equations(spark, p):
    rng = np.random.default_rng(p)
    rows, want = [], []
    for rank in [*range(p + 1), p, p]:
        lags = rng.normal(size=(40, rank)) @ rng.normal(size=(rank, p))
        y = rng.normal(size=40)
        rows.append((len(rows), (lags.T @ lags).tolist(), (lags.T @ y).tolist()))
        want.append(np.linalg.lstsq(lags, y, rcond=1e-10)[0])
    df = spark.createDataFrame(rows, "i int, matrix array<array<double>>, target array<double>")
    got = df.select("i", Fc.least_norm(F.col("matrix"), F.col("target"), p).alias("phi")).orderBy("i").collect()
    for r in got:
        assert np.allclose(r["phi"], want[r["i"]], atol=1e-7), r["i"]


def test_long_orders_of_collinear_series_run_without_python(spark):
    y = [100.0 + 10 * (-1) ** i for i in range(60)]  # every lag is plus or minus the first
    rows, models = Fc.fit_models(frame(spark, a=y), KEYS, (4, 0, 0))
    plan = Fc.fit_long(rows, KEYS, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    found = models.first()
    assert np.allclose(found["phis"], [-0.25, 0.25, -0.25, 0.25]) and found["rss"] < 1e-18


def test_forecast_without_keys_is_one_series(spark):
    df = frame(spark, a=noise(60))
    one = [tuple(r) for r in Fc.forecast(df, KEYS, 5).drop("k").orderBy("step").collect()]
    assert [tuple(r) for r in Fc.forecast(df.drop("k"), [], 5).orderBy("step").collect()] == one


def test_series_without_a_model_are_listed(spark):
    df = frame(spark, a=noise(60), b=noise(9))
    rows, models = Fc.fit_models(df, KEYS, (2, 1, 4), minimum=5)
    assert [r["k"] for r in models.collect()] == ["a"]
    assert [(r["k"], r["points"]) for r in Fc.unmodelled_series(rows, models, KEYS).collect()] == [("b", 9)]


def test_acf_and_moving_means(spark):
    y = noise(50, 9)
    df = frame(spark, a=y)
    flat = S.detrended(df, KEYS)
    acf = [r["acf"] for r in S.autocorrelation(flat, KEYS, 3).orderBy("lag").collect()]
    x = np.arange(50)
    res = np.array(y) - np.polyval(np.polyfit(x, y, 1), x)
    e = res - res.mean()
    want = [float((e[k:] * e[: 50 - k]).sum() / (res.var() * 50)) for k in range(4)]
    assert np.allclose(acf, want, atol=1e-8)
    for q in (2, 3, 4):
        got = [r["m"] for r in S.centred_mean(flat, KEYS, "r", q, "m").orderBy("ds").collect()]
        assert np.allclose(got, np.convolve(res, np.ones(q) / q, mode="same"), atol=1e-6)
    trailing = [r["ma"] for r in S.trailing_change_mean(df, KEYS, 2).orderBy("ds").collect()]
    change = np.diff(y)
    assert np.allclose(trailing[1:], (change[1:] + change[:-1]) / 2) and np.isclose(trailing[0], change.mean())


def test_run_forecast_bundle(spark):
    days = [START + dt.timedelta(i) for i in range(40)]
    rows = [("tops", "Rome", d, 10.0 + i % 5) for i, d in enumerate(days)] + [("bags", "Rome", days[0], 1.0)]
    sales = spark.createDataFrame(rows, "category string, city string, order_date date, sales_amount double")
    result = analyses.run_forecast(sales, ["category"], city="Rome", steps=5)
    assert result.forecast.count() == 5 and result.history.count() == 40
    assert [r["category"] for r in result.skipped.collect()] == ["bags"]
    assert result.metrics.first()["rmse"] >= 0
