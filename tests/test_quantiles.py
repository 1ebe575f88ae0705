"""Exact quantiles and cleaning steps on literal frames."""

import math
import random

import pytest

from salesweft.operators import quality, quantiles


def test_same_as_percentile(spark):
    random.seed(7)
    values = [(random.choice([1.0, 2.5, random.gauss(0, 100)]), float(i % 7) if i % 5 else None) for i in range(3001)]
    df = spark.createDataFrame(values, "a double, b double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r["field"], r["probability"]): r["value"] for r in quantiles.exact_quantiles(df, ["a", "b"], probs).collect()}
    for f in ("a", "b"):
        want = df.selectExpr(f"percentile({f}, array({', '.join(map(str, probs))}))").first()[0]
        assert all(abs(got[(f, p)] - w) < 1e-9 for p, w in zip(probs, want))


def columns(n=4000):
    """Columns that are hard to narrow down: copies, constants, outliers, NaN, infinities, nulls."""
    rng = random.Random(11)
    return [
        (rng.gauss(0, 1), 7.0, rng.choice([1.0, 1.0, 1.0, 2.0]), 1e300 if i == 5 else float(i % 100), float("nan") if i % 7 == 0 else float(-i),
         rng.choice([float("-inf"), float("inf"), 0.0]), None if i % 3 else rng.expovariate(1) ** 9, float(i) if i < 3 else None)
        for i in range(n)
    ]


PROBABILITIES = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("small, accuracy", [(1 << 18, 10_000), (3, 10_000), (3, 30), (1, 100)])
def test_narrowing_gives_percentiles(spark, monkeypatch, small, accuracy):
    """Gaps of one value and very rough ends still end at the exact ranks."""
    monkeypatch.setattr(quantiles, "SMALL", small)
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    monkeypatch.setattr(quantiles, "MARGIN", 2 / accuracy)
    names = list("abcdefgh")
    df = spark.createDataFrame(columns(), ", ".join(f"{n} double" for n in names))
    got = {(r["field"], r["probability"]): r["value"] for r in quantiles.exact_quantiles(df, names, PROBABILITIES).collect()}
    want = df.selectExpr(*[f"percentile({n}, array({', '.join(f'{p}D' for p in PROBABILITIES)})) AS {n}" for n in names]).first()
    for n in names:
        for p, w in zip(PROBABILITIES, want[n]):
            v = got[(n, p)]
            assert v == w or (math.isnan(v) and math.isnan(w)) or abs(v - w) <= 1e-9 * max(1.0, abs(w)), (n, p, v, w)


def test_no_task_orders_more_than_a_small_gap(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SMALL", 300)
    seen = []
    ranked = quantiles._ranked
    monkeypatch.setattr(quantiles, "_ranked", lambda long, gaps: seen.extend(gaps) or ranked(long, gaps))
    df = spark.range(200_000).selectExpr("CAST(pmod(hash(id), 1000003) AS double) AS v", "CAST(id % 3 AS double) AS w")
    quantiles.exact_quantiles(df, ["v", "w"], [0.25, 0.5, 0.75]).count()
    assert seen and all(g.count <= 300 for g in seen)


def test_values_close_to_each_other(spark):
    df = spark.range(1, 1001).selectExpr("CAST(id AS double) AS v")
    got = quantiles.exact_quantiles(df, ["v"], [0.25, 0.5]).orderBy("probability").collect()
    assert [r["value"] for r in got] == [250.75, 500.5]


def test_empty_and_all_null(spark):
    df = spark.createDataFrame([(None,)], "Quantity double")
    assert quantiles.exact_quantiles(df, ["Quantity"], [0.5]).count() == 0
    assert quality.fill_medians(df, ["Quantity"]).first()["Quantity"] is None


def test_outliers_become_median(spark):
    df = spark.createDataFrame([(0,), (101,), (None,), (4,), (6,)], "Quantity long")
    assert {r["field"]: r["outliers"] for r in quality.outlier_counts(df).collect()} == {"Quantity": 2}
    filled = quality.fill_medians(quality.null_outliers(df), ["Quantity"])
    assert sorted(r["Quantity"] for r in filled.collect()) == [4.0, 5.0, 5.0, 5.0, 6.0]


def test_invalid_enum_stays_missing_is_unknown(spark):
    df = spark.createDataFrame([("X",), (None,), ("Male",)], "Gender string")
    assert quality.enum_violation_total(df).first()["invalid"] == 1
    assert [r["Gender"] for r in quality.fill_unknown(df).collect()] == ["X", "Unknown", "Male"]
    assert quality.missing_counts(df).first().asDict() == {"field": "Gender", "missing": 1}
