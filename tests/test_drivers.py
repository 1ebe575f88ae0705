"""Feature table, rules, insights and the regression tree."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesweft.operators import drivers as D, tree as T
from salesweft.plans import analyses


@pytest.fixture(scope="module")
def table(spark):
    rows = []
    for r in "ABCD":
        for s in ("Spring", "Summer"):
            for c in ("coat", "shirt", "bag"):
                for tier in ("Low", "High"):
                    for rep in range(3):
                        volume = 100 + 50 * (r == "A") + 30 * (s == "Summer") + 200 * (c == "coat") + rep
                        rows.append((r, s, c, tier, volume))
    return spark.createDataFrame(rows, "Region string, Season string, Category string, Price_Range string, Sales_Volume long")


def test_price_tier_uses_at_least_one_order(spark):
    sales = spark.createDataFrame(
        [("x", "c", "s", 150.0, 0, 1.0), ("y", "c", "s", 150.0, 2, 1.0), ("z", "c", "s", 900.0, 3, 1.0), (None, "c", "s", 1.0, 1, 1.0)],
        "city string, category string, season string, sales_amount double, order_count long, profit double",
    )
    tiers = {r["Region"]: r["Price_Range"] for r in D.feature_table(sales).collect()}
    assert tiers == {"x": "Mid", "y": "Low", "z": "High"}


def test_rules_and_insights(table):
    rules = D.decision_rules(table).collect()
    assert len(rules) == 20 and rules[0]["condition"] == "Region=A, Season=Summer, Category=coat"
    assert rules[0]["conclusion"] == "Expected Sales Volume: 381" and rules[0]["confidence"] == 1.0
    assert abs(rules[0]["support"] - 6 / 144) < 1e-12
    insights = D.stocking_insights(table, n=8).collect()
    marks = np.percentile([r["expected_sales"] for r in insights], [25, 50])
    for r in insights:
        want = "高" if r["expected_sales"] >= marks[1] else "中" if r["expected_sales"] >= marks[0] else "低"
        assert r["priority"] == want


def reference_tree(x, y, depth, split, leaf):
    """Greedy variance tree on 0/1 columns; predictions per row."""
    out = np.full(len(y), y.mean())
    if depth == 0 or len(y) < split:
        return out
    best = None
    for j in range(x.shape[1]):
        right = x[:, j] == 1
        if right.sum() < leaf or (~right).sum() < leaf:
            continue
        cost = y[right].var() * right.sum() + y[~right].var() * (~right).sum()
        if best is None or cost < best[0] - 1e-9:
            best = (cost, right)
    if best is None or best[0] >= y.var() * len(y) - 1e-9:
        return out
    for side in (best[1], ~best[1]):
        out[side] = reference_tree(x[side], y[side], depth - 1, split, leaf)
    return out


@pytest.mark.parametrize("split", [2, 20, 60, 1000])
def test_tree_equals_greedy_tree(table, split):
    fitted = T.train_tree(table, max_depth=4, min_samples_split=split)
    rows = T.predict(table, fitted).collect()
    values = sorted({(c, r[c]) for r in rows for c in D.FEATURE_COLUMNS})
    x = np.array([[int(r[c] == v) for c, v in values] for r in rows])
    y = np.array([float(r["Sales_Volume"]) for r in rows])
    want = reference_tree(x, y, 4, split, T.MIN_LEAF)
    got = np.array([r["prediction"] for r in rows])
    assert np.isclose(((y - got) ** 2).mean(), ((y - want) ** 2).mean(), rtol=1e-6)
    assert fitted.depth() <= 4 and (split < 1000 or fitted.depth() == 0)


def test_metrics_and_importance(spark, table):
    fitted = T.train_tree(table)
    m = T.tree_metrics(table, fitted).first()
    rows = T.predict(table, fitted).collect()
    y, p = np.array([r["Sales_Volume"] for r in rows], float), np.array([r["prediction"] for r in rows])
    assert np.isclose(m["rmse"], np.sqrt(((y - p) ** 2).mean())) and np.isclose(m["mae"], np.abs(y - p).mean())
    assert np.isclose(m["r2"], 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    best = D.top_features(T.importance(spark, fitted)).collect()
    assert best[0]["name"] == "coat" and abs(sum(r["importance"] for r in best) - 1) < 1e-9
    sample = T.prediction_sample(table, fitted, 10).collect()
    assert len(sample) == 10 and all(len(r["features"]) == 4 for r in sample)


def test_equal_splits_go_by_column_then_value(spark):
    rows = [("a" if i % 2 else "b", "a" if i % 2 else "b", "c", None, 10 + 90 * (i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "Region string, Season string, Category string, Price_Range string, Sales_Volume long")
    fitted = T.train_tree(df)
    assert (fitted.column, fitted.value, fitted.depth()) == ("Region", "a", 1)
    assert (fitted.absent.prediction, fitted.present.prediction, fitted.rows) == (10.0, 100.0, 40)
    assert fitted.gain == 20 * 45.0**2 * 2


def test_nulls_stay_on_the_absent_side(spark):
    rows = [(None if i < 20 else "x", None, "c", "Low", 5 if i < 20 else 50) for i in range(40)] + [("x", "s", "c", "Low", None)]
    df = spark.createDataFrame(rows, "Region string, Season string, Category string, Price_Range string, Sales_Volume long")
    fitted = T.train_tree(df)
    assert (fitted.value, fitted.rows, fitted.absent.prediction, fitted.present.prediction) == ("x", 40, 5.0, 50.0)
    assert [r["feature"] for r in T.split_table(spark, {0: fitted}).collect()] == ["Region_x"]


def test_empty_and_constant_tables(spark, table):
    empty = T.train_tree(table.limit(0))
    assert (empty.prediction, empty.rows, empty.depth()) == (0.0, 0, 0)
    constant = T.train_tree(table.withColumn("Sales_Volume", F.lit(7).cast("long")))
    assert (constant.prediction, constant.rows, constant.depth()) == (7.0, 144, 0)
    assert T.importance(spark, constant).count() == 0


def test_folds_in_one_pass_equal_separate_trainings(table):
    spread = table.withColumn("Sales_Volume", F.col("Sales_Volume") + F.pmod(F.hash(*D.FEATURE_COLUMNS, "Sales_Volume"), F.lit(60)))
    trees, errors = T.cross_validation(spread, 4)
    folded = T.with_folds(spread, 4)
    assert set(trees) == set(range(5)) and trees[0] == T.train_tree(spread)
    for r in errors.collect():
        alone = T.train_tree(folded.where(F.col("fold") != r["fold"]))
        assert trees[r["fold"] + 1] == alone
        held = T.error_metrics(T.predict(folded.where(F.col("fold") == r["fold"]), alone)).first()
        assert r["rows"] == 36 and np.isclose(r["mse"], held["rmse"] ** 2)


def test_contiguous_folds(table):
    sizes = [r["n"] for r in T.with_folds(table.limit(13), 5).groupBy("fold").agg(F.count("*").alias("n")).orderBy("fold").collect()]
    assert sizes == [3, 3, 3, 2, 2]


def test_whole_driver_run(spark):
    rows = [
        (city, cat, season, 100.0 * (1 + i), 1 + i % 4, 5.0)
        for i, (city, cat, season) in enumerate((a, b, c) for a in "abcde" for b in "xyz" for c in "wsuv")
    ]
    sales = spark.createDataFrame(
        rows, "city string, category string, season string, sales_amount double, order_count long, profit double"
    )
    result = analyses.run_drivers(sales)
    assert tuple(result.sizes.first()) == (5, 3, 4) and result.cross_validated_mse >= 0
    assert result.rules.count() == 20 and result.insights.count() == 50 and result.sample.count() == 10
