"""Behaviour table, scaling, segment quality, k-means invariants."""

import datetime as dt
import hashlib
import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesweft.functions import numbers
from salesweft.operators import kmeans, segments as G
from salesweft.plans import analyses

LINES = "customer_id long, order_id long, order_date date, sales_amount double, category string, season string, region string"


def test_behaviour(spark):
    d = dt.date
    rows = [
        (1, 10, d(2024, 1, 31), 5.0, "b", "w", "r"), (1, 10, d(2024, 1, 31), 5.0, "a", "w", "r"),
        (1, 11, d(2024, 4, 1), 20.0, "a", "s", "r"), (2, 12, d(2024, 3, 1), 7.0, None, None, None),
        (None, 13, d(2024, 5, 1), 1.0, "a", "s", "r"),
    ]
    got = {r["customer_id"]: r for r in G.behaviour_table(spark.createDataFrame(rows, LINES)).collect()}
    one, two = got[1], got[2]
    assert (one["Total_Orders"], one["Total_Spend"], one["Avg_Order_Value"]) == (2, 30.0, 15.0)
    assert abs(one["Purchase_Frequency"] - 2 / 3) < 1e-12 and one["Days_Since_Last_Purchase"] == 30
    assert (one["Favorite_Category"], one["Favorite_Season"], one["Preferred_Region"]) == ("a", "w", "r")
    assert two["Favorite_Category"] is None and two["Purchase_Frequency"] == 1.0 and len(got) == 2


def test_clip_and_scale(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 1000.0]
    df = spark.createDataFrame([(v, 7.0) for v in values], "a double, b double")
    clipped = sorted(r["a"] for r in G.clip_outliers(df, ["a", "b"]).collect())
    assert clipped[-1] == 4.75 + 1.5 * 2.5 and clipped[0] == 1.0
    rows = G.scale(df, ["a", "b"]).collect()
    want = (np.array(values) - np.mean(values)) / np.std(values)
    assert np.allclose([r["a"] for r in rows], want) and {r["b"] for r in rows} == {0.0}


def brute_scores(x, labels):
    names = sorted(set(labels))
    groups = {c: x[[l == c for l in labels]] for c in names}
    centre = {c: g.mean(axis=0) for c, g in groups.items()}
    w = sum(((g - centre[c]) ** 2).sum() for c, g in groups.items())
    b = sum(len(g) * ((centre[c] - x.mean(axis=0)) ** 2).sum() for c, g in groups.items())
    ch = (b / (len(names) - 1)) / (w / (len(x) - len(names)))
    s = {c: np.sqrt(((g - centre[c]) ** 2).sum(axis=1)).mean() for c, g in groups.items()}
    db = np.mean([
        max((s[i] + s[j]) / np.linalg.norm(centre[i] - centre[j]) for j in names if j != i) for i in names
    ])
    return ch, db, w


def test_quality_scores(spark):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(c, 1, (n, 2)) for c, n in ((0, 30), (4, 20), (9, 1))])
    labels = [0] * 30 + [1] * 20 + [2]
    df = spark.createDataFrame([(l, float(a), float(b)) for l, (a, b) in zip(labels, x)], "cluster int, a double, b double")
    ch, db, w = brute_scores(x, labels)
    f = ["a", "b"]
    assert np.isclose(G.calinski_harabasz(df, f).first()[0], ch)
    assert np.isclose(G.davies_bouldin(df, f).first()[0], db)
    assert np.isclose(G.inertia(df, f).first()[0], w)
    one = df.where("cluster = 0")
    assert G.calinski_harabasz(one, f).first()[0] is None and G.davies_bouldin(one, f).first()[0] is None


@pytest.fixture(scope="module")
def result(spark):
    random.seed(1)
    kinds = [(30, 9000.0, 300.0, 1.2, 5.0), (10, 3000.0, 300.0, 0.6, 30.0), (2, 300.0, 150.0, 0.1, 200.0)]
    rows = [
        (i, *[v * random.uniform(0.95, 1.05) for v in kinds[i % 3]], "c%d" % (i % 3), "r") for i in range(150)
    ]
    names = ", ".join(f"{f} double" for f in G.FEATURES)
    order = ["Total_Orders", "Total_Spend", "Avg_Order_Value", "Purchase_Frequency", "Days_Since_Last_Purchase"]
    assert order == G.FEATURES
    df = spark.createDataFrame(rows, f"customer_id long, {names}, Favorite_Category string, Preferred_Region string")
    return analyses.run_segmentation(df, k=3, seeds=range(42, 44))


def test_segments_found(result):
    profile = {r["portrait_label"]: r["user_count"] for r in result.profile.collect()}
    assert profile == {"VIP高价值用户": 50, "刚需型用户": 50, "随机型用户": 50}
    assert result.assignments.count() == 150 and result.k == 3
    assert result.metrics["silhouette"] > 0.9
    assert abs(sum(r["weight"] for r in result.weights.collect()) - 1) < 1e-9
    assert result.favourites.where("field = 'Favorite_Category' AND rank = 1").count() == 3


def blobs(spark, parts=3):
    rows = [(i * 3 + n, float(c) + (i % 5) / 50, float(c) + (i % 7) / 40) for i in range(60) for n, c in enumerate((0, 10, 20))]
    return spark.createDataFrame(rows, "customer_id long, a double, b double").repartition(parts), np.array(rows)


def plain_starts(rows, k, seed):
    chosen = []
    for step in range(k):
        best = None
        for i, *x in rows:
            h = int(hashlib.md5(f"{seed}|{step}|{int(i)}".encode()).hexdigest()[:13], 16)
            far = min((sum((p - q) ** 2 for p, q in zip(x, c)) for c in chosen), default=1.0)
            time = -math.log((h + 0.5) / 2**52) / far if far > 0 else math.inf
            best = min(best or (math.inf, math.inf, ()), (time, i, tuple(x)))
        chosen.append(best[2])
    return chosen


def plain_lloyd(rows, centres):
    x, c, steps = rows[:, 1:], np.array(centres), 0
    while True:
        near = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        steps, shift, c = steps + 1, ((new - c) ** 2).sum(), new
        if shift <= kmeans.TOL:
            return c, steps, ((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1).sum()


def test_stacked_fits_equal_single_ones(spark):
    points, rows = blobs(spark)
    models = kmeans.fit(points, ks=[2, 3, 5], seeds=[1, 2, 3])
    assert [(m.k, m.seed) for m in models] == [(k, s) for k in (2, 3, 5) for s in (1, 2, 3)]
    for m in models:
        centres, steps, inertia = plain_lloyd(rows, plain_starts(rows, m.k, m.seed))
        assert np.allclose(m.centres, centres) and m.iterations == steps and np.isclose(m.inertia, inertia) and m.settled
    again = kmeans.fit(blobs(spark, 7)[0], ks=[2, 3, 5], seeds=[1, 2, 3])
    assert all(np.allclose(a.centres, b.centres) for a, b in zip(models, again))


def test_sums_of_many_models_are_compiled(spark):
    points, rows = blobs(spark)
    models = [kmeans.Model(k, seed, [tuple(rows[(seed + 7 * j) % len(rows), 1:]) for j in range(k)]) for k in kmeans.KS for seed in kmeans.SEEDS]
    found = kmeans._sums(points, models, ["a", "b"])
    assert "transform" not in found._jdf.queryExecution().executedPlan().toString()
    got = {(r["m"], r["j"]): tuple(r)[2:] for r in found.collect()}
    for m, model in enumerate(models):
        far = ((rows[:, None, 1:] - np.array(model.centres)[None]) ** 2).sum(axis=2)
        near = far.argmin(axis=1)
        for j in set(near):
            assert got.pop((m, j)) == pytest.approx([(near == j).sum(), far[near == j, j].sum(), *rows[near == j, 1:].sum(axis=0)])
    assert not got


def test_choose_k_and_silhouettes(spark):
    points, _ = blobs(spark)
    chosen, best = kmeans.choose(points, ks=range(2, 6), seeds=(42, 43))
    assert chosen.k == 3 and set(best) == {2, 3, 4, 5}
    for m in best.values():
        placed = G.vectors(kmeans.assigned(points, m), ["a", "b"])
        assert np.isclose(m.silhouette, G.silhouette(placed))
        assert tuple(G.misplaced(placed, m.centres, ["a", "b"]).first()) == (180, 0)
        assert tuple(G.moved(placed, m.centres, kmeans.TOL, ["a", "b"]).first()) == (m.k, 0)


def test_fewer_points_than_clusters(spark):
    points = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 5.0)], "customer_id long, a double")
    model = kmeans.best_of(kmeans.fit(points, [3], [1, 2]))[3]
    assert model.inertia == 0 and sorted(set(model.centres)) == [(1.0,), (5.0,)]
    assert kmeans.silhouettes(points, [model]) == [2 / 3]
    one = kmeans.fit(points.limit(1), [2], [1])
    assert len(one) == 1 and len(kmeans.fit(points.limit(0), [2], [1])) == 0


def test_equal_centroids_do_not_fail(spark):
    rows = [(c, x, 1.0) for c in ("a", "b") for x in (0.0, 2.0)] + [("c", 9.0, 1.0), ("c", 9.0, 3.0)]
    df = spark.createDataFrame(rows, "cluster string, f double, g double")
    score = G.davies_bouldin(df, ["f", "g"]).first()[0]
    far = (1 + 1) / (8**2 + 1) ** 0.5
    assert abs(score - far) < 1e-9


def test_wide_amounts_are_summed(spark):
    df = spark.createDataFrame([(1e15,), (0.25,), (-1e20,), (None,), (float("inf"),)], "v double")
    total = df.agg(numbers.money_total(F.col("v")).alias("t")).first()["t"]
    assert total == Decimal("1000000000000000.25") - Decimal(10**20)
