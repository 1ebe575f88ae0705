"""K-means for several numbers of clusters and several starts at once.

All models, one per number of clusters and seed, are one small table of
centres.  An iteration is one aggregation over the points: every point finds
its nearest centre in every model that still moves, and counts and sums by
model and cluster come back, as many rows as there are centres.  Points are
neither moved nor cached for it.  A task sums up its points in numpy, block by
block: an expression over hundreds of centres is too large to be compiled, and
interpreted it takes a hundred times longer.

Starts are k-means++: the next centre is drawn with a chance in proportion to
the squared distance from the centres so far.  The draw is a race,
``-ln(u) / distance``, whose winner is found by one minimum over all points;
``u`` is a digest of seed, step and id, so a start does not depend on the
partitioning.  The start for k centres is the beginning of that for k + 1.

A model has settled when the squared moves of its centres sum up to ``tol`` at
most.  A cluster that loses all its points keeps its centre; points as near to
two centres belong to the first.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from salesweft.session import importable

TOL = 1e-4
MAX_ITER = 300
KS = range(2, 10)
SEEDS = range(42, 52)
# Points that a task compares at once; what they need stays in the cache.
BLOCK = 2048

Centre = tuple[float, ...]


@dataclass
class Model:
    """Centres of one fit; ``inertia`` is the sum of the squared distances to them."""

    k: int
    seed: int
    centres: list[Centre]
    inertia: float = 0.0
    iterations: int = 0
    settled: bool = False
    silhouette: float | None = field(default=None, compare=False)


def _literal(rows: list[dict], kind: str) -> Column:
    """A small nested table as one literal."""
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{kind}>>")


def _squared(features: list[str], centre: Column) -> Column:
    parts = [F.col(f) - F.get(centre, F.lit(i)) for i, f in enumerate(features)]
    return sum((p * p for p in parts[1:]), parts[0] * parts[0])


def _nearest(features: list[str], centres: Column) -> Column:
    """Struct (d, j): squared distance and number of the nearest centre."""
    return F.array_min(F.transform(centres, lambda c, j: F.struct(_squared(features, c).alias("d"), j.alias("j"))))


def _each(points: DataFrame, models: list[Model], features: list[str], *keep: str) -> DataFrame:
    """Every point once per model, with the model's number and its nearest centre."""
    table = _literal([{"m": m, "c": model.centres} for m, model in enumerate(models)], "m:int,c:array<array<double>>")
    near = F.transform(table, lambda x: F.struct(x["m"].alias("m"), _nearest(features, x["c"]).alias("near")))
    return points.select(*keep, *features, F.explode(near).alias("x")).select(*keep, *features, "x.m", "x.near.j", "x.near.d")


def _numbers(batch: pa.RecordBatch, features: list[str]) -> np.ndarray:
    """The features of a batch, one row each; missing values are NaN."""
    return np.stack([batch.column(f).to_numpy(zero_copy_only=False).astype(float) for f in features])


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, a row per centre, added up feature by feature as :func:`_squared` does."""
    out = None
    for value, at in zip(x, centres.T):
        part = value[None, :] - at[:, None]
        part *= part
        out = part if out is None else np.add(out, part, out=out)
    return out


def _first_least(far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre of every point, the first of equal ones, and its distance."""
    least, number = far[0].copy(), np.zeros(far.shape[1], dtype=np.intp)
    for j in range(1, len(far)):
        np.copyto(number, j, where=far[j] < least)
        np.minimum(least, far[j], out=least)
    return number, least


def starts(points: DataFrame, k: int, seeds, features: list[str], id_column: str) -> dict[int, list[Centre]]:
    """``k`` first centres per seed, in the order they were drawn; all seeds share a pass per centre."""
    importable(points.sparkSession)
    drawn: dict[int, list[Centre]] = {s: [] for s in seeds}
    runs = "s int, time double, " + ", ".join(f"`{c}` {points.schema[c].dataType.simpleString()}" for c in (id_column, *features))
    for step in range(k):
        def waiting(s: int) -> Column:
            digest = F.md5(F.concat_ws("|", F.lit(s), F.lit(step), F.col(id_column)).cast("binary"))
            return -F.log((F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52)))

        told = {s: np.array(c, dtype=float) for s, c in drawn.items()}

        def race(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, kept = _numbers(batch, features), batch.select([id_column, *features])
                for s, centres in told.items():
                    time = batch.column(f"_{s}").to_numpy()
                    if len(centres):
                        far = np.concatenate([_distances(x[:, i : i + BLOCK], centres).min(axis=0) for i in range(0, x.shape[1], BLOCK)])
                        time = np.where(far > 0, time / np.where(far > 0, far, 1.0), np.inf)
                    first = pa.array(np.flatnonzero(time == time.min()))
                    won = [pa.array(np.full(len(first), s, dtype=np.int32)), pa.array(time).take(first), *kept.take(first).columns]
                    yield pa.RecordBatch.from_arrays(won, names=["s", "time", id_column, *features])

        each = points.select(id_column, *features, *[waiting(s).alias(f"_{s}") for s in drawn])
        first = each.mapInArrow(race, runs).groupBy("s").agg(F.min(F.struct("time", id_column, F.array(*features).alias("centre"))).alias("first"))
        for r in first.collect():
            drawn[r["s"]].append(tuple(r["first"]["centre"]))
    return {s: c for s, c in drawn.items() if len(c) == k}


def _sums(points: DataFrame, models: list[Model], features: list[str]) -> DataFrame:
    """Points, their squared distances and sums of the features, by model and nearest centre."""
    told = [np.array(model.centres, dtype=float) for model in models]
    begin = np.cumsum([0, *[len(c) for c in told]])
    names = ["m", "j", "n", "d", *features]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(begin[-1], dtype=np.int64), np.zeros((len(features) + 1, begin[-1]))
        for batch in batches:
            x = _numbers(batch, features)
            for i in range(0, x.shape[1], BLOCK):
                block = np.ascontiguousarray(x[:, i : i + BLOCK])
                for centres, a, b in zip(told, begin, begin[1:]):
                    number, least = _first_least(_distances(block, centres))
                    n[a:b] += np.bincount(number, minlength=b - a)
                    for total, value in zip(sums, (least, *block)):
                        total[a:b] += np.bincount(number, value, b - a)
        some = np.flatnonzero(n)
        model = np.repeat(np.arange(len(told), dtype=np.int32), np.diff(begin))
        cluster = (np.arange(begin[-1]) - begin[model]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(c[some]) for c in (model, cluster, n, *sums)], names=names)

    parts = points.select(*features).mapInArrow(summed, "m int, j int, n bigint, d double, " + ", ".join(f"`{f}` double" for f in features))
    return parts.groupBy("m", "j").agg(*[F.sum(c).alias(c) for c in names[2:]])


def fit(points: DataFrame, ks=KS, seeds=SEEDS, features: list[str] | None = None, id_column: str = "customer_id", max_iter: int = MAX_ITER, tol: float = TOL) -> list[Model]:
    """A model per number of clusters and seed; ``points`` should be a written table, it is read once per iteration."""
    features = features or [c for c in points.columns if c != id_column]
    begun = starts(points, max(ks), seeds, features, id_column)
    models = [Model(k, s, c[:k]) for k in ks for s, c in begun.items()]
    moving = list(models)
    while moving:
        found = _sums(points, moving, features).collect()
        left = []
        for m, model in enumerate(moving):
            rows = {r["j"]: r for r in found if r["m"] == m}
            if model.settled or model.iterations == max_iter:
                model.inertia = sum(r["d"] for r in rows.values())
                continue
            means = [tuple(rows[j][f] / rows[j]["n"] for f in features) if j in rows else c for j, c in enumerate(model.centres)]
            shift = sum((a - b) * (a - b) for new, old in zip(means, model.centres) for a, b in zip(new, old))
            model.centres, model.iterations, model.settled = means, model.iterations + 1, shift <= tol
            left.append(model)
        moving = left
    return models


def best_of(models: list[Model]) -> dict[int, Model]:
    """The model of least inertia for every number of clusters, the first of equal ones."""
    return {k: min((m for m in models if m.k == k), key=lambda m: (m.inertia, m.seed)) for k in sorted({m.k for m in models})}


def silhouettes(points: DataFrame, models: list[Model], features: list[str] | None = None, id_column: str = "customer_id") -> list[float]:
    """Mean silhouette of every model (squared distances, so one pass over points and cluster sums)."""
    features = features or [c for c in points.columns if c != id_column]
    norm = sum((F.col(f) * F.col(f) for f in features[1:]), F.col(features[0]) * F.col(features[0]))
    stats = _each(points, models, features).groupBy("m", "j").agg(F.count("*").alias("n"), F.avg(norm).alias("q"), *[F.avg(f).alias(f) for f in features]).collect()
    table = _literal(
        [{"m": m, "c": model.centres, "s": [{"j": r["j"], "n": r["n"], "q": r["q"], "mu": [r[f] for f in features]} for r in stats if r["m"] == m]} for m, model in enumerate(models)],
        "m:int,c:array<array<double>>,s:array<struct<j:int,n:bigint,q:double,mu:array<double>>>",
    )

    def mean_distance(s: Column) -> Column:
        dot = sum((F.col(f) * F.get(s["mu"], F.lit(i)) for i, f in enumerate(features)), F.lit(0.0))
        return norm + s["q"] - 2 * dot

    def value(x: Column) -> Column:
        own = _nearest(features, x["c"])["j"]
        far = F.transform(x["s"], lambda s: F.struct(s["j"].alias("j"), s["n"].alias("n"), mean_distance(s).alias("d")))
        return F.struct(x["m"].alias("m"), own.alias("j"), far.alias("far"))

    each = points.select(*features, F.explode(F.transform(table, value)).alias("x")).select("x.m", "x.j", "x.far")
    me = F.filter("far", lambda s: s["j"] == F.col("j"))[0]
    a = me["d"] * me["n"] / F.greatest(me["n"] - 1, F.lit(1))
    b = F.array_min(F.transform(F.filter("far", lambda s: s["j"] != F.col("j")), lambda s: s["d"]))
    scored = each.select("m", me["n"].alias("n"), a.alias("a"), b.alias("b"))
    one = F.when((F.col("n") == 1) | F.col("b").isNull() | (F.col("a") == F.col("b")), 0.0).when(F.col("a") < F.col("b"), 1 - F.col("a") / F.col("b")).otherwise(F.col("b") / F.col("a") - 1)
    found = {r["m"]: r["s"] for r in scored.groupBy("m").agg(F.avg(one).alias("s")).collect()}
    return [found[m] for m in range(len(models))]


def choose(points: DataFrame, ks=KS, seeds=SEEDS, features: list[str] | None = None, id_column: str = "customer_id") -> tuple[Model, dict[int, Model]]:
    """The best model by silhouette, the smaller k of equal ones, and the best model of every k."""
    best = best_of(fit(points, ks, seeds, features, id_column))
    for model, score in zip(best.values(), silhouettes(points, list(best.values()), features, id_column)):
        model.silhouette = score
    return max(best.values(), key=lambda m: (m.silhouette, -m.k)), best


def assigned(points: DataFrame, model: Model, features: list[str] | None = None, id_column: str = "customer_id") -> DataFrame:
    """The points with the number of their cluster."""
    features = features or [c for c in points.columns if c != id_column]
    centres = _literal([{"c": model.centres}], "c:array<array<double>>")[0]["c"]
    return points.withColumn("cluster", _nearest(features, centres)["j"])
