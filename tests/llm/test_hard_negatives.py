import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesweft.llm import hard_negatives
from salesweft.session import importable

SCHEMA = "vec_id long, embedding array<float>, label int, id string, row int, vector string, length long, is_anchor int, rank long"


def data(seed=1, n=150, width=10):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, width))
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 4))
        rows.append((i, [float(x) for x in (centres[label] * 0.6 + rng.normal(size=width) * 0.5).astype(np.float32)], label))
    rows += [(1000 + k, rows[0][1], k % 4) for k in range(40)]  # equal vectors
    rows += [(10, rows[10][1], rows[10][2]), (10, rows[10][1], rows[10][2]), (7, rows[7][1], 3)]  # repeated ids
    rows += [(2000, None, 1), (2010, rows[1][1], None), (2020, [None] + rows[1][1][1:], 1), (2030, [float("nan")] + rows[1][1][1:], 1), (2040, [float("inf")] + rows[1][1][1:], 1)]
    rows += [(None, rows[0][1], 0), (None, rows[0][1], 1), (3000, [], 0), (3010, [1.0], 2), (3020, [0.0] * width, 1), (4000, [1.0] * width, 77)]
    return rows


def brute(rows, every, positives=5, negatives=3, low=50, high=95):
    kept = [(i, l, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, l in rows if l is not None and v is not None and not any(x is None or not np.isfinite(x) for x in v)]
    out = []
    for a, (i, label, v) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, l) for b, (j, l, w) in enumerate(kept) if b != a]
        order = lambda s: (-s[0], s[1] is None, s[1] or 0)
        for p in sorted((s for s in scored if s[2] == label), key=order)[:positives]:
            fits = [s for s in scored if s[2] != label and low * p[0] <= 100 * s[0] <= high * p[0]]
            out += [(i, p[1], k + 1, s[1], p[0], s[0]) for k, s in enumerate(sorted(fits, key=order)[:negatives])]
    return Counter(out)


def frame(spark, rows, parts=4):
    importable(spark)
    return spark.createDataFrame([(i, v, l, "x", 1, "v", 2, 3, 4) for i, v, l in rows], SCHEMA).repartition(parts)


def found(df, every=10, **options):
    return Counter(tuple(r) for r in hard_negatives.mined(df, F.col("vec_id") % every == 0, **options).collect())


@pytest.mark.parametrize("seed, width", [(1, 10), (2, 37)])
def test_matches_brute_force(spark, seed, width):
    rows = data(seed, width=width)
    want = brute(rows, 10)
    assert len(want) > 100 and found(frame(spark, rows)) == want


def test_blocks_and_other_numbers(spark, monkeypatch):
    rows = data(3)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 6)
    monkeypatch.setattr(hard_negatives, "CELLS", 64)
    options = {"positives": 2, "negatives": 4, "percents": (30, 80)}
    assert found(frame(spark, rows), 15, **options) == brute(rows, 15, 2, 4, 30, 80)


def test_threshold_join_drops_and_keeps():
    """Pairs at every threshold: those that reach it, and no other; a high one leaves dimensions out of the index."""
    rng = np.random.default_rng(1)
    rows, anchors = rng.integers(-60, 60, (80, 24)), rng.integers(-60, 60, (15, 24))
    exact = rows @ anchors.T
    join = hard_negatives.Join(anchors, np.arange(15), np.zeros(15), None, None, 1, True, float(np.sqrt((rows**2).sum(axis=1).max())))
    dims, cuts = join.ordered()
    a, r = anchors[:, dims].astype(float), rows[:, dims].astype(float)
    rest = hard_negatives._rest_lengths(a, cuts)
    shortest = []
    for quantile in (0.0, 0.5, 0.9, 0.99, 1.0):
        threshold = np.quantile(exact, quantile, axis=0).astype(np.int64) + (quantile == 1.0) * 20_000
        ends = join.index_ends(rest, threshold)
        row, anchor, score = hard_negatives._reaching(r, a, hard_negatives._rest_lengths(r, cuts), rest, cuts, ends, threshold)
        want = {(int(i), int(j)) for i, j in zip(*np.nonzero(exact >= threshold))}
        assert set(zip(row.tolist(), anchor.tolist())) == want and (exact[row, anchor] == score).all()
        shortest.append(ends.min())
    assert shortest[0] == len(cuts) - 1 > shortest[-1]


def test_empty_and_useless_tables(spark):
    df = frame(spark, data())
    for part in (df.limit(0), df.where("label IS NULL"), df.where("vec_id % 10 <> 0"), df.where("vec_id = 0")):
        out = hard_negatives.mined(part, F.col("vec_id") % 10 == 0)
        assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and out.count() == 0


def test_too_large_components_are_refused(spark):
    with pytest.raises(ValueError, match="too large"):
        found(frame(spark, [(0, [1e20], 1), (1, [1e20], 1)]))


def test_very_large_components_stay_exact(spark):
    rng = random.Random(1)
    rows = [(i, [float(rng.randint(0, 1 << 16)) for _ in range(3)], i % 3) for i in range(60)]
    assert found(frame(spark, rows)) == brute(rows, 10)
