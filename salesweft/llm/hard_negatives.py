"""Hard-negative mining by threshold joins in the style of L2AP.

For every anchor the positives are its best other rows of the same label, and
for every positive the negatives are the best rows of other labels whose score
lies in a window below the positive's.  Scores are integer inner products.
Both searches are joins of a block of anchors with all rows at a threshold per
anchor:

* The inverted index of a block holds, for an anchor, only its leading
  dimensions: the trailing ones are left out as soon as their length times the
  greatest length of any row is below the anchor's threshold.
* Rows accumulate partial scores over the index, some dimensions at a time, and
  a pair is dropped once the partial score plus the product of both remaining
  lengths is below the threshold.  What is left is scored exactly.
* Thresholds start high and are lowered, for the anchors whose windows did not
  fill, until they do or the window's own lower end is reached.  Inside a task
  they rise with the results of the task.

Anchors come in blocks of a bounded number of components (``BLOCK_VALUES``),
which is what is broadcast; every block meets all rows, which are never
shuffled.  A task puts out at most a window's number of rows per window.

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part; a null id is no anchor and comes after other ids;
repeated rows are rows of their own, and only the anchor's own row is not
"other"; shorter vectors are as if filled up with zeros; vectors so long that a
score could leave 64 bits raise an error; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesweft.session import written

POSITIVES = 5
NEGATIVES = 3
LOW_PERCENT, HIGH_PERCENT = 50, 95
BLOCK_ANCHORS = 8192
BLOCK_VALUES = 1 << 22
CELLS = 1 << 19
SLICES = 8
# A share of pairs below which single pairs are cheaper than whole matrices.
SPARSE = 0.03
# Thresholds of the first search as shares of |anchor| * mean length; then none.
SAME_STEPS = (0.7, 0.4, 0.1)
# Parts of a negative window, from its upper end.
WINDOW_STEPS = (0.2, 0.5, 1.0)
NONE = -(1 << 62)
FOUND = "anchor int, slot int, id long, row long, score long"


def quantised(vector: Column | str, scale: int = 256) -> Column:
    """floor(scale * component), from doubles."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column | str) -> Column:
    """Neither null nor with a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as the rows of a matrix, shorter ones filled with zeros."""
    sizes = column.value_lengths().to_numpy()
    values = column.flatten().to_numpy()
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out[owner, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _rest_lengths(vectors: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The length of what lies behind each cut, per vector."""
    squares = vectors.astype(np.float64) ** 2
    sums = np.stack([squares[:, a:b].sum(axis=1) for a, b in zip(cuts[:-1], cuts[1:])] + [np.zeros(len(vectors))], axis=1)
    return np.sqrt(sums[:, ::-1].cumsum(axis=1)[:, ::-1]) * (1 + 1e-9)


@dataclass
class Join:
    """A block of anchors with the windows to fill: scores of low to high per anchor and slot."""

    vectors: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    low: np.ndarray
    high: np.ndarray
    count: int
    same: bool
    longest: float

    def ordered(self) -> tuple[np.ndarray, np.ndarray]:
        """The dimensions by falling energy, and the cuts between slices of them."""
        energy = (self.vectors.astype(np.float64) ** 2).sum(axis=0)
        width = self.vectors.shape[1]
        return np.argsort(-energy, kind="stable"), np.unique(np.linspace(0, width, min(SLICES, max(1, width)) + 1).astype(int))

    def index_ends(self, rest: np.ndarray, threshold: np.ndarray) -> np.ndarray:
        """Per anchor the number of slices that its index holds."""
        covered = rest * self.longest < threshold[:, None]
        return np.where(covered.any(axis=1), covered.argmax(axis=1), rest.shape[1] - 1)


def _reaching(rows: np.ndarray, anchors: np.ndarray, rows_rest: np.ndarray, anchors_rest: np.ndarray, cuts: np.ndarray, ends: np.ndarray, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (row, anchor) whose score reaches the anchor's threshold, and the scores."""
    partial = np.zeros((len(rows), len(anchors)), rows.dtype)
    last = len(cuts) - 1
    alive = np.broadcast_to(ends > 0, partial.shape)
    done = 0
    while done < last and (ends > done).any():
        indexed = np.flatnonzero(ends > done)
        a, b = cuts[done], cuts[done + 1]
        if len(indexed) == len(anchors):
            partial += rows[:, a:b] @ anchors[:, a:b].T
        else:
            partial[:, indexed] += rows[:, a:b] @ anchors[indexed, a:b].T
        done += 1
        at = np.minimum(ends, done)
        left = rows_rest[:, at] * anchors_rest[np.arange(len(anchors)), at]
        alive = (partial + left >= threshold) & (ends > 0)
        if np.count_nonzero(alive) < SPARSE * alive.size:
            break
    row, anchor = np.nonzero(alive)
    score = partial[row, anchor]
    rough = np.flatnonzero(np.minimum(ends[anchor], done) < last)
    for start in range(0, len(rough), 16384):
        part = rough[start : start + 16384]
        score[part] = np.einsum("ij,ij->i", rows[row[part]], anchors[anchor[part]])
    reached = score >= threshold[anchor]
    return row[reached], anchor[reached], score[reached].astype(np.int64)


def _first(anchor: np.ndarray, count: int) -> np.ndarray:
    """The first ``count`` places of every run of equal values."""
    new = np.ones(len(anchor), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    starts = np.flatnonzero(new)
    return np.flatnonzero(np.arange(len(anchor)) - np.repeat(starts, np.diff(np.append(starts, len(anchor)))) < count)


class Kept:
    """The best rows of a task per window."""

    def __init__(self, join: Join) -> None:
        self.join = join
        self.low = join.low.copy()
        self.held = {k: np.zeros(0, np.int64) for k in ("window", "score", "id", "unknown", "row")}

    def add(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, unknown: np.ndarray, row: np.ndarray) -> None:
        slots = self.low.shape[1]
        fits = [np.flatnonzero((score >= self.low[anchor, s]) & (score <= self.join.high[anchor, s])) for s in range(slots)]
        if not any(len(f) for f in fits):
            return
        at = np.concatenate(fits)
        new = {"window": np.concatenate([anchor[f] * slots + s for s, f in enumerate(fits)]), "score": score[at], "id": ids[at], "unknown": unknown[at], "row": row[at]}
        both = {k: np.concatenate([self.held[k], new[k]]) for k in self.held}
        order = np.lexsort((both["row"], both["id"], both["unknown"], -both["score"], both["window"]))
        best = order[_first(both["window"][order], self.join.count)]
        self.held = {k: v[best] for k, v in both.items()}
        window = self.held["window"]
        full = np.flatnonzero(np.bincount(window, minlength=self.low.size)[window] == self.join.count)
        worst = np.full(self.low.size, 1 << 62, np.int64)
        np.minimum.at(worst, window[full], self.held["score"][full])
        worst = worst.reshape(self.low.shape)
        self.low = np.where(worst < (1 << 62), np.maximum(self.low, worst), self.low)

    def batch(self) -> pa.RecordBatch:
        slots = self.low.shape[1]
        ids = pa.array(self.held["id"], mask=self.held["unknown"].astype(bool))
        window = self.held["window"]
        return pa.RecordBatch.from_arrays(
            [pa.array((window // slots).astype(np.int32)), pa.array((window % slots).astype(np.int32)), ids, pa.array(self.held["row"]), pa.array(self.held["score"])],
            names=["anchor", "slot", "id", "row", "score"],
        )


def _joined(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join: Join = sent.value
        dims, cuts = join.ordered()
        # Products of doubles are exact while no score can reach 2**53.
        kind = np.float64 if join.longest**2 < 2**53 else np.int64
        anchors = join.vectors[:, dims].astype(kind)
        rest = _rest_lengths(anchors, cuts)
        kept = Kept(join)
        for batch in batches:
            vectors = _matrix(batch.column("vector"), len(dims))[:, dims].astype(kind)
            unknown = batch.column("id").is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = batch.column("id").fill_null(0).to_numpy()
            number, label = batch.column("row").to_numpy(), batch.column("label").to_numpy()
            for first in range(0, len(anchors), 1024):
                some = slice(first, min(len(anchors), first + 1024))
                step = max(1, CELLS // (some.stop - some.start))
                for start in range(0, len(vectors), step):
                    part = slice(start, start + step)
                    threshold = kept.low[some].min(axis=1)
                    ends = join.index_ends(rest[some], threshold)
                    row, anchor, score = _reaching(vectors[part], anchors[some], _rest_lengths(vectors[part], cuts), rest[some], cuts, ends, threshold)
                    row, anchor = row + start, anchor + first
                    wanted = (label[row] == join.labels[anchor]) == join.same
                    wanted &= number[row] != join.rows[anchor]
                    row, anchor, score = row[wanted], anchor[wanted], score[wanted]
                    kept.add(anchor, score, ids[row], unknown[row], number[row])
        if len(kept.held["window"]):
            yield kept.batch()

    return run


def _filled(vectors: DataFrame, join: Join, lows: list[np.ndarray]) -> DataFrame:
    """The best rows of every window, from joins at falling thresholds (arrays like ``join.low``).

    Each round joins only the anchors with a window that is not full yet and
    takes over the rows of the windows that are full or whole after it.
    """
    open_anchors = np.flatnonzero((join.low <= join.high).any(axis=1))
    rounds: list[DataFrame] = []
    taken = join.low > join.high
    context = vectors.sparkSession.sparkContext
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    for step, low in enumerate(lows):
        if not len(open_anchors):
            break
        # Windows that are done already ask for nothing.
        wanted = np.where(taken, 1 << 62, np.maximum(low, join.low))[open_anchors]
        part = Join(join.vectors[open_anchors], join.rows[open_anchors], join.labels[open_anchors], wanted, join.high[open_anchors], join.count, join.same, join.longest)
        found = vectors.select("row", "id", "label", "vector").mapInArrow(_joined(context.broadcast(part)), FOUND)
        best = written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= join.count), "negatives-round")
        sizes = np.zeros(wanted.shape, np.int64)
        for r in best.groupBy("anchor", "slot").agg(F.count("*").alias("n")).collect():
            sizes[r["anchor"], r["slot"]] = r["n"]
        complete = (sizes == join.count) | (wanted <= join.low[open_anchors])
        complete &= ~taken[open_anchors]
        names = [(int(i), int(s), int(open_anchors[i])) for i, s in zip(*np.nonzero(complete & (sizes > 0)))]
        if names:
            done = vectors.sparkSession.createDataFrame(names, "anchor int, slot int, number int")
            rounds.append(best.join(F.broadcast(done), ["anchor", "slot"]).select(F.col("number").alias("anchor"), "slot", "id", "row", "score", "rank"))
        taken[open_anchors] |= complete
        open_anchors = open_anchors[~taken[open_anchors].all(axis=1)]
    if not rounds:
        return vectors.sparkSession.createDataFrame([], FOUND + ", rank int")
    return reduce(DataFrame.unionByName, rounds)


def _block(vectors: DataFrame, anchors: list, width: int, longest: float, mean: float, positives: int, negatives: int, percents: tuple[int, int]) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores for one block of anchors."""
    matrix = np.zeros((len(anchors), width), np.int64)
    for i, r in enumerate(anchors):
        matrix[i, : len(r["vector"])] = r["vector"]
    rows, labels = np.array([r["row"] for r in anchors], np.int64), np.array([r["label"] for r in anchors])
    length = np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1))
    n = len(anchors)
    every = Join(matrix, rows, labels, np.full((n, 1), NONE, np.int64), np.full((n, 1), 1 << 62, np.int64), positives, True, longest)
    steps = [np.ceil(f * length * mean).astype(np.int64)[:, None] for f in SAME_STEPS] + [every.low]
    near = _filled(vectors, every, steps).select("anchor", "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = near.collect()
    low, high = np.full((n, positives), 1 << 62, np.int64), np.full((n, positives), NONE, np.int64)
    for r in found:
        score = r["positive_score"]
        low[r["anchor"], r["rank"] - 1] = -((-percents[0] * score) // 100)
        high[r["anchor"], r["rank"] - 1] = (percents[1] * score) // 100
    # With bounds of rising percent, negative scores leave no window.
    low[low > high] = 1 << 62
    high[low > high] = NONE
    windows = Join(matrix, rows, labels, low, high, negatives, False, longest)
    some = low <= high
    size = np.where(some, high - np.where(some, low, 0), 0)
    steps = [np.where(some, np.floor(high - f * size), low).astype(np.int64) if f < 1 else low for f in WINDOW_STEPS]
    hard = _filled(vectors, windows, steps)
    named = vectors.sparkSession.createDataFrame(
        [(r["anchor"], r["rank"] - 1, anchors[r["anchor"]]["id"], r["positive_id"], r["positive_score"]) for r in found],
        "anchor int, slot int, anchor_id long, positive_id long, positive_score long",
    )
    return hard.join(F.broadcast(named), ["anchor", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mined(rows: DataFrame, is_anchor: Column, id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES, percents: tuple[int, int] = (LOW_PERCENT, HIGH_PERCENT), scale: int = 256) -> DataFrame:
    """The negatives of every anchor and positive; ``is_anchor`` is a condition on the rows.

    Ids are whole numbers, labels are compared as they are.
    """
    spark = rows.sparkSession
    kept = rows.where(F.col(label_column).isNotNull() & usable(vector_column)).select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), quantised(vector_column, scale).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"), F.monotonically_increasing_id().alias("row"),
    )
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    vectors = written(kept.withColumn("length", F.sqrt(squares)), "negatives-vectors")
    count, width, longest, mean = vectors.agg(
        F.count(F.when(F.col("is_anchor"), 1)), F.max(F.size("vector")), F.max("length"), F.avg("length")
    ).first()
    if not count:
        return spark.createDataFrame([], RESULT)
    if longest * longest >= 2**62 / max(LOW_PERCENT, HIGH_PERCENT, *percents):
        raise ValueError("components are too large for scores of 64 bits")
    most = max(1, min(BLOCK_ANCHORS, BLOCK_VALUES // max(1, width)))
    blocks = math.ceil(2 * count / most) if count > most else 1
    results = []
    for b in range(blocks):
        block = vectors.where("is_anchor").where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).select("id", "label", "vector", "row").orderBy("row").collect()
        if block:
            results.append(_block(vectors, block, width, longest, mean, positives, negatives, percents))
    return reduce(DataFrame.unionByName, results)
