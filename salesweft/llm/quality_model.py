"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL.

Tokens are runs of letters and digits, and runs of punctuation.  Features are
hashed 1- and 2-grams of the lower-case tokens, 1- to 3-grams of token shapes,
and repeated neighbours; each family's counts are divided by its size.

Training follows the regularised leader (FTRL-proximal) in ``SHARDS`` parallel
shards; the weights of those that have rows are averaged.  It uses at most about ``max_rows`` labelled
rows, chosen by a hash of the id; scoring reads every whole text and is a
sparse dot product with the broadcast weights (``2**BITS`` floats).

Defined cases: a null or empty text has no features and gets the bias's score;
null labels are skipped and conflicting labels of one id are averaged; without
labelled rows every score is 0.5; labels, language, source and id are not
features.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesweft.llm import hashing
from salesweft.llm.columns import fold, spread
from salesweft.session import written

BITS = 18
SHARDS = 8
MAX_ROWS = 24_000
EPOCHS = 3
SCALE = 8.0

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_UPPER, _SMALL, _DIGIT, _WORD = np.zeros((4, 256), bool)
_UPPER[65:91] = True
_SMALL[97:123] = True
_DIGIT[48:58] = True
_WORD[:] = _UPPER | _SMALL | _DIGIT
_WORD[128:] = True
_MARK = ~_WORD & ~hashing.BLANK


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token its text, its hash and its shape's hash, in text order."""
    raw, bounds = hashing.text_bytes(texts)
    word, mark = hashing.spans(_WORD[raw], bounds), hashing.spans(_MARK[raw], bounds)
    starts, ends = np.concatenate([word[0], mark[0]]), np.concatenate([word[1], mark[1]])
    is_word = np.arange(len(starts)) < len(word[0])
    order = np.argsort(starts, kind="stable")
    starts, ends, is_word = starts[order], ends[order], is_word[order]
    hashes = hashing.span_hashes(_LOWER[raw], starts, ends)

    def within(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[raw], dtype=np.int64)])
        return sums[ends] - sums[starts]

    upper = within(_UPPER)
    kind = 1 + (upper > 0) + 2 * (upper > 1) + 4 * (within(_SMALL) > 0) + 8 * (within(_DIGIT) > 0)
    shapes = np.where(is_word, kind.astype(np.uint64), hashes)
    return hashing.owners(starts, bounds), hashes, hashing.mix(shapes + np.uint64(1 << 32))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) triples; features of one text may repeat."""
    doc, words, shapes = _tokens(texts)
    families = [hashing.grams(words, doc, n) for n in (1, 2)] + [hashing.grams(shapes, doc, n) for n in (1, 2, 3)]
    if len(words) > 1:
        inside = doc[1:] == doc[:-1]
        families.append((np.where(words[1:] == words[:-1], np.uint64(1), np.uint64(2))[inside], doc[1:][inside]))
    found, owner, value = [], [], []
    for salt, (grams, of) in enumerate(families):
        sizes = np.bincount(of, minlength=len(texts))
        found.append(hashing.mix(grams ^ np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(64 - BITS))
        owner.append(of)
        value.append(SCALE / np.maximum(sizes, 1)[of])
    return np.concatenate(owner), np.concatenate(found).astype(np.int64), np.concatenate(value)


def _sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in hashing.slices(batch, "text"):
            owner, found, value = features(part.column("text"))
            keys, inverse = np.unique(owner * (1 << BITS) + found, return_inverse=True)
            sums = np.bincount(inverse, weights=value, minlength=len(keys)).astype(np.float32)
            cuts = np.searchsorted(keys >> BITS, np.arange(part.num_rows + 1))
            index = (keys & ((1 << BITS) - 1)).astype(np.int32)
            rows = [slice(cuts[i], cuts[i + 1]) for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [part.column("shard"), part.column("place"), part.column("label"),
                 pa.array([index[r].tobytes() for r in rows], pa.binary()), pa.array([sums[r].tobytes() for r in rows], pa.binary())],
                names=["shard", "place", "label", "index", "value"],
            )


def ftrl(rows: list[tuple[float, np.ndarray, np.ndarray]], epochs: int = EPOCHS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05) -> np.ndarray:
    """Weights after FTRL-proximal updates over (label, index, value) rows; the last weight is the bias."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(at):
        s = z[at]
        return np.where(np.abs(s) <= l1, 0.0, (np.sign(s) * l1 - s) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for label, index, value in rows:
            at, x = np.append(index, 1 << BITS), np.append(value, 1.0)
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    return weights(np.arange((1 << BITS) + 1))


def _train_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("place")
    parsed = [(y, np.frombuffer(i, np.int32), np.frombuffer(v, np.float32)) for y, i, v in zip(rows["label"], rows["index"], rows["value"])]
    w = ftrl(parsed)
    used = np.flatnonzero(w)
    return pd.DataFrame({"feature": used, "weight": w[used]})


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", max_rows: int = MAX_ROWS) -> np.ndarray:
    """Averaged weights of all shards; the last one is the bias."""
    known = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(F.avg(label_column).alias("label"))
    total = known.count()
    if not total:
        return np.zeros((1 << BITS) + 1)
    chosen = lambda c: spread(F.lit(1), c) < max_rows / total
    rows = (
        docs.where(chosen(F.col(id_column))).select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
        .join(known.where(chosen(F.col("id"))), "id")
        .select(F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(SHARDS)).alias("shard"), F.xxhash64(F.lit(3), "id", "text").alias("place"), "label", "text")
    )
    sparse = written(rows.mapInArrow(_sparse_rows, "shard long, place long, label double, index binary, value binary"), "quality-sample")
    shards = sparse.groupBy("shard").applyInPandas(_train_shard, "feature int, weight double")
    used = max(1, sparse.select("shard").distinct().count())
    mean = shards.groupBy("feature").agg((F.sum("weight") / used).alias("weight")).toPandas()
    weights = np.zeros((1 << BITS) + 1)
    weights[mean["feature"].to_numpy(dtype=np.int64)] = mean["weight"].to_numpy()
    return weights


def scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """The probability of label 1 for each text."""
    owner, found, value = features(texts)
    total = np.bincount(owner, weights=weights[found] * value, minlength=len(texts)) + weights[-1]
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def scored(docs: DataFrame, weights: np.ndarray, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """The documents with a score column behind all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    schema = docs.withColumn(score_column, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in hashing.slices(batch, text_column):
                yield part.append_column(score_column, pa.array(scores(part.column(text_column), sent.value), pa.float64()))

    return docs.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for all documents, trained on the folds that are not held out."""
    held = fold(F.col("doc_id"), 3) == 1
    weights = train(docs, labels.where(~held))
    out = scored(docs.select("doc_id", held.alias("held_out"), "text"), weights)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
