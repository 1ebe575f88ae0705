"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, everything else in ASCII counts as a blank.  Counts
per language and bucket come from at most about ``rows_per_language`` training
documents of each language, chosen by a hash of the id; they are summed by
Spark.  The log-probability matrix (``2**BITS`` times the languages, 256 KB for
each) is broadcast, and whole texts are scored in numpy batches.  Every language
is learned; more than ``MAX_LANGUAGES``, which the matrix would be too large
for, raise an error.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
ties go to the first language in order; without training rows every text is
``und``; rows of null language are predicted but not learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesweft.llm import hashing
from salesweft.llm.columns import fold, spread

BITS = 16
SIZES = (1, 2, 3)
ROWS_PER_LANGUAGE = 2500
MAX_LANGUAGES = 512
SMOOTHING = 0.5
SLICE_BYTES = 1 << 19
UNKNOWN = "und"

_PLAIN = np.arange(128, dtype=np.uint32)
_PLAIN[[c for c in range(128) if not chr(c).isalpha()]] = 32


def ngram_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every character n-gram."""
    lengths = pa.compute.utf8_length(texts).to_numpy(zero_copy_only=False)
    codes = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    small = codes < 128
    codes = np.where(small, _PLAIN[np.where(small, codes, 0)], codes).astype(np.uint64)
    doc = np.repeat(np.arange(len(texts)), lengths)
    letter = codes != 32
    found, owner = [], []
    for n in SIZES:
        grams, of = hashing.grams(codes, doc, n)
        some = hashing.grams(letter.astype(np.uint64), doc, n)[0] != hashing.grams(np.zeros(n, np.uint64), np.zeros(n, int), n)[0][0]
        found.append((hashing.mix(grams[some] + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64))
        owner.append(of[some])
    return np.concatenate(owner), np.concatenate(found)


def _prepared(part: pa.RecordBatch) -> pa.Array:
    return pa.compute.utf8_lower(pa.compute.fill_null(part.column("text").cast(pa.large_string()), ""))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in hashing.slices(batch, "text", SLICE_BYTES):
            owner, found = ngram_buckets(_prepared(part))
            names = part.column("lang").to_pylist()
            order = sorted(set(names))
            which = np.array([order.index(x) for x in names])[owner]
            counts = np.bincount(which << BITS | found, minlength=len(order) << BITS).reshape(len(order), -1)
            for name, row in zip(order, counts):
                totals[name] = totals.get(name, 0) + row
    for name, row in totals.items():
        used = np.flatnonzero(row)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(used)), pa.array(used, pa.int32()), pa.array(row[used], pa.int64())], names=["lang", "bucket", "n"])


@dataclass(frozen=True)
class Model:
    """Languages and, per bucket, their log probabilities; the last row is the prior."""

    languages: list[str]
    logs: np.ndarray


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", language: str = "lang", rows: int = ROWS_PER_LANGUAGE) -> Model:
    """Fit on the rows of known language."""
    known = docs.where(F.col(language).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(language).alias("lang")
    )
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the broadcast matrix holds 256 KB for each")
    if not counts:
        return Model([], np.zeros(((1 << BITS) + 1, 0), np.float32))
    rate = reduce(lambda c, r: c.when(F.col("lang") == r["lang"], F.lit(rows / r["n"])), counts, F.when(F.lit(False), F.lit(0.0)))
    sample = known.where(spread(F.lit(4), "id") < F.coalesce(rate, F.lit(0.0))).select("text", "lang")
    sums = sample.mapInArrow(_counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(set(sums["lang"]))
    logs = np.full(((1 << BITS) + 1, len(names)), SMOOTHING)
    logs[sums["bucket"].to_numpy(dtype=np.int64), np.searchsorted(names, sums["lang"])] += sums["n"].to_numpy()
    logs[:-1] = np.log(logs[:-1] / logs[:-1].sum(axis=0))
    seen = {r["lang"]: r["n"] for r in counts}
    logs[-1] = np.log([seen[x] for x in names])
    return Model(names, logs.astype(np.float32))


def predictions(texts: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """The likeliest language and its posterior probability for each (lower-case) text."""
    letters = pa.compute.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    owner, found = ngram_buckets(texts)
    totals = np.stack([np.bincount(owner, weights=column[found], minlength=len(texts)) for column in model.logs[:-1].T], axis=1)
    totals += model.logs[-1]
    best = totals.argmax(axis=1)
    score = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
    return [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)], np.where(letters, score, 0.0)


def identified(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in hashing.slices(batch, "text", SLICE_BYTES):
                names, score = predictions(_prepared(part), sent.value)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def language_ids(docs: DataFrame) -> DataFrame:
    """Predictions for all documents, learned from the folds that are not held out."""
    held = fold(F.col("doc_id"), 5) == 0
    model = train(docs.where(~held))
    out = identified(docs, model)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
