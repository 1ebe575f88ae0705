"""Ranked lexical search over documents in buckets of impact-vector length.

A document's impact vector has, for every term of the queries that it holds,
the saturated and length-normalised term frequency as an integer; a query's
vector has integer term weights; the score is their inner product.  The search
is that of LEMP:

1. One pass over the whole texts counts the terms that occur in any query,
   and all terms.  Term statistics cover all documents.
2. Vectors are ordered by decreasing length (range partitions, each sorted), so
   any run of rows is a bucket whose first vector is its longest.
3. The first range partition is searched alone; its tenth best scores are the
   first thresholds.  ``|query| * |longest|`` below a query's threshold prunes
   a whole bucket (Cauchy-Schwarz), at the scan by Parquet statistics already.
4. Inside a bucket the heaviest coordinates of the query are accumulated, and
   ``partial + |rest of query| * |rest of vector|`` drops every vector that
   cannot reach the threshold.  What survives is scored exactly in 64-bit
   integers.  Thresholds rise with the results of every bucket.

Bounds carry a slack above the rounding error of doubles, so results are exact.
Queries are taken in blocks of at most about ``BLOCK_ITEMS`` and
``BLOCK_CHARS`` characters; a block's vocabulary is what is broadcast.

Terms are the maximal runs of letters and digits of ASCII and all characters
beyond it; A to Z are lower-cased.  A hash finds a term in the vocabulary, and
its bytes are compared; two query terms of one hash raise an error.

Defined cases: null and empty texts have no terms, do not count and are never
found; a query without terms finds nothing; equal scores come by ascending id,
null ids last, then in row order; repeated documents are found each, repeated
queries are answered each; empty tables give an empty result; extra columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesweft.llm import hashing
from salesweft.session import written

TOP = 10
BLOCK_ITEMS = 2048
BLOCK_CHARS = 4_000_000
RANGE_ROWS = 1 << 18
FOCUS = 8
SLACK = 1 + 1e-9

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = True
_TERM[128:] = True


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start, end and text of every term."""
    raw, bounds = hashing.text_bytes(texts)
    starts, ends = hashing.spans(_TERM[raw], bounds)
    return _LOWER[raw], starts, ends, hashing.owners(starts, bounds)


@dataclass(frozen=True)
class Vocabulary:
    """The distinct terms of a block of queries, in hash order."""

    hashes: np.ndarray
    lengths: np.ndarray
    places: np.ndarray
    data: np.ndarray

    def find(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(span, term number) of the spans that are terms of the vocabulary."""
        if not len(self.hashes) or not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = hashing.span_hashes(raw, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        span = np.flatnonzero((self.hashes[at] == hashes) & (self.lengths[at] == (ends - starts)))
        term = at[span]
        # Equal hashes are taken at their word only after their bytes are compared.
        size = self.lengths[term]
        first = np.cumsum(size) - size
        step = np.arange(int(size.sum())) - np.repeat(first, size)
        unlike = raw[np.repeat(starts[span], size) + step] != self.data[np.repeat(self.places[term], size) + step]
        same = np.add.reduceat(unlike, first) == 0 if len(first) else np.zeros(0, bool)
        return span[same], term[same]


def vocabulary(texts: list[str | None]) -> tuple[Vocabulary, list[np.ndarray]]:
    """The vocabulary of some query texts, and the term numbers of each."""
    raw, starts, ends, owner = _terms(pa.array(texts, pa.large_string()))
    words = [raw[a:b].tobytes() for a, b in zip(starts, ends)]
    hashes = dict(zip(words, hashing.span_hashes(raw, starts, ends).tolist()))
    ordered = sorted(hashes, key=lambda w: (hashes[w], w))
    if len(set(hashes.values())) < len(hashes):
        raise ValueError("two query terms have one hash")
    number = {w: i for i, w in enumerate(ordered)}
    lengths = np.array([len(w) for w in ordered], np.int64)
    held: list[set[int]] = [set() for _ in texts]
    for w, o in zip(words, owner):
        held[o].add(number[w])
    found = Vocabulary(np.array([hashes[w] for w in ordered], np.uint64), lengths, np.cumsum(lengths) - lengths, np.frombuffer(b"".join(ordered), np.uint8))
    return found, [np.array(sorted(h), np.int64) for h in held]


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.array([values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())


def _counted(sent):
    """Per document the number of its terms, and its counts of vocabulary terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Vocabulary = sent.value
        width = max(1, len(known.hashes))
        for batch in batches:
            for part in hashing.slices(batch, "text"):
                raw, starts, ends, owner = _terms(part.column("text"))
                span, term = known.find(raw, starts, ends)
                keys, counts = np.unique(owner[span] * width + term, return_counts=True)
                cuts = np.searchsorted(keys, np.arange(part.num_rows + 1) * width)
                n = np.bincount(owner, minlength=part.num_rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("row"), pa.array(n), _binary((keys % width).astype(np.int32), cuts), _binary(counts.astype(np.int64), cuts)],
                    names=["id", "row", "n", "terms", "counts"],
                )

    return run


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial document frequencies, one row per term and batch."""
    for batch in batches:
        term, df = np.unique(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(df.astype(np.int64))], names=["term", "df"])


def _impacts(n_docs: int, n_terms: int):
    """Impact vectors and their lengths; documents without a vocabulary term have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tf = batch.column("counts").to_pylist()
            sizes = np.array([len(x) // 8 for x in tf], np.int64)
            counts = np.frombuffer(b"".join(tf), np.int64)
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            m = 10 + (90 * batch.column("n").to_numpy() * n_docs) // n_terms
            impact = (1_000_000_000 * counts) // (1000 * counts + 8 * np.repeat(m, sizes))
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            norm = np.sqrt(np.bincount(owner, weights=impact.astype(np.float64) ** 2, minlength=batch.num_rows))
            out = pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), pa.array(norm), batch.column("terms"), _binary(impact, cuts)],
                names=["id", "row", "norm", "terms", "impacts"],
            )
            yield out.filter(pa.array(norm > 0))

    return run


@dataclass
class Search:
    """A block of queries: per query its terms by falling weight, and the score that a result must reach."""

    terms: list[np.ndarray]
    weights: list[np.ndarray]
    thresholds: np.ndarray
    width: int
    top: int

    def lengths(self) -> np.ndarray:
        return np.array([math.sqrt(float((w.astype(np.float64) ** 2).sum())) for w in self.weights])


def _searched(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search: Search = sent.value
        lengths = search.lengths()
        best = np.repeat(search.thresholds[:, None], search.top, axis=1)
        for batch in batches:
            if not batch.num_rows:
                continue
            norm = batch.column("norm").to_numpy()
            longest = float(norm.max())
            # Cauchy-Schwarz: queries that no vector of the bucket can answer.
            wanted = np.flatnonzero(lengths * longest * SLACK >= best[:, -1])
            if not len(wanted):
                continue
            lists = batch.column("terms").to_pylist()
            sizes = np.array([len(x) // 4 for x in lists], np.int64)
            term = np.frombuffer(b"".join(lists), np.int32)
            order = np.argsort(term, kind="stable")
            owner = np.repeat(np.arange(batch.num_rows), sizes)[order]
            impact = np.frombuffer(b"".join(batch.column("impacts").to_pylist()), np.int64)[order]
            cuts = np.searchsorted(term[order], np.arange(search.width + 1))
            place = np.empty(batch.num_rows, np.int64)
            place[pc.sort_indices(batch.select(["id", "row"]), sort_keys=[("id", "ascending"), ("row", "ascending")], null_placement="at_end").to_numpy()] = np.arange(batch.num_rows)
            out: list[tuple[int, np.ndarray, np.ndarray]] = []
            for q in wanted:
                rows, scores = _answers(search.terms[q], search.weights[q], int(best[q, -1]), norm, owner, impact, cuts)
                if not len(rows):
                    continue
                if len(rows) > search.top:
                    chosen = np.lexsort((place[rows], -scores))[: search.top]
                    rows, scores = rows[chosen], scores[chosen]
                best[q] = np.sort(np.concatenate([best[q], scores]))[::-1][: search.top]
                out.append((int(q), rows, scores))
            if out:
                rows = np.concatenate([r for _, r, _ in out])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([np.full(len(r), q, np.int32) for q, r, _ in out])), batch.column("id").take(pa.array(rows)),
                     batch.column("row").take(pa.array(rows)), pa.array(np.concatenate([s for _, _, s in out]))],
                    names=["item", "id", "row", "score"],
                )

    return run


def _answers(terms: np.ndarray, weights: np.ndarray, threshold: int, norm: np.ndarray, owner: np.ndarray, impact: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a bucket whose score reaches the threshold, and their exact scores."""
    score = np.zeros(len(norm), np.int64)
    covered = np.zeros(len(norm))
    for t, w in zip(terms[:FOCUS], weights[:FOCUS]):
        at, x = owner[cuts[t] : cuts[t + 1]], impact[cuts[t] : cuts[t + 1]]
        score[at] += w * x
        covered[at] += x.astype(np.float64) ** 2
    rest = math.sqrt(float((weights[FOCUS:].astype(np.float64) ** 2).sum()))
    # What the other coordinates can add is at most the product of both remaining lengths.
    bound = (score + rest * np.sqrt(np.maximum(norm * norm * SLACK - covered, 0.0))) * SLACK
    alive = bound >= threshold
    if not alive.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    for t, w in zip(terms[FOCUS:], weights[FOCUS:]):
        at, x = owner[cuts[t] : cuts[t + 1]], impact[cuts[t] : cuts[t + 1]]
        stay = alive[at]
        score[at[stay]] += w * x[stay]
    rows = np.flatnonzero(alive & (score >= threshold))
    return rows, score[rows]


def _block(docs: DataFrame, items: list, id_kind: str, top: int) -> DataFrame | None:
    """item number, id, row and score of the best documents of one block of queries."""
    spark = docs.sparkSession
    known, held = vocabulary([r["text"] for r in items])
    if not len(known.hashes):
        return None
    context = spark.sparkContext
    counted = written(docs.mapInArrow(_counted(context.broadcast(known)), f"id {id_kind}, row long, n long, terms binary, counts binary"), "search-counts")
    n_docs, n_terms = counted.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    df = np.zeros(len(known.hashes), np.int64)
    for r in counted.select("terms").mapInArrow(_holders, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in df], np.int64)
    falling = [h[np.lexsort((h, -weight[h]))] for h in held]
    search = Search(falling, [weight[h] for h in falling], np.ones(len(items), np.int64), len(known.hashes), top)

    vectors = counted.mapInArrow(_impacts(n_docs, n_terms), f"id {id_kind}, row long, norm double, terms binary, impacts binary")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_docs // RANGE_ROWS))
    ordered = vectors.repartitionByRange(ranges, F.desc("norm"), F.xxhash64("row")).sortWithinPartitions(F.desc("norm"))
    ordered = written(ordered.withColumn("range", F.spark_partition_id()), "search-vectors")
    kind = f"item int, id {id_kind}, row long, score long"

    def found(part: DataFrame, purpose: str) -> DataFrame:
        return written(part.select("id", "row", "norm", "terms", "impacts").mapInArrow(_searched(context.broadcast(search)), kind), purpose)

    first = found(ordered.where("range = 0"), "search-first")
    for r in best(first, top).groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("score")).where(F.col("n") == top).collect():
        search.thresholds[r["item"]] = r["score"]
    lengths = search.lengths()
    needed = min((float(t) / x for t, x in zip(search.thresholds, lengths) if x), default=math.inf) / SLACK
    return first.unionByName(found(ordered.where((F.col("range") > 0) & (F.col("norm") >= needed)), "search-rest"))


def best(found: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` rows of every item, ranked."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def ranked(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of every item's ``top`` documents with a score above 0."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_column).alias("text"))
    asked = written(items.select(F.col(item_column).alias("item_id"), F.col(item_text).alias("text"), F.monotonically_increasing_id().alias("query")), "search-items")
    count, chars = asked.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-count // BLOCK_ITEMS), -(-chars // BLOCK_CHARS))
    id_kind, item_kind = texts.schema["id"].dataType, asked.schema["item_id"].dataType
    results = []
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b).orderBy("query").collect()
        found = _block(texts, rows, id_kind.simpleString(), top) if rows else None
        if found is not None:
            names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item int, item_id {item_kind.simpleString()}")
            results.append(best(found, top).join(F.broadcast(names), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score"))
    if not results:
        empty = f"item_id {item_kind.simpleString()}, rank int, doc_id {id_kind.simpleString()}, score long"
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, results)
