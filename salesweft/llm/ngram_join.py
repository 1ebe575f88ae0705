"""Similarity join on word n-gram sets with Bayesian candidate pruning.

Documents are compared by the Jaccard similarity of their sets of 5-word
shingles; pairs of at least 0.8 are linked.  Steps:

1. One pass makes, per document, a key of its shingle set and 128 MinHash
   values of 16 bits.  Documents of equal sets form one class.
2. Classes that share all four values of one of 32 bands are candidates (a
   pair of similarity 0.8 is missed with probability 5e-8).  Of buckets with
   equal members one is kept.
3. Pairs of a bucket compare MinHash values 16 at a time; a pair is dropped
   once the posterior probability (uniform prior) of reaching the threshold
   falls below ``TOLERANCE``.  Tasks put out a spanning forest of the pairs
   that are left, never the pairs.
4. Within a component of those forests all pairs are pruned the same way and
   the rest are verified on the full shingle sets.  Tasks put out link counts
   and a spanning forest of the verified links.

Buckets and components beyond a block's size are split into pairs of blocks,
each of which is a task's unit; no group is gathered whole.

Defined cases: a null or empty text has no shingles and links to nothing; a
text of fewer than five words has one shingle of all its words; repeated rows
and equal texts are links of each other; null ids are documents like others
(the class id is the smallest id that is not null); an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesweft.llm import hashing
from salesweft.llm.components import connected
from salesweft.session import written

THRESHOLD = 0.8
WORDS = 5
VALUES = 128
BANDS = 32
STEP = 16
TOLERANCE = 1e-6
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 500_000
PAIRS = 1 << 18
ROW = "__ngram_join_row"

_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDED = _RANDOM.integers(0, 1 << 63, VALUES, dtype=np.uint64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After n compared values, the matches below which a pair is dropped.

    With a uniform prior the posterior of the agreement rate after m of n
    matches is Beta(m+1, n-m+1), and the chance that it reaches t is that of
    at most m successes in n+1 trials of rate t.
    """
    out = {}
    for n in range(STEP, VALUES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance and m < n:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in hashing.slices(batch, "text"):
            found, bounds = hashing.shingles(part.column("text"), WORDS)
            sizes = np.diff(bounds)
            some = np.flatnonzero(sizes)
            starts = bounds[:-1][some]
            keys = np.zeros((part.num_rows, 2), np.uint64)
            values = np.zeros((part.num_rows, VALUES), np.uint16)
            if len(some):
                keys[some, 0] = np.add.reduceat(hashing.mix(found), starts)
                keys[some, 1] = np.add.reduceat(hashing.mix(found ^ np.uint64(0x5851F42D4C957F2D)), starts)
                for k in range(VALUES):
                    values[some, k] = hashing.mix(np.minimum.reduceat(found * _FACTORS[k] + _ADDED[k], starts)) >> np.uint64(48)
            filled = sizes > 0
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("row"), pa.array([k.tobytes() if f else None for k, f in zip(keys, filled)], pa.binary()),
                 pa.array(sizes, pa.int32()), pa.array([v.tobytes() if f else None for v, f in zip(values, filled)], pa.binary())],
                names=["id", "row", "key", "n", "values"],
            )


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in hashing.slices(batch, "text"):
            found, bounds = hashing.shingles(part.column("text"), WORDS)
            mixed, other = hashing.mix(found), hashing.mix(found ^ np.uint64(0x5851F42D4C957F2D))
            rows = [slice(bounds[i], bounds[i + 1]) for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.array([mixed[r].sum(), other[r].sum()], np.uint64).tobytes() for r in rows], pa.binary()),
                 pa.array([found[r].tobytes() for r in rows], pa.binary())],
                names=["key", "shingles"],
            )


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int) -> Iterator[pa.Table]:
    """Sorted batches cut between groups, into tables of about ``most`` rows; a group is never cut."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def cut(table: pa.Table) -> tuple[pa.Table, pa.Table]:
        last = np.ones(table.num_rows, bool)
        for key in keys:
            column = table.column(key).to_numpy()
            last &= column == column[-1]
        first = int(np.argmax(last)) if last.any() else table.num_rows
        return table.slice(0, first), table.slice(first)

    for batch in batches:
        for start in range(0, batch.num_rows, most):
            piece = batch.slice(start, most)
            held.append(piece)
            rows += piece.num_rows
            if rows >= most:
                done, rest = cut(pa.Table.from_batches(held))
                held, rows = rest.to_batches(), rest.num_rows
                if done.num_rows:
                    yield done
    if rows:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


class Forest:
    """Union of rows over arrays of pairs."""

    def __init__(self, rows: int) -> None:
        self.root = np.arange(rows)

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        if not len(left):
            return
        left, right = self.root[left], self.root[right]
        parent = np.arange(len(self.root))
        while True:
            least = np.minimum(parent[left], parent[right])
            np.minimum.at(parent, left, least)
            np.minimum.at(parent, right, least)
            parent = parent[parent]
            if (parent[left] == parent[right]).all():
                break
        while (parent[parent] != parent).any():
            parent = parent[parent]
        self.root = parent[self.root]


def _pairs(table: pa.Table, group: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of each unit of work, some at a time: all of a block, or those across two blocks."""
    keys = np.stack([table.column(c).to_numpy() for c in (group, "lo", "hi")])
    block, lo, hi = table.column("block").to_numpy(), keys[1], keys[2]
    new = np.ones(table.num_rows + 1, bool)
    new[1:-1] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    ends = np.flatnonzero(new)
    end = ends[np.searchsorted(ends, np.arange(table.num_rows), side="right")]
    counts = end - np.arange(table.num_rows) - 1
    sums = np.cumsum(counts)
    start = 0
    while start < len(counts):
        stop = max(start + 1, int(np.searchsorted(sums, (sums[start - 1] if start else 0) + PAIRS, side="right")))
        part = counts[start:stop]
        left = np.repeat(np.arange(start, stop), part)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(part) - part, part)
        wanted = (lo[left] == hi[left]) | (block[left] != block[right])
        yield left[wanted], right[wanted]
        start = stop


def _likely(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, values: np.ndarray, least: dict[int, int], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that the sizes allow and that no comparison step drops."""
    a, b = sizes[left], sizes[right]
    fits = np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9
    left, right = left[fits], right[fits]
    matches = np.zeros(len(left), np.int32)
    for n in range(STEP, VALUES + 1, STEP):
        if not len(left):
            break
        matches += (values[left, n - STEP : n] == values[right, n - STEP : n]).sum(axis=1, dtype=np.int32)
        stay = matches >= least[n]
        left, right, matches = left[stay], right[stay], matches[stay]
    return left, right


def _candidate_forest(threshold: float, tolerance: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = least_matches(threshold, tolerance)
        for table in _groups(batches, ["bucket", "lo", "hi"], 8192):
            sizes, values = table.column("n").to_numpy(), _matrix(table.column("values"), np.uint16, VALUES)
            cid, forest = table.column("cid").to_numpy(), Forest(table.num_rows)
            for left, right in _pairs(table, "bucket"):
                forest.join(*_likely(left, right, sizes, values, least, threshold))
            moved = np.flatnonzero(forest.root != np.arange(table.num_rows))
            yield pa.RecordBatch.from_arrays([pa.array(cid[moved]), pa.array(cid[forest.root[moved]])], names=["a", "b"])

    return run


def _common(left: np.ndarray, right: np.ndarray, found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs' sorted sets."""
    first, last = int(left.min()), int(right.max()) + 1
    if len(left) < 16 * (last - first):
        return np.array([
            len(np.intersect1d(found[bounds[a] : bounds[a + 1]], found[bounds[b] : bounds[b + 1]], assume_unique=True)) for a, b in zip(left, right)
        ])
    # Many pairs among few rows: products of 0/1 matrices, some columns at a time.
    names, column, counts = np.unique(found[bounds[first] : bounds[last]], return_inverse=True, return_counts=True)
    rank = np.cumsum(counts > 1) - 1
    shared = counts[column] > 1
    owner = np.repeat(np.arange(last - first), np.diff(bounds[first : last + 1]))[shared]
    column = rank[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    sums = np.zeros((last - first, last - first), np.float32)
    for start in range(0, int((counts > 1).sum()), 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        x = np.zeros((last - first, 4096), np.float32)
        x[owner[a:b], column[a:b] - start] = 1
        sums += x @ x.T
    return sums[left - first, right - first].astype(np.int64)


def _verified_forest(threshold: float, tolerance: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = least_matches(threshold, tolerance)
        for table in _groups(batches, ["component", "lo", "hi"], 512):
            sizes, values = table.column("n").to_numpy(), _matrix(table.column("values"), np.uint16, VALUES)
            cid, members = table.column("cid").to_numpy(), table.column("members").to_numpy()
            sets = table.column("shingles").to_pylist()
            bounds = np.concatenate([[0], np.cumsum([len(s) // 8 for s in sets])])
            found = np.frombuffer(b"".join(sets), np.uint64)
            forest, links = Forest(table.num_rows), np.zeros(table.num_rows, np.int64)
            for left, right in _pairs(table, "component"):
                left, right = _likely(left, right, sizes, values, least, threshold)
                if not len(left):
                    continue
                common = _common(left, right, found, bounds)
                linked = common >= threshold * (sizes[left].astype(np.int64) + sizes[right] - common) - 1e-9
                left, right = left[linked], right[linked]
                forest.join(left, right)
                np.add.at(links, left, members[right])
                np.add.at(links, right, members[left])
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(cid[some]), pa.array(cid[forest.root[some]]), pa.array(links[some])], names=["cid", "root", "links"])

    return run


def _blocks(rows: DataFrame, group: str, count: str) -> DataFrame:
    """Each row once per unit it takes part in: ``count`` blocks make pairs (lo, hi)."""
    placed = rows.withColumn("block", F.pmod(F.xxhash64("cid", group), F.col(count)).cast("int"))
    return placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col(count).cast("int") - 1))).select(
        *[c for c in placed.columns if c != count], F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi")
    )


def _dealt(rows: DataFrame, group: str) -> DataFrame:
    keys = [group, "lo", "hi"]
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def joined(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", row: str | None = None, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """Per document: doc_id, class_id (smallest id of its group of linked documents), n_links, kept and row."""
    narrow = docs.select(F.col(id_column).alias("id"), (F.col(row) if row else F.monotonically_increasing_id()).alias("row"), F.col(text_column).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    signed = written(narrow.mapInArrow(_signed, f"id {kind}, row long, key binary, n int, values binary"), "ngram-signatures")
    first = F.struct(F.col("id").isNull().alias("unknown"), "id", "row")
    classes = written(
        signed.where("key IS NOT NULL").groupBy("key")
        .agg(F.min(first).alias("first"), F.count("*").alias("members"), F.min("n").alias("n"), F.min("values").alias("values"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "ngram-classes",
    )
    width = 2 * VALUES // BANDS
    bands = classes.select("cid", F.explode(F.array(*[F.xxhash64(F.lit(b), F.substring("values", 1 + b * width, width)) for b in range(BANDS)])).alias("bucket"))
    buckets = bands.groupBy("bucket").agg(F.count("*").alias("rows"), F.bit_xor(F.xxhash64("cid")).alias("f"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("g"))
    buckets = written(buckets.where("rows > 1").groupBy("rows", "f", "g").agg(F.min("bucket").alias("bucket")), "ngram-buckets")
    members = bands.join(buckets.select("bucket", F.ceil(F.col("rows") / BLOCK_ROWS).alias("blocks")), "bucket")
    units = _blocks(members, "bucket", "blocks").join(classes.select("cid", "n", "values"), "cid")
    edges = _dealt(units, "bucket").mapInArrow(_candidate_forest(threshold, tolerance), "a long, b long")
    components = written(connected(edges).select(F.col("node").alias("cid"), "component"), "ngram-components")

    known = classes.join(components, "cid")
    sizes = components.join(classes.select("cid", "n"), "cid").groupBy("component").agg(
        F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_ROWS)).alias("blocks")
    )
    wanted = written(known.select(F.col("first.id").alias("wanted")).distinct(), "ngram-wanted")
    texts = narrow.join(wanted, F.col("id").eqNullSafe(F.col("wanted")), "left_semi").select("text")
    sets = texts.mapInArrow(_shingled, "key binary, shingles binary").dropDuplicates(["key"])
    units = _blocks(known.select("cid", "component", "key", "members", "n", "values").join(sizes, "component").join(sets, "key").drop("key"), "component", "blocks")
    found = written(_dealt(units, "component").mapInArrow(_verified_forest(threshold, tolerance), "cid long, root long, links long"), "ngram-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = written(connected(found.select(F.col("cid").alias("a"), F.col("root").alias("b"))), "ngram-groups")
    firsts = groups.join(classes.select(F.col("cid").alias("node"), "first"), "node").groupBy("component").agg(F.min("first").alias("group_first"))
    linked = groups.join(firsts, "component").select(F.col("node").alias("cid"), "group_first").join(links, "cid", "left")
    known = classes.join(linked, "cid", "left").where("members > 1 OR group_first IS NOT NULL").select(
        "key", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("group_first", "first").alias("keep")
    )
    alone = F.col("keep").isNull()
    return signed.join(known, "key", "left").select(
        F.col("id").alias("doc_id"),
        F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        (alone | (F.col("row") == F.col("keep.row"))).alias("kept"),
        "row",
    )


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents of which no linked document of smaller id stays, with all their columns."""
    numbered = written(docs.withColumn(ROW, F.monotonically_increasing_id()), "ngram-rows")
    dropped = joined(numbered, id_column, text_column, ROW).where(~F.col("kept")).select(F.col("row").alias(ROW))
    return numbered.join(dropped, ROW, "left_anti").select(*docs.columns)
