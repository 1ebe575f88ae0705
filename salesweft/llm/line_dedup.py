"""Line deduplication by pairwise alignment of overlapping documents.

A line is a part of a text that ends at a line break or, with ``sentences``,
also after a full stop, question or exclamation mark before a blank; lines
without a word do not count.  Documents are in order of their id.

1. One pass hashes the lines of every document (a narrow profile per text).
2. Windows of consecutive lines, the shortest ones of ``MIN_WORDS`` words, that
   two or more documents hold link every later holder to the first one; the
   rarer the window, the fewer such links, and a window that a third of all
   documents hold still makes only one per document.  Every run that is long
   enough consists of windows, so a link to each window's first holder finds
   all that any earlier document holds.
3. Each linked pair is aligned, the later document with the lines of the first
   holder from its first to its last shared window: patience sorting deals the
   lines that are unique in both to chains that rise in both documents.  The
   longest chain is the diff, the others are passages that moved.  All chains
   grow to both sides over equal lines.  Stretches of lines that repeat, where
   no line can anchor an alignment, are aligned exactly: every line with the
   longest run that ends there and that the earlier document holds.
4. All aligned blocks with at least ``MIN_WORDS`` words are deleted from the
   later document.  The first holder of a window has no earlier partner with
   it; of every line one copy stays.

Defined cases: a null or empty text has no lines; equal texts lose all their
lines but in the first document; repeated rows are documents of their own, in
any order among themselves; null ids come last; an empty table gives an empty
result; extra columns are kept and not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesweft.llm import hashing
from salesweft.llm.columns import let
from salesweft.session import written

MIN_WORDS = 20
HOT = 1000
ROW = "__line_dedup_row"


def line_bounds(raw: np.ndarray, bounds: np.ndarray, sentences: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every line, in bytes; the lines of a text cover it."""
    ends = raw == 10
    if sentences and len(raw) > 1:
        stop = np.isin(raw[:-1], np.frombuffer(b".!?", np.uint8))
        ends[1:] |= stop & (raw[1:] == 32)
    cut = np.zeros(len(raw) + 1, bool)
    cut[1:] = ends
    cut[bounds] = True
    cuts = np.flatnonzero(cut)
    return cuts[:-1], cuts[1:]


def lines_of(texts: pa.Array, sentences: bool) -> tuple[np.ndarray, ...]:
    """Per line with a word: its text's number, hash, words, and byte span; spans reach to the next line."""
    raw, bounds = hashing.text_bytes(texts)
    starts, ends = line_bounds(raw, bounds, sentences)
    first, last = hashing.spans(~hashing.BLANK[raw], bounds)
    line = np.searchsorted(starts, first, side="right") - 1
    words = np.bincount(line, minlength=len(starts))
    some = np.flatnonzero(words)
    begin = np.concatenate([[0], np.cumsum(words)])
    left, right = first[begin[some]], last[begin[some + 1] - 1]
    hashes = hashing.span_hashes(raw, left, right)
    return hashing.owners(starts[some], bounds), hashes, words[some], starts[some], ends[some]


def _profiled(sentences: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in hashing.slices(batch, "text"):
                doc, hashes, words, _, _ = lines_of(part.column("text"), sentences)
                cuts = pa.array(np.searchsorted(doc, np.arange(part.num_rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("source_row"), pa.ListArray.from_arrays(cuts, pa.array(hashes.view(np.int64))), pa.ListArray.from_arrays(cuts, pa.array(words, pa.int32()))],
                    names=["id", "source_row", "hashes", "words"],
                )

    return run


def patience(a: list[int], b: list[int]) -> list[list[tuple[int, int]]]:
    """Chains of positions, rising in both lists, of all lines that are unique in both; the longest chain first.

    Patience sorting puts each line, in order of the second list, on the chain
    that ends nearest before it in the first; no fewer chains would hold all.
    """
    at_a: dict[int, int] = {}
    for i, x in enumerate(a):
        at_a[x] = -1 if x in at_a else i
    at_b: dict[int, int] = {}
    for j, x in enumerate(b):
        at_b[x] = -1 if x in at_b else j
    chains: list[list[tuple[int, int]]] = []
    ends: list[int] = []  # negative last positions of the chains, rising
    for x, j in at_b.items():
        i = at_a.get(x, -1)
        if j < 0 or i < 0:
            continue
        k = bisect_right(ends, -i)
        if k == len(chains):
            chains.append([])
            ends.append(0)
        chains[k].append((i, j))
        ends[k] = -i
    return sorted(chains, key=len, reverse=True)


def grown(a: list[int], b: list[int], chain: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Start and end in ``b`` of the blocks of equal lines around a chain's lines."""
    out: list[tuple[int, int]] = []
    shift = end = None
    for i, j in chain:
        if shift == j - i and j < end:
            continue
        shift, start, end = j - i, j, j + 1
        while start and start > shift and a[start - 1 - shift] == b[start - 1]:
            start -= 1
        while end < len(b) and end - shift < len(a) and a[end - shift] == b[end]:
            end += 1
        out.append((start, end))
    return out


def longest_runs(a: list[int], b: list[int]) -> list[int]:
    """For every place of ``b`` the length of the longest run ending there that ``a`` holds too.

    The states of a suffix automaton of ``a`` are its runs by their ends, so the
    cost is linear, however often lines repeat.
    """
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for x in a:
        new, length_new = len(step), length[last] + 1
        step.append({})
        link.append(0)
        length.append(length_new)
        p = last
        while p >= 0 and x not in step[p]:
            step[p][x] = new
            p = link[p]
        if p >= 0:
            q = step[p][x]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p].get(x) == q:
                    step[p][x] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    out, state, n = [], 0, 0
    for x in b:
        while state and x not in step[state]:
            state = link[state]
            n = length[state]
        if x in step[state]:
            state, n = step[state][x], n + 1
        out.append(n)
    return out


def windows(words: list[int], min_words: int) -> set[tuple[int, int]]:
    """Start and end of the shortest runs of enough words that start or end at a line.

    Every run with enough words is a union of such windows: the one at its
    start, and for each line behind that the one which ends there.
    """
    total = [0, *accumulate(words)]
    least = max(1, min_words)
    found = {(start, bisect_left(total, at + least)) for start, at in enumerate(total) if at + least <= total[-1]}
    found |= {(bisect_right(total, at - least) - 1, end) for end, at in enumerate(total) if at >= least}
    return found


def common_blocks(earlier: list[int], later: list[int], words: list[int], min_words: int = MIN_WORDS) -> list[int]:
    """Positions in the later list of all aligned blocks with enough words.

    A block with a line that is unique in both lists is found around that line.
    Any other lies within a stretch of lines that both lists hold and that
    repeat in one of them, and is found by the exact alignment of the stretch.
    """
    total = [0, *accumulate(words)]
    found: set[int] = set()
    anchored: set[int] = set()
    for chain in patience(earlier, later):
        anchored.update(j for _, j in chain)
        for start, end in grown(earlier, later, chain):
            if total[end] - total[start] >= min_words:
                found.update(range(start, end))
    held, seen = set(earlier), Counter(later)
    known = {x for x, n in Counter(earlier).items() if n > 1}
    repeats = [x in held and (x in known or seen[x] > 1) and j not in anchored for j, x in enumerate(later)]
    start = 0
    while start < len(later):
        end = start
        while end < len(later) and repeats[end]:
            end += 1
        if total[end] - total[start] >= max(1, min_words) and not found.issuperset(range(start, end)):
            for k, n in enumerate(longest_runs(earlier, later[start:end]), start + 1):
                if n and total[k] - total[k - n] >= min_words:
                    found.update(range(k - n, k))
        start = end + 1
    return sorted(found)


def window_hashes(hashes: np.ndarray, words: np.ndarray, cuts: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per window of :func:`windows`, in lists of lines between the cuts: its list's number, hash, start and end."""
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    at, least = np.arange(len(words)), max(1, min_words)
    doc = hashing.owners(at, cuts)
    ends = np.searchsorted(total, total[:-1] + least)
    starts = np.searchsorted(total, total[1:] - least, side="right") - 1
    whole, back = ends <= cuts[doc + 1], starts >= cuts[doc]
    # Most windows that end at a line also are the shortest ones from their start.
    back &= ends[np.maximum(starts, 0)] != at + 1
    start, end = np.concatenate([at[whole], starts[back]]), np.concatenate([ends[whole], at[back] + 1])
    out, open_, k = (end - start).astype(np.uint64), np.arange(len(start)), 0
    while len(open_):
        out[open_] = hashing.mix(out[open_] * np.uint64(0x9FB21C651E98DF25) + hashes[start[open_] + k])
        k += 1
        open_ = open_[start[open_] + k < end[open_]]
    owner = np.concatenate([doc[whole], doc[back]])
    return owner, out, start - cuts[owner], end - cuts[owner]


def _windowed(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, words = batch.column("hashes"), batch.column("words")
            cuts = words.offsets.to_numpy().astype(np.int64)
            doc, found, start, end = window_hashes(hashes.flatten().to_numpy().view(np.uint64), words.flatten().to_numpy(), cuts - cuts[0], min_words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(doc)), pa.array(found.view(np.int64)), pa.array(start, pa.int32()), pa.array(end, pa.int32())],
                names=["row", "hash", "start", "end"],
            )

    return run


def _aligned(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for row, a, b, words in zip(*[batch.column(c).to_pylist() for c in ("row", "earlier", "hashes", "words")]):
                block = common_blocks(a, b, words, min_words)
                if block:
                    rows.append(row)
                    found.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(found, pa.list_(pa.int32()))], names=["row", "lines"])

    return run


def removed_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", row: str | None = None, sentences: bool = True, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, removed_words, removed_lines (numbers from 0) and its row."""
    narrow = docs.select(F.col(id_column).alias("id"), (F.col(row) if row else F.monotonically_increasing_id()).alias("source_row"), F.col(text_column).alias("text"))
    schema = f"id {narrow.schema['id'].dataType.simpleString()}, source_row long, hashes array<long>, words array<int>"
    profiles = written(narrow.mapInArrow(_profiled(sentences), schema), "line-profiles")
    # Numbered in order of the id, so that "earlier" is a comparison of row numbers.
    order = [F.col("id").isNull(), F.col("id"), F.col("source_row")]
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = profiles.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    profiles = written(ordered.withColumn("row", F.monotonically_increasing_id()), "line-profiles-ordered")
    held = profiles.select("row", "hashes", "words").mapInArrow(_windowed(min_words), "row long, hash long, start int, end int")
    first = F.min(F.struct("row", "start", "end")).alias("first")
    shared = held.groupBy("hash").agg(first, F.max("row").alias("last"), F.count("*").alias("n")).where("last > first.row")
    holders = written(shared.select("hash", "n", F.col("first.row").alias("holder"), F.col("first.start").alias("start"), F.col("first.end").alias("end")), "line-holders")
    # A line starts and ends one window at most, so no more than HOT windows are
    # held by more than that share of the documents' lines: these few are sent
    # to all tasks, and their many rows need not meet.
    lines = profiles.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0]
    hot = holders.where(F.col("n") > F.lit(2 * lines / HOT)).drop("n")
    cold = holders.where(F.col("n") <= F.lit(2 * lines / HOT)).drop("n")
    rows = held.select("row", "hash")
    met = rows.join(F.broadcast(hot), "hash").unionByName(rows.join(F.broadcast(hot.select("hash")), "hash", "left_anti").join(cold, "hash"))
    links = met.where("holder < row").groupBy("row", "holder").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    # Of the holder only the lines from the first to the last shared window move on.
    texts = profiles.select(F.col("row").alias("holder"), F.col("hashes").alias("lines"))
    earlier = F.slice("lines", F.col("start") + 1, F.col("end") - F.col("start")).alias("earlier")
    pairs = links.join(texts, "holder").select("row", earlier).join(profiles.select("row", "hashes", "words"), "row")
    blocks = pairs.mapInArrow(_aligned(min_words), "row long, lines array<int>")
    removed = blocks.groupBy("row").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("lines")))).alias("removed"))
    lines_out = F.coalesce("removed", F.array().cast("array<int>"))
    return profiles.join(removed, "row", "left").select(
        F.col("id").alias("doc_id"),
        F.size("hashes").alias("n_lines"),
        F.size(lines_out).alias("n_removed"),
        let(F.col("words"), lambda w: F.aggregate(F.transform(lines_out, lambda k: F.get(w, k)), F.lit(0), lambda a, n: a + n)).alias("removed_words"),
        lines_out.alias("removed_lines"),
        "source_row",
    )


def _cut(sentences: bool):
    def without(text: str | None, removed: list[int] | None) -> str | None:
        if not removed or text is None:
            return text
        raw = text.encode()
        _, _, _, starts, ends = lines_of(pa.array([text]), sentences)
        keep, at = [], 0
        for k in removed:
            keep.append(raw[at : starts[k]])
            at = ends[k]
        return b"".join([*keep, raw[at:]]).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [without(t, r) for t, r in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    return run


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sentences: bool = True, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with the aligned blocks cut from their texts, with all their columns."""
    numbered = written(docs.withColumn(ROW, F.monotonically_increasing_id()), "line-rows")
    removed = removed_lines(numbered, id_column, text_column, ROW, sentences, min_words).where("n_removed > 0")
    cut = numbered.join(removed.select(F.col("source_row").alias(ROW), F.col("removed_lines").alias("__removed")), ROW).select(
        F.col(ROW).alias("row"), F.col(text_column).alias("text"), F.col("__removed").alias("removed")
    ).mapInArrow(_cut(sentences), "row long, text string")
    changed = cut.select(F.col("row").alias(ROW), F.col("text").alias("__text"), F.lit(True).alias("__cut"))
    return numbered.join(changed, ROW, "left").withColumn(text_column, F.when(F.col("__cut"), F.col("__text")).otherwise(F.col(text_column))).select(*docs.columns)
