"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Only the number of pieces of each length matters for a packing, so the plan is
made from the histogram of lengths (at most ``capacity`` numbers), whatever
the number of documents.  Large pieces, above a third of the capacity, are
matched greedily, longest first with the longest that still fits, at most two
to a sequence.  Smaller pieces, longest first, go where they leave the least
gap.  The plan says for every length which ranks go to which sequences and
offsets; pieces find their place by their rank among those of equal length.
Ranks are counted in salted chunks, so one very common length is no hot key.

Defined cases: a null text is empty; an empty document is its end token alone;
repeated rows are packed each; null ids are kept; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesweft.llm import hashing
from salesweft.session import written

CAPACITY = 2048
END = 0
CHUNKS = 1024
MEMO_WORDS = 400_000
SLICE_BYTES = 1 << 22  # a word is looked up once per slice
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Token ids of whole texts from the ids of their words.

    For a tokenizer that lower-cases, drops white space and never joins words
    across it.  Ids of a word are remembered, up to ``MEMO_WORDS`` words.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0
        self.starts, self.sizes = np.zeros(MEMO_WORDS, np.int64), np.zeros(MEMO_WORDS, np.int64)

    def _learn(self, words: list[str]) -> None:
        for start in range(0, len(words), 4096):
            part = words[start : start + 4096]
            for word, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                ids = found.ids
                slot, n = len(self.slots), len(ids)
                if slot >= len(self.starts):
                    self.starts, self.sizes = np.concatenate([self.starts, self.starts * 0]), np.concatenate([self.sizes, self.sizes * 0])
                while self.used + n > len(self.ids):
                    self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
                self.ids[self.used : self.used + n] = ids
                self.slots[word], self.starts[slot], self.sizes[slot] = slot, self.used, n
                self.used += n

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the bounds of each text."""
        # Special tokens are told from text by their case, so such texts stay as they are.
        special = pc.match_substring(texts, "<|")
        plain = pc.replace_substring_regex(pc.ascii_lower(texts), r"([a-z])([!-&(-/:-@\[-`{-~])", r"\1 \2")
        words = pc.ascii_split_whitespace(pc.if_else(special, texts, plain))
        flat = words.flatten().dictionary_encode()
        names = flat.dictionary.to_pylist()
        new, used = [w for w in names if w not in self.slots], self.used
        self._learn(new)
        slot = np.array([self.slots[w] for w in names], np.int64)[flat.indices.to_numpy()]
        sizes, starts = self.sizes[slot], self.starts[slot]
        before = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(starts - before[:-1], sizes) + np.arange(before[-1])]
        if len(self.slots) > MEMO_WORDS:
            # Full: the words met first are mostly the frequent ones and stay.
            self.used = used
            for word in new:
                del self.slots[word]
        return ids, before[np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def token_pieces(docs: DataFrame, path: str = TOKENIZER, capacity: int = CAPACITY, end: int = END, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece, with the ids themselves on demand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(path)
        for batch in batches:
            for part in hashing.slices(batch, "text", SLICE_BYTES):
                ids, bounds = encode(pc.fill_null(part.column("text"), ""))
                whole = np.full(len(ids) + part.num_rows, end, "<u4")
                at = np.arange(len(ids)) + np.repeat(np.arange(part.num_rows), np.diff(bounds))
                whole[at] = ids
                first = bounds + np.arange(part.num_rows + 1)
                counts = -(-np.diff(first) // capacity)
                doc = np.repeat(np.arange(part.num_rows), counts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = piece * capacity
                length = np.minimum(np.diff(first)[doc] - start, capacity)
                raw, begin = whole.tobytes(), (first[:-1][doc] + start) * 4
                cuts = [raw[b : b + 4 * n] for b, n in zip(begin, length)]
                columns = [part.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array([zlib.crc32(c) for c in cuts], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array([np.frombuffer(c, "<u4").astype(np.int32) for c in cuts], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    schema = f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return narrow.mapInArrow(run, schema + ", ids array<int>" * keep_ids)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Slots (length, first rank, ranks, first sequence, pieces per sequence, offset), sorted by length and rank."""
    slots: list[tuple[int, int, int, int, int, int]] = []
    left = dict(counts)
    given = dict.fromkeys(counts, 0)
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    sequences = 0

    def put(length: int, pieces: int, sequence: int, each: int, offset: int) -> None:
        slots.append((length, given[length], pieces, sequence, each, offset))
        given[length] += pieces
        left[length] -= pieces

    large = sorted(s for s in counts if 3 * s > capacity)
    for length in reversed(large):
        while left[length]:
            partner = next((t for t in reversed(large) if t <= min(length, capacity - length) and left[t] >= (2 if t == length else 1)), None)
            if partner is None:
                n, gap = left[length], capacity - length
                put(length, n, sequences, 1, 0)
            elif partner == length:
                n, gap = left[length] // 2, capacity - 2 * length
                put(length, 2 * n, sequences, 2, 0)
            else:
                n, gap = min(left[length], left[partner]), capacity - length - partner
                put(length, n, sequences, 1, 0)
                put(partner, n, sequences, 1, length)
            gaps[gap].append((sequences, n))
            sequences += n
    for length in sorted((s for s in counts if 3 * s <= capacity), reverse=True):
        gap = length
        while left[length]:
            gap = next((g for g in range(gap, capacity + 1) if gaps[g]), 0)
            if not gap:
                # New sequences, empty so far: as many as the rest of this length fills.
                n = -(-left[length] // (capacity // length))
                gaps[capacity].append((sequences, n))
                sequences += n
                gap = capacity
            first, n = gaps[gap].pop()
            each = gap // length
            full = min(n, left[length] // each)
            if full:
                put(length, full * each, first, each, capacity - gap)
                gaps[gap - each * length].append((first, full))
            if full < n and left[length]:
                rest = left[length]
                put(length, rest, first + full, rest, capacity - gap)
                gaps[gap - rest * length].append((first + full, 1))
                full += 1
            if full < n:
                gaps[gap].append((first + full, n - full))
    return np.array(sorted(slots), np.int64).reshape(-1, 6)


def packed(pieces: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """The pieces (any table with ``length``) with sequence_id and offset behind their columns."""
    chunk = F.pmod(F.xxhash64(*order), F.lit(CHUNKS)).cast("int")
    cells = pieces.groupBy("length", chunk.alias("chunk")).agg(F.count("*").alias("n"))
    cells = written(cells, "packing-cells")
    counts = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = F.sum("n").over(Window.partitionBy("length").orderBy("chunk")) - F.col("n")
    offsets = cells.select(F.col("length").alias("of_length"), F.col("chunk").alias("of_chunk"), before.alias("before"))
    place = F.row_number().over(Window.partitionBy("length", "__chunk").orderBy(*order)) - 1
    ranked = (
        pieces.withColumn("__chunk", chunk).withColumn("__place", place)
        .join(offsets, (F.col("length") == F.col("of_length")) & (F.col("__chunk") == F.col("of_chunk")))
        .select(*pieces.columns, (F.col("before") + F.col("__place")).alias("__rank"))
    )
    slots = plan(counts, capacity)
    sent = pieces.sparkSession.sparkContext.broadcast(slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        firsts = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            rank = batch.column("__rank").to_numpy()
            slot = table[np.searchsorted(firsts, (batch.column("length").to_numpy() << 48) + rank, side="right") - 1]
            nth = rank - slot[:, 1]
            yield batch.drop_columns(["__rank"]).append_column("sequence_id", pa.array(slot[:, 3] + nth // slot[:, 4])).append_column("offset", pa.array(slot[:, 5] + nth % slot[:, 4] * slot[:, 0]))

    return ranked.mapInArrow(run, pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema)


def packed_documents(docs: DataFrame, **columns: str) -> DataFrame:
    """Tokenise once, to a table, and pack."""
    return packed(written(token_pieces(docs, **columns), "packing-pieces"))
