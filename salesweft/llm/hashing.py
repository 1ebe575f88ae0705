"""Array hashing of words and word n-grams inside Arrow tasks.

A slice of texts is one byte buffer.  Prefix sums of a polynomial over that
buffer give the hash of any span by one subtraction, so words and n-grams are
hashed without a Python loop over words.  Words are ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

SLICE_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut so that no slice has more than about ``most`` bytes of text."""
    array = batch.column(column)
    if not len(array):
        return
    ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(array), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, end - start)
        start = end


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the bounds of each; null is empty."""
    array = pa.compute.fill_null(array.cast(pa.large_string()), "")
    array = pa.concat_arrays([array])
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` that do not cross a text's bound."""
    before = np.zeros(len(inside) + 1, bool)
    before[1:] = inside
    first = bounds[:-1][bounds[:-1] < len(inside)]
    before[first] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(inside) + 1, bool)
    after[:-1] = inside
    after[bounds[bounds < len(inside)]] = False
    after[len(inside)] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends


def _powers(kind: str, n: int) -> np.ndarray:
    have = _POWERS[kind]
    if len(have) < n:
        step = np.full(n, _BASE if kind == "up" else _INVERSE, np.uint64)
        step[0] = 1
        _POWERS[kind] = have = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers("up", len(raw)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers("down", len(raw) + 1)[starts] + (ends - starts).astype(np.uint64))


def owners(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The text that each span belongs to."""
    return np.searchsorted(bounds, starts, side="right") - 1


def grams(words: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive words of one text, and the text of each."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, doc.dtype)
    out = words[: len(words) - n + 1]
    for k in range(1, n):
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + words[k : len(words) - n + 1 + k])
    whole = doc[: len(doc) - n + 1] == doc[n - 1 :]
    return out[whole], doc[: len(doc) - n + 1][whole]


def word_hashes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word and the text it stands in."""
    raw, bounds = text_bytes(array)
    starts, ends = spans(~BLANK[raw], bounds)
    return span_hashes(raw, starts, ends), owners(starts, bounds)


def shingles(array: pa.Array, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``n``-word shingles, sorted within each text.

    Returned as (hashes, bounds).  A text of fewer than ``n`` words has one
    shingle of all its words; a text without words has none.
    """
    words, doc = word_hashes(array)
    found, owner = grams(words, doc, n)
    counts = np.bincount(doc, minlength=len(array))
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        first = np.concatenate([[0], np.cumsum(counts)])
        extra = np.array([grams(words[first[i] : first[i + 1]], doc[first[i] : first[i + 1]], counts[i])[0][0] for i in short], np.uint64)
        found, owner = np.concatenate([found, extra + np.uint64(1)]), np.concatenate([owner, short])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[new], owner[new]
    return found, np.searchsorted(owner, np.arange(len(array) + 1))
