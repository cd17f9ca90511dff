"""Whole Arrow text columns as numpy: words, word hashes, shingles.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, hashed after
lower-casing A-Z. All functions take whole texts; long texts are hashed in byte
windows cut at word ends, so the working memory does not grow with a window.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WINDOW = 1 << 17

_rng = np.random.Generator(np.random.PCG64(20240607))
_BASE = int(_rng.integers(1 << 62, 1 << 63)) & ~7 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_VALUE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE_LOWER = _VALUE[LOWER]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW, _INV = _powers(_BASE, WINDOW + 1), _powers(_INVERSE, WINDOW + 1)
#: Multipliers of the words of a shingle, by place.
_PLACE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, most_bytes: int = 1 << 20):
    """The rows of ``batch`` in pieces of about ``most_bytes`` of text (a longer text stands alone)."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
    piece = np.cumsum(sizes) // most_bytes
    edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(sizes)] if len(sizes) else [0]
    for a, b in zip(edges, edges[1:], strict=False):
        yield batch.slice(a, b - a)
    # workers live on after a task: what a batch needed goes back to the system
    pa.default_memory_pool().release_unused()


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words of each text): byte spans of all words in text order."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    word = ~IS_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of the byte spans (ascending, disjoint)."""
    out = np.empty(len(starts), np.uint64)
    value = _VALUE_LOWER if lower else _VALUE
    i = 0
    while i < len(starts):
        a = starts[i]
        j = int(np.searchsorted(ends, a + WINDOW, "right"))
        if j <= i:  # one span longer than a window
            raw = data[a : ends[i]]
            out[i] = int.from_bytes(blake2b((LOWER[raw] if lower else raw).tobytes(), digest_size=8).digest(), "little")
            i += 1
            continue
        seg = value[data[a : ends[j - 1]]]
        seg *= _POW[: len(seg)]
        total = np.empty(len(seg) + 1, np.uint64)
        total[0] = 0
        np.cumsum(seg, out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (total[e] - total[s]) * _INV[s]
        i = j
    return mix64(out + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, counts: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each shingle, shingles of each text), repeats included.

    A text with fewer than ``width`` words but at least one has its whole word
    sequence as its one shingle.
    """
    n = len(words)
    ends = np.cumsum(counts)
    per = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out = np.zeros(int(per.sum()), np.uint64)
    if n == 0:
        return out, per
    rolled = np.zeros(n, np.uint64)
    for k in range(min(width, n)):
        rolled[: n - k] += words[k:] * _PLACE[k]
    at = np.cumsum(per)
    full = counts >= width
    place = np.arange(len(out)) - np.repeat(at - per, per) + np.repeat(ends - counts, per)
    long = np.repeat(full, per)
    out[long] = mix64(rolled[place[long]])
    for d in np.flatnonzero((counts > 0) & ~full):
        c, e = int(counts[d]), int(ends[d])
        h = (words[e - c : e] * _PLACE[:c]).sum(dtype=np.uint64, keepdims=True) + np.array([c], np.uint64) * _PLACE[63]
        out[at[d] - 1] = mix64(h)[0]
    return out, per


def distinct_sets(values: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct values text by text, how many each text has)."""
    ends = np.cumsum(per)
    pieces = [np.unique(values[e - c : e]) for c, e in zip(per, ends, strict=True)]
    return (np.concatenate(pieces) if pieces else values), np.array([len(p) for p in pieces], np.int64)
