"""Vectorised words, hashes and shingles over a chunk of texts.

A chunk is the UTF-8 bytes of its texts end to end plus their offsets.  Words
and hashes are found with whole-array operations; a word's 64-bit hash comes
from a polynomial prefix sum, so any span costs two lookups.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_STEP = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) * U(2) + U(1)
_pow = np.ones(1, U)
_inv = np.ones(1, U)
KEPT_POWERS = 1 << 20

#: ASCII upper case to lower case, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: The separators of `[^\x20\x09-\x0D]+`.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):  # no chunk at all
        col = pa.array([], pa.string())
    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    offsets = np.frombuffer(col.buffers()[1], np.int64, n + 1, col.offset * 8) if n else np.zeros(1, np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None and n else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to ``n``; a worker keeps them up
    to ``KEPT_POWERS``, those for a longer text go with it."""
    global _pow, _inv
    if len(_pow) > n:
        return _pow, _inv
    size = max(n, min(KEPT_POWERS, 2 * n))
    with np.errstate(over="ignore"):
        power, inverse = (np.concatenate([np.ones(1, U), np.cumprod(np.full(size, x, U))]) for x in (_P, _PINV))
    if size <= KEPT_POWERS:
        _pow, _inv = power, inverse
    return power, inverse


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums H of the polynomial hash (one longer than the data)."""
    p, _ = _powers(len(data))
    out = np.zeros(len(data) + 1, U)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[data] * p[:len(data)], out=out[1:])
    return out


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end): equal spans have equal hashes."""
    _, inv = _powers(len(h))
    with np.errstate(over="ignore"):
        return mix((h[end] - h[start]) * inv[start] + (end - start).astype(U) * _STEP[15])


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` that never cross a
    text's border."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    edge = np.empty(n + 1, bool)
    edge[0] = edge[n] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:n])
    edge |= border
    cut = np.flatnonzero(edge)
    keep = inside[cut[:-1]]
    return cut[:-1][keep], cut[1:][keep]


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE):
    """(starts, ends, first, hashes): the words of all texts in order; text i
    owns words first[i] to first[i + 1].  ``data`` is taken as it is."""
    start, end = spans(~separator[data], offsets)
    first = np.searchsorted(start, offsets)
    return start, end, first, span_hash(prefix(data), start, end)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int = 5):
    """(values, first): the k-word shingles of all texts in order; a text with
    fewer words has its whole sequence as one, a text without words none."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    begin = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=begin[1:])
    total = int(begin[-1])
    if not total:
        return np.zeros(0, U), begin
    at = np.arange(total) - np.repeat(begin[:-1] - first[:-1], count)
    length = np.repeat(np.minimum(n, k), count)
    padded = np.concatenate([hashes, np.zeros(k, U)])
    out = length.astype(U) * _STEP[14]
    with np.errstate(over="ignore"):
        for j in range(k):
            out += np.where(j < length, padded[at + j], U(0)) * _STEP[j]
    return mix(out), begin


def distinct_sorted(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text, its values sorted without repeats: (values, first)."""
    n = len(first) - 1
    if not len(values):
        return values, np.zeros(n + 1, np.int64)
    owner = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    v, o = v[keep], o[keep]
    return v, np.searchsorted(o, np.arange(n + 1))


def per_text_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs (0 for an empty one)."""
    total = np.concatenate([np.zeros(1, values.dtype if values.dtype != bool else np.int64), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]
