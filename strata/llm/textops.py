"""Whole-batch text primitives on Arrow buffers.

A batch of texts is one byte buffer with offsets, so tokenising and hashing are
a handful of numpy passes over all texts at once; no Python object is made per
word.  Words are maximal runs of bytes other than space and 0x09-0x0D, which in
UTF-8 is the same as the code-point rule, because those bytes never occur inside
a multi-byte character.
"""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (wraps modulo 2**64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * U64(_ODD))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x2545F4914F6CDD1D
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # base**i and its inverse, grown on demand


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 19)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            np.multiply.accumulate(table, out=table)
            _powers[k] = table
    return _powers


def tidy(work):
    """A partition function that hands freed memory back when it ends, since its worker may stay idle beside other stages."""

    @functools.wraps(work)
    def run(batches):
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return run


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(column, max_bytes: int = 1 << 18):
    """Split a string column into (start, stop) row ranges of about ``max_bytes``, which keeps the arrays of a slice in
    the processor's cache; one long text may exceed it."""
    _, offsets = text_bytes(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1)
        yield at, min(stop, n)
        at = min(stop, n)


def word_spans(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, bounds): byte spans of all words; words bounds[d]:bounds[d+1] belong to text d."""
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    heads = edge[edge < len(data)]
    first[heads] = inside[heads]
    tails = edge[edge > 0] - 1
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: a polynomial over random byte codes, read off one prefix sum, then mixed."""
    power, inverse = _power_tables(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * power[: len(data)], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * U64(_ODD))


def window_index(bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word of every k-word window inside one text, windows before each text)."""
    counts = np.maximum(np.diff(bounds) - k + 1, 0)
    before = np.concatenate([[0], np.cumsum(counts)])
    return np.arange(before[-1]) + np.repeat(bounds[:-1] - before[:-1], counts), before


def window_hashes(words: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of the k consecutive word hashes from each index in ``first``; the order counts."""
    total = np.full(len(first), U64(k))
    for j in range(k):
        total = mix64(total + words[first + j] * U64((2 * j + 1) * _ODD & _MASK))
    return total


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct hashes of each text's k-word shingles.

    A text of fewer words has one, its whole sequence; a text without words has none.
    """
    data = LOWER[data]
    starts, ends, bounds = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    n_words = np.diff(bounds)
    counts = np.where(n_words >= k, n_words - k + 1, n_words > 0)
    before = np.concatenate([[0], np.cumsum(counts)])
    first = np.arange(before[-1]) + np.repeat(bounds[:-1] - before[:-1], counts)
    long = np.repeat(n_words >= k, counts)
    hashes = np.empty(len(first), np.uint64)
    hashes[long] = window_hashes(words, first[long], k)
    for n in range(1, k):
        texts = np.flatnonzero(n_words == n)
        hashes[before[texts]] = window_hashes(words, bounds[texts], n)
    for d in np.flatnonzero(counts > 1):
        hashes[before[d] : before[d + 1]].sort()
    keep = np.ones(len(hashes), bool)
    keep[1:] = hashes[1:] != hashes[:-1]
    keep[before[:-1][counts > 0]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return hashes[keep], kept[before]
