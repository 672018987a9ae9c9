"""Vectorised word spans and hashes of whole Arrow text columns.

A column of texts becomes one byte buffer, each text followed by a space. Words are runs of bytes that a
256-entry table allows, so a UTF-8 text needs no decoding. Null and empty texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute

M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLD = np.uint64(0x9E3779B97F4A7C15)

#: Bytes of words: all but space and \x09-\x0D; digits, lower-case letters and non-ASCII.
NONSPACE = np.ones(256, bool)
NONSPACE[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * GOLD)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of an odd constant, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.r_[np.uint64(1), np.full(max(n, 256) - 1, GOLD)], dtype=np.uint64)
    return _powers[:n]


@dataclass
class Words:
    """Words of consecutive texts: byte spans in buf, hashes, and each text's first word (n + 1 offsets)."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray
    bytes_at: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, a space after each text; the n + 1 places where texts begin."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    begin = at + np.arange(n + 1)
    out = np.full(len(data) + n, 32, np.uint8)
    text = np.ones(len(out), bool)
    text[begin[1:] - 1] = False
    out[text] = data
    return out, begin


def words(column: pa.Array | pa.ChunkedArray, allowed: np.ndarray = NONSPACE, lower: bool = False, hashed: bool = True) -> Words:
    """The words of each text of a column, with 64-bit hashes of their bytes (after lower-casing A-Z if asked)."""
    buf, begin = buffer(column)
    if lower:
        buf = LOWER[buf]
    word = allowed[buf]
    edge = np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    h = np.zeros(0, np.uint64)
    if hashed and len(starts):
        seg = np.cumsum(edge[:-1] == 1, dtype=np.int32) - 1
        place = np.arange(len(buf), dtype=np.int64) - starts[np.maximum(seg, 0)]
        table = np.where(allowed, BYTE, np.uint64(0))
        place[~word] = 0
        h = mix(np.add.reduceat(table[buf] * powers(int((ends - starts).max()) + 1)[place], starts) + (ends - starts).astype(np.uint64) * GOLD)
    return Words(buf, starts, ends, h, np.searchsorted(starts, begin), begin)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive items from each start, len(h) - k + 1 of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, p = np.zeros(n, np.uint64), powers(k)
    for j in range(k):
        out += h[j : j + n] * p[j]
    return mix(out)


def window_starts(offsets: np.ndarray, k: int) -> np.ndarray:
    """A mask over all words but the last k - 1: whether k words of one text start there."""
    total = int(offsets[-1])
    ok = np.ones(max(0, total - k + 1), bool)
    for j in range(1, k):
        at = offsets[1:-1] - j
        at = at[(at >= 0) & (at < len(ok))]
        ok[at] = False
    if len(offsets) > 2:  # windows that begin before several short texts
        first = np.searchsorted(offsets, np.arange(len(ok)), side="right")
        ok &= np.arange(len(ok)) + k <= offsets[np.minimum(first, len(offsets) - 1)]
    return ok


def slices(table: pa.Table | pa.RecordBatch, column: str = "text", size: int = 1 << 18) -> Iterator[pa.Table]:
    """Consecutive rows with about `size` bytes of text each; a longer text comes alone, whole."""
    table = pa.Table.from_batches([table]) if isinstance(table, pa.RecordBatch) else table
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(table[column]), 0))
    cut = np.cumsum(sizes) // size
    edges = np.r_[0, np.flatnonzero(np.diff(cut)) + 1, len(cut)] if len(cut) else [0]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield table.slice(int(a), int(b - a))
    pa.default_memory_pool().release_unused()


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingle hashes of each text, sorted within it, and n + 1 offsets; a shorter text is one shingle, none is empty."""
    h, ok = rolling(w.hashes, k), window_starts(w.offsets, k)
    own, counts = w.doc[: len(ok)][ok], np.diff(w.offsets)
    values = h[ok]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        at = w.offsets[short]
        place = np.arange(len(w.hashes)) - w.offsets[w.doc]
        sums = np.r_[np.uint64(0), np.cumsum(w.hashes * powers(k)[np.minimum(place, k - 1)], dtype=np.uint64)]
        folded = sums[w.offsets[short + 1]] - sums[at]
        own, values = np.r_[own, short], np.r_[values, mix(folded + counts[short].astype(np.uint64))]
    order = np.lexsort((values, own))
    own, values = own[order], values[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (values[1:] != values[:-1])
    own, values = own[new], values[new]
    return values, np.searchsorted(own, np.arange(len(counts) + 1))
