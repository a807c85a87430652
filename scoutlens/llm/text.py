"""Vectorised byte-level text helpers used inside Arrow tasks.

A batch of texts is one UTF-8 byte buffer plus offsets; words are found with byte
lookups and hashed eight bytes at a time, so no Python object is made per word.
Separators are ASCII bytes, therefore splitting bytes and splitting code points give
the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20      # text handled at once inside a task (a longer single text is its own chunk)

# byte tables: True where a byte ends a word
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.ones(256, bool)                 # words of digits, a-z and every non-ASCII byte
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: MASK[k] keeps the first k of eight bytes
MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)


class Words(NamedTuple):
    """Words of a chunk: byte ``start``/``end`` in ``data``; words of text ``d`` are
    ``bounds[d]:bounds[d + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def chunks(batches, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches holding about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffers(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield batch.slice(lo, hi - lo)
            lo = hi


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, raw, data = column.buffers()
    offsets = np.frombuffer(raw, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def fold(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z."""
    return _FOLD[data]


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> Words:
    """Maximal runs of bytes that are no separator, never across two texts."""
    n = len(data)
    if not n:
        return Words(data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64))
    inside = ~separator[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, ~inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, ~inside[1:]
    start = np.flatnonzero(inside & (before | edge[:n]))
    end = np.flatnonzero(inside & (after | edge[1:])) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    size = (end - start).astype(np.int64)
    out = (size.astype(np.uint64) + np.uint64(1)) * _C2
    at, left, which = start.astype(np.int64), size, None
    while len(left):
        lane = lanes[at] & MASK[np.minimum(left, 8)]
        if which is None:
            out = mix(out ^ (lane * _C1))
            keep = np.flatnonzero(left > 8)
            which = keep
        else:
            out[which] = mix(out[which] ^ (lane * _C1))
            keep = np.flatnonzero(left > 8)
            which = which[keep]
        at, left = at[keep] + 8, left[keep] - 8
    return out


def head(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The eight bytes from each start on (zero beyond the buffer)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))[start]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _C2
    h = h ^ (h >> np.uint64(29))
    h = h * _C1
    return h ^ (h >> np.uint64(32))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the pair of two hashes (order matters)."""
    return mix((a * _C1) ^ ((b << np.uint64(17)) | (b >> np.uint64(47))))


def hash_word(word: str) -> int:
    """:func:`hashes` of one word."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(hashes(data, np.array([0]), np.array([len(data)]))[0])


def word_column(column: pa.Array, separator: np.ndarray = SPACE) -> Words:
    """Words of a string column, A-Z lower-cased."""
    data, offsets = buffers(column)
    return words(fold(data), offsets, separator)
