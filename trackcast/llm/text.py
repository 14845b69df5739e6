"""Vectorised word scanning of Arrow text columns, shared by the operators.

Spark partitions and shuffles the work; inside a task a batch of texts is one
UTF-8 byte buffer, and words are found with numpy over that buffer instead of
one regular expression per text.  All word classes used here are defined on
ASCII characters ("every character but ..."), so scanning bytes is exact: every
byte of a multi-byte character is >= 0x80 and therefore a word byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts are scanned in groups of about this many bytes (bounds memory)

#: ``[^\x20\x09-\x0D]+``: everything but the ASCII white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z: ASCII digits and letters, all else from 0x80.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_LONG = 256  # bytes from which on a span is hashed by itself


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (splitmix64), so that every output bit depends on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes give equal hashes wherever they stand.

    Eight bytes at a time go through ``mix``, for all spans at once; spans over
    ``_LONG`` bytes through BLAKE2b one by one.
    """
    size = ends - starts
    out = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each position on
    live, at = np.flatnonzero((size > 0) & (size <= _LONG)), 0
    while len(live):
        left = size[live] - at
        value = lanes[starts[live] + at]
        short = np.flatnonzero(left < 8)
        value[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        out[live] = mix(out[live] ^ value)
        live, at = live[left > 8], at + 8
    for i in np.flatnonzero(size > _LONG):
        out[i] = int.from_bytes(blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


@dataclass
class Words:
    """The words of a group of texts: byte spans in ``data``, and the text each belongs to."""

    data: np.ndarray    # uint8, the bytes scanned (after the byte map)
    offsets: np.ndarray  # int64, n_texts + 1 byte offsets
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray    # index of the text of each word, ascending
    first: np.ndarray   # int64, n_texts + 1: the words of text i are first[i]:first[i + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def words_of(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> Words:
    n = len(offsets) - 1
    mask = word_bytes[data]
    cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = mask
    before[cut] = False
    starts = np.flatnonzero(mask & ~before[:-1])
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = mask
    after[cut] = False
    ends = np.flatnonzero(mask & ~after[1:]) + 1
    text = np.searchsorted(offsets, starts, side="right") - 1
    first = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(np.bincount(text, minlength=n), out=first[1:])
    return Words(data, offsets, starts, ends, text, first)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column (nulls are empty)."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def groups(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive texts of about ``limit`` bytes together, at least one text a
    group: (first row, end row, bytes, offsets).  A longer text is a group of
    its own; texts are never cut."""
    data, offsets = buffers(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside one text, and the index of their first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, dtype=np.uint64)
    factor = 1
    for j in range(k):
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
        total += hashes[j:j + n] * np.uint64(factor)
    inside = np.ones(n, dtype=bool)
    for j in range(1, k):  # a run must not reach over the first word of the next text
        cut = first[1:-1] - j
        inside[cut[(cut >= 0) & (cut < n)]] = False
    at = np.flatnonzero(inside)
    return mix(total[at]), at
