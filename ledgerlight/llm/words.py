"""Words of whole texts as numpy arrays: places, ends and 64-bit hashes, a slice of documents at a time.

The operators that look at words work on UTF-8 bytes inside Spark tasks. A word is a run of word bytes within one text;
all classes used here keep every byte of a non-ASCII character, so byte runs are the character runs of the contract.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
"""Bytes of text worked on at a time; a longer text is a slice of its own."""

_FIRST = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
_STEP = np.uint64(0x2545F4914F6CDD1D)
_KEEP = np.array([0xFFFFFFFFFFFFFFFF >> (64 - 8 * n) if n else 0 for n in range(9)], dtype=np.uint64)


def byte_class(separators: bytes) -> np.ndarray:
    """256 flags: which bytes belong to words."""
    flags = np.ones(256, dtype=bool)
    flags[list(separators)] = False
    return flags


# White space as in [^\x20\x09-\x0D]+
PLAIN = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
# Letters, digits and all that is not ASCII, as in [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = byte_class(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers whose bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(32))) * _FIRST
    x = (x ^ (x >> np.uint64(29))) * _SECOND
    return x ^ (x >> np.uint64(32))


@dataclass
class Slice:
    """Some texts in one buffer. Words of text k are first_word[k] to first_word[k + 1]."""

    rows: range
    data: np.ndarray
    begin: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first_word: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first_word)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.rows)), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        padded = np.concatenate([self.data, np.zeros(8, dtype=np.uint8)])
        eight = np.ndarray((len(self.data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
        length = self.ends - self.starts
        value = mix(length.astype(np.uint64))
        left, place, open_ = length, self.starts, slice(None)
        while len(left):
            part = eight[place] & _KEEP[np.minimum(left, 8)]
            value[open_] = mix((value[open_] ^ part) * _STEP + part)
            more = left > 8
            open_ = np.flatnonzero(more) if isinstance(open_, slice) else open_[more]
            left, place = left[more] - 8, place[more] + 8
        return value

    def window_hashes(self, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of the windows of ``size`` words that lie in one text, and the windows' hashes."""
        n = len(words) - size + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        value = np.full(n, size, dtype=np.uint64)
        for j in range(size):
            value *= _STEP
            value += words[j : n + j]
        last = np.repeat(self.first_word[1:], self.counts)
        at = np.flatnonzero(np.arange(n) + size <= last[:n])
        return at, mix(value[at])


def text_slices(column: pa.Array, word: np.ndarray, lower: bool = False, slice_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of an Arrow string column, null as empty, in slices of about ``slice_bytes``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, dtype=np.uint8)
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + slice_bytes, side="right")) - 1)
        stop = min(stop, n)
        piece = data[offsets[row] : offsets[stop]]
        yield _split(range(row, stop), LOWER[piece] if lower else piece, offsets[row : stop + 1] - offsets[row], word)
        row = stop


def _split(rows: range, data: np.ndarray, begin: np.ndarray, word: np.ndarray) -> Slice:
    inside = word[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[begin] = True
    before = np.concatenate([[False], inside])
    after = np.concatenate([inside, [False]])
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return Slice(rows, data, begin, starts, ends, np.searchsorted(starts, begin))
