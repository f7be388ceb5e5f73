"""Texts of an Arrow batch as flat numpy arrays.

Tasks work on slices of a batch that hold a bounded number of text bytes, so
their memory does not depend on how long the documents of a batch are (a
single longer document is a slice of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 3 << 20

_ALL = np.arange(256)
# ``[^\x20\x09-\x0D]+``: everything but ASCII white space.
BLANK_SPLIT = ~np.isin(_ALL, [9, 10, 11, 12, 13, 32])
# ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text: digits, letters and
# every byte of a non-ASCII character.
ALNUM_SPLIT = (((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x41) & (_ALL <= 0x5A))
               | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80))
KEEP_CASE = _ALL.astype(np.uint8)
LOWER = np.where((_ALL >= 0x41) & (_ALL <= 0x5A), _ALL + 32, _ALL).astype(np.uint8)

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser (bijective), elementwise."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def raw(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its offsets into them; a null
    counts as an empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    kind = np.int64 if wide else np.int32
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, body = arr.buffers()
    off = np.frombuffer(at, kind, len(arr) + 1, arr.offset * kind().itemsize).astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices of the batches with at most ``limit`` text bytes
    each (or one row)."""
    for b in batches:
        if not b.num_rows:
            continue
        arr = b.column(b.schema.get_field_index(column))
        _, off = raw(arr)
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
            yield b.slice(lo, hi - lo)
            lo = hi


def per_text(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many set entries of ``mask`` lie in each ``[off[i], off[i+1])``."""
    run = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=run[1:])
    return run[off[1:]] - run[off[:-1]]


def byte_strings(body: np.ndarray, off: np.ndarray) -> pa.Array:
    """Binary array over contiguous bytes (no copy)."""
    return pa.Array.from_buffers(pa.binary(), len(off) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(off, np.int32)),
                                  pa.py_buffer(np.ascontiguousarray(body))])


@dataclass
class Words:
    """Words of several texts, one after another."""

    starts: np.ndarray   # byte position of each word
    ends: np.ndarray
    first: np.ndarray    # per text: index of its first word (and the total)
    body: np.ndarray     # the words' bytes without what separates them
    off: np.ndarray      # word i is body[off[i]:off[i+1]]

    def __len__(self) -> int:
        return len(self.starts)

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """Code of each word, and the distinct words by code (exact)."""
        d = byte_strings(self.body, self.off).dictionary_encode()
        return d.indices.to_numpy(zero_copy_only=False), d.dictionary

    def text_of(self) -> np.ndarray:
        """Per word: which text it belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def split_words(data: np.ndarray, off: np.ndarray, inside: np.ndarray,
                case: np.ndarray = KEEP_CASE) -> Words:
    """Maximal runs of bytes in the class ``inside``; a text's end ends a word."""
    w = inside[data]
    n = len(data)
    cut = off[(off > 0) & (off < n)]
    s = w.copy()
    s[1:] &= ~w[:-1]
    s[cut] = w[cut]
    e = w.copy()
    e[:-1] &= ~w[1:]
    e[cut - 1] = w[cut - 1]
    starts, ends = np.flatnonzero(s), np.flatnonzero(e) + 1
    body = data[w]
    if case is not KEEP_CASE:
        body = case[body]
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    return Words(starts, ends, np.searchsorted(starts, off), body, at)


def hash_strings(distinct: pa.Array) -> np.ndarray:
    """64-bit hash of each (distinct) byte string, the same in every task."""
    one = xxhash.xxh3_64_intdigest
    return np.fromiter((one(x) for x in distinct.to_pylist()), np.uint64, len(distinct))


def gather(pool: np.ndarray, off: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate ``pool[off[p]:off[p+1]]`` for p in ``pick``; also the offsets
    of the parts in the result."""
    size = (off[1:] - off[:-1])[pick]
    out = np.zeros(len(pick) + 1, np.int64)
    np.cumsum(size, out=out[1:])
    at = np.arange(out[-1], dtype=np.int64)
    at += np.repeat(off[:-1][pick] - out[:-1], size)
    return pool[at], out
