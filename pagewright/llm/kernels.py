"""Vectorised text kernels: Arrow string buffers in, word and shingle tables out, no Python object per word.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D; as UTF-8 never uses those bytes inside a longer
character, this equals the pattern ``[^\\x20\\x09-\\x0D]+`` on code points. Hashes have 64 bits and are the same on
every machine and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Text bytes that one numpy pass handles; bounds a worker's memory (about 60 bytes for each).
BLOCK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_P = 0xD6E8FEB86659FD93
_P_INVERSE = pow(_P, -1, 1 << 64)
_Q = mix(np.arange(1001, 1065, dtype=U64)) | U64(1)
_powers = [np.ones(1, dtype=U64), np.ones(1, dtype=U64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the byte multiplier and of its inverse modulo 2^64, for n bytes at least."""
    if len(_powers[0]) < n:
        for i, p in enumerate((_P, _P_INVERSE)):
            a = np.full(max(n, 1 << 16), p, dtype=U64)
            a[0] = 1
            _powers[i] = np.multiply.accumulate(a)
    return _powers[0], _powers[1]


class Texts:
    """Some whole texts as one byte array; text i is data[start[i]:end[i]]."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.data, self.start, self.end = data, start, end

    def __len__(self) -> int:
        return len(self.start)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, end row, texts) for runs of rows with about `limit` bytes; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    if n == 0:
        return
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        part = raw[offsets[i] : offsets[j]]
        yield i, j, Texts(part, offsets[i:j] - offsets[i], offsets[i + 1 : j + 1] - offsets[i])
        i = j


def words(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte, text number) of each word, in order."""
    w = ~SEPARATOR[t.data]
    n = len(w)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    begins, ends = w.copy(), w.copy()
    begins[1:] &= ~w[:-1]
    ends[:-1] &= ~w[1:]
    first = t.start[t.start < t.end]
    begins[first] = w[first]
    last = t.end[t.start < t.end] - 1
    ends[last] = w[last]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(t.start, s, "right") - 1


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of data[s:e] for each span; with `lower`, A-Z count as a-z."""
    p, q = _power(len(data) + 1)
    table = _BYTE[LOWER] if lower else _BYTE
    h = np.empty(len(data) + 1, dtype=U64)
    h[0] = 0
    np.cumsum(table[data] * p[: len(data)], out=h[1:])
    return mix((h[e] - h[s]) * q[s] + (e - s).astype(U64) * U64(0x9E3779B97F4A7C15))


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of data[i:i+k] for each i up to len - k."""
    n = len(data) - k + 1
    p, q = _power(len(data) + 1)
    h = _BYTE[data]
    h *= p[: len(data)]
    np.cumsum(h, out=h)
    out = h[k - 1 :].copy()
    out[1:] -= h[: n - 1]
    out *= q[:n]
    return mix(out)


def bounds(doc: np.ndarray, n: int) -> np.ndarray:
    """Where each text's rows begin in a table sorted by text number; n + 1 values."""
    return np.searchsorted(doc, np.arange(n + 1))


def shingles(word_hash: np.ndarray, doc: np.ndarray, n: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of each run of k words; a text of 1 to k-1 words has its whole sequence as one run."""
    b = bounds(doc, n)
    size = b[1:] - b[:-1]
    at = np.arange(len(word_hash))
    room = b[1:][doc] - at
    keep = (room >= k) | ((size[doc] < k) & (at == b[:-1][doc]))
    at, room = at[keep], np.minimum(room[keep], k)
    h = np.zeros(len(at), dtype=U64)
    top = max(len(word_hash) - 1, 0)
    for j in range(k):
        part = word_hash[np.minimum(at + j, top)] * _Q[j]
        h += part if j == 0 else np.where(room > j, part, U64(0))
    return mix(h + room.astype(U64) * U64(0xC2B2AE3D27D4EB4F)), doc[keep]


def distinct_per_text(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text, and where each text's begin (n + 1 values)."""
    b = bounds(doc, n)
    parts = [np.unique(h[b[i] : b[i + 1]]) for i in range(n)]
    ends = np.zeros(n + 1, dtype=np.int64)
    np.cumsum([len(x) for x in parts], out=ends[1:])
    return (np.concatenate(parts) if parts else h[:0]), ends


def run_hashes(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of word_hash[i:i+k] for each i up to len - k."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return word_hash[:0]
    h = np.zeros(n, dtype=U64)
    for j in range(k):
        h += word_hash[j : j + n] * _Q[j]
    return mix(h)


def list_array(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """An Arrow list column from flat values and n + 1 offsets."""
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def char_counts(t: Texts, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Code points in data[s:e] for each span."""
    c = np.zeros(len(t.data) + 1, dtype=np.int64)
    np.cumsum((t.data & 0xC0) != 0x80, out=c[1:])
    return c[e] - c[s]


def crc32_mod(column: pa.Array, m: int) -> np.ndarray:
    """crc32 of each id as decimal text, modulo m; null counts as the empty text."""
    from zlib import crc32

    return np.array([crc32(b"" if x is None else str(x).encode()) % m for x in column.to_pylist()], dtype=np.int64)
