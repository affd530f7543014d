"""Words of many texts as numpy arrays: where they stand and 64-bit fingerprints of them and of their sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .ngrams import xxhash64

#: Bytes of text that the arrays of one step cover; a longer text is a step of its own.
STEP = 2 << 20
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all their bits; distinct values stay distinct."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without nulls, without a copy."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def steps(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of consecutive rows with about ``STEP`` bytes of text."""
    for batch in batches:
        data, offsets = texts_of(batch.column(column))
        first = 0
        while first < len(batch):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + STEP, "right")) - 1)
            yield (batch.slice(first, last - first), data[offsets[first]:offsets[last]],
                   offsets[first:last + 1] - offsets[first])
            first = last


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds): words as byte ranges; those of text i are bounds[i] to bounds[i+1]."""
    solid = np.empty(len(data) + 1, bool)
    np.logical_not(BLANK[data], out=solid[:-1])
    solid[-1] = False
    start, stop = solid.copy(), np.zeros(len(data) + 1, bool)
    start[1:] &= ~solid[:-1]
    stop[1:] = solid[:-1] & ~solid[1:]
    cut = offsets[1:-1]  # a word ends where its text ends
    start[cut] |= solid[cut]
    inner = cut[(cut > 0)]
    stop[inner] |= solid[inner - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop)
    return starts, ends, np.searchsorted(starts, offsets)


def fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each byte range, its xxHash64; equal ranges get equal ones on every executor."""
    return mix(xxhash64(np.ascontiguousarray(data), starts, ends - starts))


def windows(codes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint of the ``size`` codes from each place on, whether they lie in one text)."""
    n = max(0, len(codes) - size + 1)
    out, scale = np.zeros(n, np.uint64), 1
    for k in range(size):
        out += codes[k:k + n] * np.uint64(scale)
        scale = scale * BASE % (1 << 64)
    whole = np.ones(n, bool)
    for k in range(1, size):  # the places just before a text's end start no window
        at = bounds[1:] - k
        at = at[(at >= 0) & (at < n) & (at >= bounds[:-1])]
        whole[at] = False
    return mix(out), whole
