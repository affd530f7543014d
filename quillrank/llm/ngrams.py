"""Runs of words of many texts as byte ranges of one buffer, and an open-addressed table that interns them exactly."""

from __future__ import annotations

import zlib

import numpy as np
import xxhash

U64 = np.uint64
#: Ranges above this many bytes are hashed and compared one by one, by a library call each.
SHORT = 256
#: The five fixed odd multipliers of xxHash64.
P1, P2, P3, P4, P5 = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
WRAP = (1 << 64) - 1


def class_mask(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes lie in one of the closed ranges."""
    out = np.zeros(256, bool)
    for first, last in ranges:
        out[first:last + 1] = True
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds): maximal byte runs of the class ``inside``; those of text i are bounds[i] to bounds[i+1]."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = inside[data]
    first, last = solid[1:] & ~solid[:-1], solid[:-1] & ~solid[1:]
    cut = offsets[1:-1]  # a run does not cross from one text into the next
    inner = cut[(cut > 0) & (cut < len(data))]
    both = inner[solid[inner] & solid[inner + 1]]
    first[both] = last[both] = True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return starts, ends, np.searchsorted(starts, offsets)


class Words:
    """Words of some texts, copied into one buffer with a blank after each: a run of words is a byte range of it."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        width = ends - starts + 1
        self.at = np.r_[0, np.cumsum(width)].astype(np.int64)
        index = np.arange(self.at[-1]) - np.repeat(self.at[:-1] - starts, width)
        self.buffer = np.zeros(self.at[-1] + 16, np.uint8)  # padded, so that eight bytes can be read anywhere
        if len(data):
            self.buffer[:self.at[-1]] = data[np.minimum(index, len(data) - 1)]
        self.buffer[self.at[1:] - 1] = 32

    def runs(self, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts, lengths) in bytes of the ``n`` words from each of the words ``first`` on, joined by one blank."""
        return self.at[first], self.at[first + n] - 1 - self.at[first]


def _rotated(x: np.ndarray, k: int) -> np.ndarray:
    return (x << U64(k)) | (x >> U64(64 - k))


def _wide(buffer: np.ndarray, kind: str) -> np.ndarray:
    """The little-endian integers that begin at each byte."""
    size = np.dtype(kind).itemsize
    return np.ndarray((max(0, len(buffer) - size + 1),), kind, buffer.data, 0, (1,))


def xxhash64(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """xxHash64 (seed 0) of each byte range, all ranges of one length at a time."""
    out = np.empty(len(starts), U64)
    if not len(starts):
        return out
    wide, half = _wide(buffer, "<u8"), _wide(buffer, "<u4")
    order = np.argsort(np.minimum(lengths, SHORT + 1).astype(np.uint16), kind="stable")
    sizes, cut = np.unique(np.minimum(lengths[order], SHORT + 1), return_index=True)
    for size, rows in zip(sizes.tolist(), np.split(order, cut[1:])):
        at = starts[rows]
        if size > SHORT:
            out[rows] = [xxhash.xxh64_intdigest(buffer[a:a + n].data) for a, n in zip(at.tolist(), lengths[rows].tolist())]
        else:
            out[rows] = _equally_long(buffer, wide, half, at, size)
    return out


def _lane(acc, lane):
    return _rotated(acc + lane * U64(P2), 31) * U64(P1)


def _equally_long(buffer, wide, half, at: np.ndarray, size: int) -> np.ndarray:
    done = 0
    if size >= 32:
        acc = [np.full(len(at), s & WRAP, U64) for s in (P1 + P2, P2, 0, -P1)]
        while size - done >= 32:
            acc = [_lane(a, wide[at + done + 8 * k]) for k, a in enumerate(acc)]
            done += 32
        h = sum((_rotated(a, r) for a, r in zip(acc[1:], (7, 12, 18))), _rotated(acc[0], 1))
        zero = np.zeros(len(at), U64)
        for a in acc:
            h = (h ^ _lane(zero, a)) * U64(P1) + U64(P4)
        h = h + U64(size)
    else:
        h = np.full(len(at), P5 + size & WRAP, U64)
    while size - done >= 8:
        h = _rotated(h ^ _lane(np.zeros(len(at), U64), wide[at + done]), 27) * U64(P1) + U64(P4)
        done += 8
    if size - done >= 4:
        h = _rotated(h ^ half[at + done].astype(U64) * U64(P1), 23) * U64(P2) + U64(P3)
        done += 4
    while done < size:
        h = _rotated(h ^ buffer[at + done].astype(U64) * U64(P5), 11) * U64(P1)
        done += 1
    h = (h ^ (h >> U64(33))) * U64(P2)
    h = (h ^ (h >> U64(29))) * U64(P3)
    return h ^ (h >> U64(32))


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 (reflected polynomial EDB88320) of one byte and of two bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = (one >> np.uint32(1)) ^ (one & np.uint32(1)) * np.uint32(0xEDB88320)
    low, high = np.meshgrid(np.arange(256), np.arange(256))
    first = one[low.ravel()]
    return one, one[(first & np.uint32(255)) ^ high.ravel().astype(np.uint32)] ^ (first >> np.uint32(8))


ONE, TWO = _crc_tables()


def crc32(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of each byte range."""
    out = np.empty(len(starts), np.uint32)
    long = np.flatnonzero(lengths > SHORT)
    out[long] = [zlib.crc32(buffer[starts[i]:starts[i] + lengths[i]].data) for i in long.tolist()]
    order = np.flatnonzero(lengths <= SHORT)
    order = order[np.argsort(-lengths[order].astype(np.int16), kind="stable")]
    at, size = starts[order], lengths[order]
    crc, pair = np.full(len(at), 0xFFFFFFFF, np.uint32), _wide(buffer, "<u2")
    left = np.searchsorted(-size, -np.arange(2, SHORT + 2, 2), "right")  # ranges with so many bytes, longest first
    for k, n in enumerate(left.tolist()):
        if not n:
            break
        part = crc[:n]
        crc[:n] = TWO[(part ^ pair[at[:n] + 2 * k]) & np.uint32(0xFFFF)] ^ (part >> np.uint32(16))
    odd = np.flatnonzero(size & 1)
    part = crc[odd]
    crc[odd] = ONE[(part ^ buffer[at[odd] + size[odd] - 1]) & np.uint32(0xFF)] ^ (part >> np.uint32(8))
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def same_bytes(buffer: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the ranges of equal length that begin at ``a`` and at ``b`` hold the same bytes."""
    equal, wide = np.ones(len(a), bool), _wide(buffer, "<u8")
    long = lengths > SHORT
    for i in np.flatnonzero(long).tolist():
        equal[i] = buffer[a[i]:a[i] + lengths[i]].tobytes() == buffer[b[i]:b[i] + lengths[i]].tobytes()
    left, done = np.flatnonzero(~long & (lengths > 0)), 0
    while len(left):
        differ = wide[a[left] + done] ^ wide[b[left] + done]
        rest = np.minimum(lengths[left] - done, 8)
        differ <<= (U64(64) - rest.astype(U64) * U64(8))  # what lies behind the range does not count
        equal[left[differ != 0]] = False
        done += 8
        left = left[(differ == 0) & (lengths[left] > done)]
    return equal


class Interned:
    """Equal byte ranges share a slot of an open-addressed table.

    Keys are xxHash64 values; a range stops at the first slot from its key's place on that is empty or whose owner
    has the same key, length and bytes, so that equal keys of different ranges do no harm. All ranges probe together.
    ``slot`` is the slot of each range, ``owner`` a range for each used slot, ``count`` how many ranges share it.
    """

    def __init__(self, buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keys: np.ndarray | None = None):
        keys = xxhash64(buffer, starts, lengths) if keys is None else keys
        size = 1 << max(4, int(2 * len(starts)).bit_length())
        place = (keys & U64(size - 1)).astype(np.int64)
        table, slot = np.full(size, -1, np.int64), np.empty(len(starts), np.int64)
        todo = np.arange(len(starts))
        while len(todo):
            at = place[todo]
            free = table[at] < 0
            table[at[free]] = todo[free]  # of several that claim a slot one becomes its owner
            own = table[at]
            fits = (keys[own] == keys[todo]) & (lengths[own] == lengths[todo])
            check = np.flatnonzero(fits & (own != todo))
            fits[check] = same_bytes(buffer, starts[own[check]], starts[todo[check]], lengths[todo[check]])
            slot[todo[fits]] = at[fits]
            todo = todo[~fits]
            place[todo] = (place[todo] + 1) & (size - 1)
        used = np.flatnonzero(table >= 0)
        number = np.empty(size, np.int64)
        number[used] = np.arange(len(used))
        self.owner, self.slot = table[used], number[slot]
        self.count = np.bincount(self.slot, minlength=len(used))
