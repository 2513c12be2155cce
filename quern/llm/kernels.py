"""Array kernels over the byte buffers of Arrow string columns.

A column's texts lie one after the other in one buffer; the kernels work on
blocks of whole documents of it, so memory is bounded by BLOCK_BYTES or the
longest single document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BLOCK_BYTES = 1 << 19
U = np.uint64
#: Longer ranges are hashed one by one.
LONG = 2048

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words of letters and digits, all bytes of other scripts included.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: Bytes other than ASCII white space.
SOLID = np.ones(256, dtype=bool)
SOLID[[9, 10, 11, 12, 13, 32]] = False


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and its len + 1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes; a longer document is a block of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def split_words(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of ``inside`` bytes, which end with their document, and each document's first word (len + 1)."""
    on = np.zeros(len(buf) + 1, bool)
    on[:-1] = inside[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    first = on.copy()
    first[1:] &= ~on[:-1] | edge[1:]
    starts = np.flatnonzero(first)
    last = on[:-1] & (~on[1:] | edge[1:])
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def _view(buf: np.ndarray, kind: str) -> np.ndarray:
    """All unaligned little-endian numbers of a buffer that has 8 bytes to spare at its end."""
    return np.ndarray((len(buf) - 7,), kind, buf, strides=(1,))


def padded(buf: np.ndarray) -> np.ndarray:
    out = np.zeros(len(buf) + 8, np.uint8)
    out[:-8] = buf
    return out


_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=U)
_M1, _M2, _M3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * _M2
    h = (h ^ (h >> U(27))) * _M3
    return h ^ (h >> U(31))


def hash_ranges(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges of a ``padded`` buffer."""
    size = ends - starts
    view = _view(buf, "<u8")
    h = mix64((view[starts] & _MASKS[np.minimum(size, 8)]) + size.astype(U) * _M1)
    at = 8
    more = np.flatnonzero((size > 8) & (size <= LONG))
    while len(more):
        left = np.minimum(size[more] - at, 8)
        h[more] = mix64((h[more] + _M1) ^ (view[starts[more] + at] & _MASKS[left]))
        at += 8
        more = more[size[more] > at]
    for i in np.flatnonzero(size > LONG):
        h[i] = xxhash.xxh3_64_intdigest(buf[starts[i] : ends[i]].tobytes())
    return h


#: Fixed values of XXH64.
_P1, _P2, _P3, _P4, _P5 = U(0x9E3779B185EBCA87), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0x85EBCA77C2B2AE63), U(0x27D4EB2F165667C5)


def _rot(x: np.ndarray, k: int) -> np.ndarray:
    return (x << U(k)) | (x >> U(64 - k))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rot(acc + lane * _P2, 31) * _P1


def xxh64_ranges(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of byte ranges of a ``padded`` buffer, all ranges at once."""
    size = ends - starts
    v8, v4 = _view(buf, "<u8"), _view(buf, "<u4")
    with np.errstate(over="ignore"):
        s = U(seed)
        acc = np.full(len(size), s + _P5, dtype=U)
        at, left = starts.copy(), size.copy()
        wide = np.flatnonzero((size >= 32) & (size <= LONG))
        if len(wide):
            v = [np.full(len(wide), x, dtype=U) for x in (s + _P1 + _P2, s + _P2, s, s - _P1)]
            stripes, pos = size[wide] // 32, starts[wide].copy()
            for k in range(int(stripes.max())):
                on = np.flatnonzero(stripes > k)
                p = pos[on]
                for j in range(4):
                    v[j][on] = _round(v[j][on], v8[p + 8 * j])
                pos[on] += 32
            h = _rot(v[0], 1) + _rot(v[1], 7) + _rot(v[2], 12) + _rot(v[3], 18)
            for x in v:
                h = (h ^ _round(np.zeros_like(x), x)) * _P1 + _P4
            acc[wide] = h
            at[wide], left[wide] = pos, size[wide] % 32
        acc += size.astype(U)
        short = size <= LONG
        for _ in range(3):
            on = np.flatnonzero((left >= 8) & short)
            if not len(on):
                break
            acc[on] = _rot(acc[on] ^ _round(np.zeros(len(on), U), v8[at[on]]), 27) * _P1 + _P4
            at[on] += 8
            left[on] -= 8
        on = np.flatnonzero((left >= 4) & short)
        acc[on] = _rot(acc[on] ^ (v4[at[on]].astype(U) * _P1), 23) * _P2 + _P3
        at[on] += 4
        left[on] -= 4
        for _ in range(3):
            on = np.flatnonzero((left >= 1) & short)
            if not len(on):
                break
            acc[on] = _rot(acc[on] ^ (buf[at[on]].astype(U) * _P5), 11) * _P1
            at[on] += 1
            left[on] -= 1
        acc = (acc ^ (acc >> U(33))) * _P2
        acc = (acc ^ (acc >> U(29))) * _P3
        acc ^= acc >> U(32)
    for i in np.flatnonzero(~short):
        acc[i] = xxhash.xxh64_intdigest(buf[starts[i] : ends[i]].tobytes(), seed)
    return acc


#: The steps of CRC-32 for each byte, from its polynomial.
CRC_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC_TABLE = np.where(CRC_TABLE & 1, np.uint32(0xEDB88320), np.uint32(0)) ^ (CRC_TABLE >> 1)


def crc32_ranges(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of byte ranges, all ranges at once."""
    size = ends - starts
    out = np.zeros(len(size), np.uint32)
    order = np.argsort(-np.minimum(size, LONG + 1), kind="stable")
    far = int(np.count_nonzero(size > LONG))
    for i in order[:far]:
        out[i] = zlib.crc32(buf[starts[i] : ends[i]])
    order = order[far:]
    at, left = starts[order], size[order]
    acc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    # longest ranges first: those that go on are a prefix
    going = np.searchsorted(-left, -np.arange(1, int(left.max(initial=0)) + 1), "right")
    for k, n in enumerate(going):
        acc[:n] = CRC_TABLE[(acc[:n] ^ buf[at[:n] + k]) & 0xFF] ^ (acc[:n] >> np.uint32(8))
    out[order] = ~acc
    return out
