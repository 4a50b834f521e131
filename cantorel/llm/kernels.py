"""Vectorised text kernels over Arrow string columns: whole batches at a time, no per-word Python."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text a kernel works on at once; temporaries are about 30 times as large.
CHUNK_BYTES = 1 << 20
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element-wise."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


#: Odd multipliers by position in a run.
_POWERS = splitmix(np.arange(1, 257, dtype=np.uint64) * _GOLDEN) | np.uint64(1)

SPACE, WORD, PUNCT = 0, 1, 2
_CLASS = np.full(256, PUNCT, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = WORD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``size`` bytes; one longer text makes a slice of its own."""
    if not batch.num_rows:
        return
    n = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.cumsum(n) // size
    cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the n + 1 offsets; nulls are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = pc.fill_null(array.cast(pa.large_string()), "")
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def runs(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of maximal runs of one class (never across texts), and the class of each run."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    edge = np.empty(len(data), bool)
    edge[0] = True
    np.not_equal(classes[1:], classes[:-1], out=edge[1:])
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(edge)
    return starts, classes[starts]


def run_hashes(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run; equal runs have equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = np.diff(np.append(starts, len(codes)))
    pos = np.arange(len(codes), dtype=np.int64) - np.repeat(starts, lengths)
    value = (codes.astype(np.uint64) + np.uint64(1)) * _POWERS[pos & 255]
    return splitmix(np.add.reduceat(value, starts) + lengths.astype(np.uint64) * _GOLDEN)


def token_hashes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of lower-cased word and punctuation runs of a column, and the row of each."""
    data, offsets = text_bytes(array)
    data = _LOWER[data]
    starts, kind = runs(data, offsets, _CLASS[data])
    hashes = run_hashes(data, starts)
    keep = kind != SPACE
    rows = np.searchsorted(offsets, starts[keep], "right") - 1
    return hashes[keep], rows


_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: Strings longer than this are hashed one by one.
_LONG_STRING = 256


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(state: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turned(state + lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of data[start:end] for many, also overlapping, strings at once, by the published algorithm."""
    padded = np.append(data, np.zeros(8, np.uint8))
    lanes = np.empty(len(data) + 1, np.uint64)  # the eight bytes at each place
    for s in range(8):
        part = padded[s : s + (len(padded) - s) // 8 * 8].view("<u8")
        lanes[s::8] = part[: len(lanes[s::8])]
    size, at, seed64 = end - start, start.copy(), np.uint64(seed)
    h = np.full(len(start), seed64 + _P5, np.uint64)
    striped = np.flatnonzero((size >= 32) & (size <= _LONG_STRING))
    if len(striped):
        with np.errstate(over="ignore"):
            state = [np.full(len(striped), x, np.uint64) for x in (seed64 + _P1 + _P2, seed64 + _P2, seed64, seed64 - _P1)]
        for k in range(int(size[striped].max()) // 32):
            on = np.flatnonzero(size[striped] >= 32 * (k + 1))
            for j in range(4):
                state[j][on] = _round(state[j][on], lanes[start[striped[on]] + 32 * k + 8 * j])
        whole = sum((_turned(v, r) for v, r in zip(state, (1, 7, 12, 18))), np.zeros(len(striped), np.uint64))
        for v in state:
            whole = (whole ^ _round(np.zeros_like(v), v)) * _P1 + _P4
        h[striped] = whole
        at[striped] += size[striped] // 32 * 32
    h += size.astype(np.uint64)
    for _ in range(3):
        on = np.flatnonzero(at + 8 <= end)
        if not len(on):
            break
        lane = lanes[at[on]]
        h[on] = _turned(h[on] ^ _round(np.zeros_like(lane), lane), 27) * _P1 + _P4
        at[on] += 8
    on = np.flatnonzero(at + 4 <= end)
    h[on] = _turned(h[on] ^ ((lanes[at[on]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    at[on] += 4
    for _ in range(3):
        on = np.flatnonzero(at < end)
        h[on] = _turned(h[on] ^ ((lanes[at[on]] & np.uint64(0xFF)) * _P5), 11) * _P1
        at[on] += 1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    h ^= h >> np.uint64(32)
    view = memoryview(np.ascontiguousarray(data))
    for i in np.flatnonzero(size > _LONG_STRING).tolist():
        h[i] = xxhash.xxh64_intdigest(view[start[i] : end[i]], seed)
    return h
