"""Words of many texts at once: spans and hashes of byte runs, vectorised over a batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bytes hashed at a time; a longer word is hashed in one go.
_BLOCK = 1 << 18
_powers = (np.empty(0, np.uint64), np.empty(0, np.uint64))

#: A-Z to lower case, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty. Offsets have one entry more than rows."""
    array = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    if data is None or not len(array):
        return np.empty(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the runs of ``inside`` bytes, which never cross texts.

    ``first`` holds, for each text and one past the last, the number of runs before it.
    """
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    if n:
        before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, bool)
    if n:
        after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs: a polynomial mod 2**64, mixed with the length."""
    global _powers
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + _BLOCK, "right")))
        part = data[low : ends[to - 1]]
        if len(_powers[0]) <= len(part):
            size = max(_BLOCK, len(part)) + 1
            up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
            up[0] = down[0] = 1
            _powers = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part + np.uint64(1)) * _powers[0][: len(part)], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[e] - sums[s]) * _powers[1][s]
        if len(part) > 16 * _BLOCK:
            _powers = (np.empty(0, np.uint64), np.empty(0, np.uint64))
        at = to
    out = (out ^ (ends - starts).astype(np.uint64)) * _MIX
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xC2B2AE3D27D4EB4F)
    out ^= out >> np.uint64(29)
    return out


def rolled(own: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` hashes in a row."""
    out = np.full(max(0, len(own) - length + 1), length, np.uint64)
    for j in range(length):
        out = (out ^ own[j : j + len(out)]) * _MIX
        out ^= out >> np.uint64(32)
    return out


def in_bytes(batches, most: int = 2 << 20, name: str = "text"):
    """Arrow batches cut by the size of their texts; a text beyond ``most`` bytes comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffer_of(batch.column(name))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end
