"""Words of a whole Arrow batch at once: where they are, and a 64-bit hash of each."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_INSIDE = np.array([not (9 <= b <= 13 or b == 32) for b in range(256)])
_VALUES = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 5
_CHUNK = 1 << 19
_powers: list[np.ndarray] = []


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if not _powers or len(_powers[0]) < size:
        n = 1 << max(size - 1, _CHUNK).bit_length()
        _powers[:] = [
            np.cumprod(np.r_[np.uint64(1), np.full(n - 1, b & (2**64 - 1), np.uint64)])
            for b in (_BASE, pow(_BASE, -1, 2**64))
        ]
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words in order; those of row r are first[r] to first[r + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def text(self, a: int, b: int) -> bytes:
        """Words a to b in lower case, joined by one space."""
        return b" ".join(self.data[self.start[i]:self.end[i]].tobytes() for i in range(a, b)).lower()


def words(column: pa.Array) -> Words:
    """The words of each text: A-Z in lower case, cut at x09-x0D and x20. No text may be NULL."""
    column = column.cast(pa.large_binary())
    if not len(column):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), none, none, np.zeros(1, np.int64), np.zeros(0, np.uint64))
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    inside = _INSIDE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    start = np.flatnonzero(inside & (cut[:-1] | ~np.r_[False, inside[:-1]]))
    end = np.flatnonzero(inside & (cut[1:] | ~np.r_[inside[1:], False])) + 1
    first = np.searchsorted(start, offsets)
    hashes = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _CHUNK, "right")))
        a, b = start[i], end[j - 1]
        power, inverse = _tables(int(b - a))
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_VALUES[_LOWER[data[a:b]]] * power[:b - a], out=sums[1:])
        s, e = start[i:j] - a, end[i:j] - a
        hashes[i:j] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        i = j
    return Words(data, start, end, first, hashes)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n neighbours, whatever row they are in."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = hashes[:len(hashes) - n + 1].copy()
    for k in range(1, n):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[k:len(hashes) - n + 1 + k])
    return out
