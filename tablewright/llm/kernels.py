"""NumPy kernels for term statistics: runs of bytes, hash lookups, bounded tallies."""

from __future__ import annotations

import numpy as np

from .common import _LOWER, U64, _BYTE_HASH, _BASE, mix

# byte classes of the two kinds of terms; every byte of a non-ASCII character is from 0x80 on
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
ALNUM = LETTERS.copy()
ALNUM[0x30:0x3A] = True

_ANY_HASH = np.where(_BYTE_HASH == 0, mix(np.arange(1001, 1257, dtype=U64)), _BYTE_HASH)


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]


def runs(data: np.ndarray, off: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends (bytes) of the longest runs of ``member`` bytes in every text, and the n+1 run offsets of the texts."""
    n = len(off) - 1
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    inside = member[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, off)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of lower-cased byte runs."""
    if len(starts) == 0:
        return np.zeros(0, U64)
    length = ends - starts
    first = np.r_[0, np.cumsum(length)[:-1]]
    at = np.arange(int(length.sum())) - np.repeat(first, length)
    value = _ANY_HASH[_LOWER[data[at + np.repeat(starts, length)]]]
    power = np.cumprod(np.full(int(length.max()) + 1, _BASE, U64))
    value *= power[at]
    return mix(np.add.reduceat(value, first))


class Lookup:
    """Position of 64-bit hashes in a sorted table, -1 where absent.

    Hashes are spread evenly, so their leading bits say where to look; a few
    probes follow, fewer with ``spare`` more bits.
    """

    def __init__(self, keys: np.ndarray, spare: int = 0):
        self.keys = keys.astype(U64)                    # sorted, distinct
        bits = max(1, len(keys).bit_length() + spare)
        self.shift = U64(64 - bits)
        heads = (self.keys >> self.shift).astype(np.int64)
        self.start = np.searchsorted(heads, np.arange((1 << bits) + 1)).astype(np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int32)
        head = (hashes >> self.shift).astype(np.int64)
        at, stop = self.start[head], self.start[head + 1]
        lanes = np.flatnonzero(at < stop)
        at, stop, left = at[lanes], stop[lanes], hashes[lanes]
        while len(lanes):
            hit = self.keys[at] == left
            out[lanes[hit]] = at[hit]
            on = ~hit & (at + 1 < stop)
            lanes, at, stop, left = lanes[on], at[on] + 1, stop[on], left[on]
        return out


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and their sums."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class Tally:
    """Counts by integer key, held up to ``limit`` entries; what is more is handed on and summed downstream."""

    def __init__(self, limit: int = 1 << 21):
        self.limit, self.held, self.parts = limit, 0, []

    def add(self, keys: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Count ``keys``; returns the (keys, counts) that no longer fit."""
        k, c = np.unique(keys, return_counts=True)
        self.parts.append((k, c.astype(np.int64)))
        self.held += len(k)
        if self.held > self.limit:
            self._merge()
            if self.held > self.limit // 2:
                return self.rest()
        return []

    def _merge(self) -> None:
        if len(self.parts) > 1:
            self.parts = [summed(*(np.concatenate(x) for x in zip(*self.parts)))]
            self.held = len(self.parts[0][0])

    def rest(self) -> list[tuple[np.ndarray, np.ndarray]]:
        self._merge()
        out, self.parts, self.held = self.parts, [], 0
        return out
