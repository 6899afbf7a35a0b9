"""Lookup tables for use inside tasks."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np

#: Unicode's White_Space, spelled out because Python's \\s also has U+001C to U+001F.
WHITE = r"\t-\r \x85\xa0" + "".join(map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


class IntMap:
    """Non-negative int64 keys to int32 values by open addressing; absent keys give -1."""

    def __init__(self, keys, values):
        keys, values = np.asarray(keys, np.int64), np.asarray(values, np.int32)
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            slots, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[slots], self.values[slots] = keys[won], values[won]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        found = self.keys[at]
        out = self.values[at]
        left = np.flatnonzero((found != keys) & (found >= 0))
        if not len(left):
            out[found != keys] = -1
            return out
        out[found != keys] = -1
        mask = (1 << self.bits) - 1
        while len(left):
            at[left] = (at[left] + 1) & mask
            found = self.keys[at[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out


class Lately:
    """Values of the strings met lately, in about `at_most` bytes.

    There are two generations: when the newer one has half of the bytes it becomes the older one, and what was
    older and hasn't been asked for again is forgotten. Strings over `longest` characters are never kept, so a
    table of few but huge strings can't grow either.
    """

    def __init__(self, at_most: int, longest: int):
        self.half, self.longest = at_most // 2, longest
        self.newer, self.older, self.size = {}, {}, 0

    def get(self, keys: set[str], make: Callable[[list[str]], list]) -> dict[str, object]:
        """The value of each of `keys`; `make` gives those of a list of strings that aren't known."""
        unknown = keys.difference(self.newer)
        out = {k: self.newer[k] for k in keys - unknown}
        fresh = {k: self.older[k] for k in unknown if k in self.older}
        new = list(unknown.difference(fresh))
        fresh.update(zip(new, make(new), strict=True))
        out.update(fresh)
        kept = {k: v for k, v in fresh.items() if len(k) <= self.longest}
        size = sum(100 + sys.getsizeof(k) + sys.getsizeof(v) for k, v in kept.items())
        if self.size + size > self.half:
            self.older, self.newer, self.size = self.newer, {}, 0
        if size <= self.half:
            self.newer.update(kept)
            self.size += size
        return out
