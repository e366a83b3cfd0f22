"""A hash table that is read by whole arrays."""

from __future__ import annotations

import numpy as np

FREE = np.uint64(2**64 - 1)


class Lookup:
    """A fixed map from 64-bit keys to numbers from 0 up: open addressing, read for whole arrays; -1 where there is none."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        keys = keys.view(np.uint64)
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, FREE)
        self.values = np.full(1 << self.bits, -1, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            at = slot[left]
            free = self.keys[at] == FREE
            self.keys[at[free]] = keys[left[free]]  # one of those that want a slot gets it
            won = self.keys[at] == keys[left]
            self.values[at[won]] = values[left[won]]
            left = left[~won]
            slot[left] = self._after(slot[left])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _after(self, slot: np.ndarray) -> np.ndarray:
        return (slot + 1) & ((1 << self.bits) - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.view(np.uint64)
        at = self._slot(keys)
        found = self.keys[at]
        hit = found == keys
        out = np.where(hit, self.values[at], np.int32(-1))
        going = np.flatnonzero(~hit & (found != FREE))
        while len(going):
            at[going] = step = self._after(at[going])
            found, own = self.keys[step], keys[going]
            hit = found == own
            out[going[hit]] = self.values[step[hit]]
            going = going[~hit & (found != FREE)]
        return out
