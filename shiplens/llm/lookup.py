"""Vectorised lookup of 64-bit keys, for pieces of a vocabulary or pairs of them."""

from __future__ import annotations

import numpy as np

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class KeyTable:
    """Maps unsigned 64-bit keys to their index, -1 for a key that isn't there.

    Two slot arrays: a key that finds its first slot taken goes to its second
    one.  ``bits`` grows until every key has a slot, so a lookup is two
    gathers and no loop.
    """

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys, np.uint64)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("keys must differ")
        bits = max(10, int(np.ceil(np.log2(len(keys) + 1))) + 2)
        while not self._fill(keys, bits):
            bits += 1

    def _slots(self, keys: np.ndarray, which: int) -> np.ndarray:
        return ((keys * np.uint64(_ODD[which])) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _fill(self, keys: np.ndarray, bits: int) -> bool:
        self.bits = bits
        self.at = [np.full(1 << bits, -1, np.int32) for _ in _ODD]
        rest = np.arange(len(keys), dtype=np.int32)
        for which in range(2):
            slots = self._slots(keys[rest], which)
            _, first = np.unique(slots, return_index=True)
            self.at[which][slots[first]] = rest[first]
            rest = np.delete(rest, first)
        self.keys = np.append(keys, np.uint64(0))  # index -1 reads the last one
        return not len(rest)

    def find(self, keys: np.ndarray) -> np.ndarray:
        found = self.at[0][self._slots(keys, 0)]
        taken = np.flatnonzero(found >= 0)  # an empty first slot: not there
        taken = taken[self.keys[found[taken]] != keys[taken]]
        if len(taken):
            left = keys[taken]
            second = self.at[1][self._slots(left, 1)]
            found[taken] = np.where((second >= 0) & (self.keys[second] == left), second, np.int32(-1))
        return found
