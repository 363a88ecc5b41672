"""An immutable vectorised hash table."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from . import text as T

U = np.uint64


class Table(NamedTuple):
    """Open addressing: keys (0 is free) and values; size is a power of two."""

    keys: np.ndarray
    values: np.ndarray
    probes: int

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The stored values, NaN where there is none."""
        mask = len(self.keys) - 1
        slot = (T.mix(wanted) & U(mask)).astype(np.int64)
        got = self.keys[slot]
        out = np.where(got == wanted, self.values[slot], np.float32(np.nan))
        left = np.flatnonzero((got != wanted) & (got != 0))
        for _ in range(self.probes):
            if not len(left):
                break
            slot[left] = (slot[left] + 1) & mask
            got = self.keys[slot[left]]
            same = got == wanted[left]
            out[left[same]] = self.values[slot[left[same]]]
            left = left[~same & (got != 0)]
        return out


def table(keys: np.ndarray, values: np.ndarray) -> Table:
    size = 1 << max(4, int(4 * len(keys) - 1).bit_length())
    k, v = np.zeros(size, U), np.zeros(size, np.float32)
    slot = (T.mix(keys) & U(size - 1)).astype(np.int64)
    left, probes = np.arange(len(keys)), 0
    while len(left):
        free = left[k[slot[left]] == 0]
        _, one = np.unique(slot[free], return_index=True)
        put = free[one]
        k[slot[put]], v[slot[put]] = keys[put], values[put]
        done = np.zeros(len(keys), bool)
        done[put] = True
        left = left[~done[left]]
        slot[left] = (slot[left] + 1) & (size - 1)
        probes += 1
    return Table(k, v, probes + 1)
