"""A minimal perfect hash over 128-bit keys, in arrays.

Keys are thrown into a bit array; those that are alone in their place are done and
the others go on to the next, smaller array. A key's index is the number of set bits before
its own, so n keys have the indexes 0 to n - 1.
"""

from __future__ import annotations

import numpy as np

from gridgale.llm.common import mix64

SPREAD = 1.7  # places per key and level


def _place(h1: np.ndarray, h2: np.ndarray, level: int, places: int) -> np.ndarray:
    salt = mix64(np.array([level + 1], np.uint64))
    return (mix64(h1 ^ salt) ^ mix64(h2 + salt)) % np.uint64(places)


def fingerprint(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """What is kept of a key to know strangers by."""
    return mix64(h1 + mix64(h2 ^ np.uint64(0x9E3779B97F4A7C15)))


def build(h1: np.ndarray, h2: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The levels' sizes and all their bits, for keys that differ in `h1` or `h2`."""
    left, sizes, bits = np.arange(len(h1)), [], []
    while len(left):
        size = max(64, int(len(left) * SPREAD))
        at = _place(h1[left], h2[left], len(sizes), size)
        alone = np.bincount(at.astype(np.int64), minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[at]]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


class Index:
    """Answers from the arrays of one shard."""

    def __init__(self, sizes: list[int], bits: np.ndarray, prints: np.ndarray, *values: np.ndarray):
        self.sizes, self.bits, self.prints, self.values = sizes, bits, prints, values
        self.rank = np.cumsum(bits) - 1

    def locate(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Each key's index; a stranger gets any index, or -1."""
        out, left, first = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            at = _place(h1[left], h2[left], level, size).astype(np.int64) + first
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left, first = left[~hit], first + size
        return out

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Each key's index, or -1 for a key that is not in the shard."""
        out = self.locate(h1, h2)
        known = out >= 0
        known[known] = self.prints[out[known]] == fingerprint(h1[known], h2[known])
        return np.where(known, out, -1)
