"""Minimal perfect hashing of distinct integers by levels of bit arrays.

At each level the keys that remain fall into an array of ``SPACE`` bits a key; a key that is alone in its bit stays
there, the others go on to the next level. The number of set bits before a key's bit is its index, so n keys have
the indices 0 to n - 1, in some five bits a key.
"""

from __future__ import annotations

import numpy as np

SPACE = 2
# Multipliers and shifts of the finalizer of a well-known 64-bit generator.
STEP, FIRST, SECOND = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def _bit(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) + np.uint64((level + 1) * STEP % 2**64)
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(FIRST)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(SECOND)
    return ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(bits)).astype(np.int64)


class PerfectHash:
    """Index of every key of a set; ``sizes`` and ``packed`` are all it needs to be stored."""

    def __init__(self, sizes: list[int], packed: bytes) -> None:
        self.sizes, self.packed = sizes, packed
        self.bits = np.unpackbits(np.frombuffer(packed, np.uint8), count=sum(sizes)).view(bool)
        self.before = np.cumsum(self.bits) - self.bits

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """Hash of distinct keys, in any order."""
        sizes, levels = [], []
        while len(keys):
            bits = max(SPACE * len(keys), 64)
            at = _bit(keys, len(sizes), bits)
            alone = np.bincount(at, minlength=bits) == 1
            sizes.append(bits)
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(sizes, np.packbits(np.concatenate(levels)).tobytes() if levels else b"")

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; -1 or the index of another key for numbers outside the set, so verify them."""
        out = np.full(len(keys), -1, np.int64)
        left, offset = np.arange(len(keys)), 0
        for level, bits in enumerate(self.sizes):
            at = offset + _bit(keys[left], level, bits)
            hit = self.bits[at]
            out[left[hit]] = self.before[at[hit]]
            left, offset = left[~hit], offset + bits
        return out
