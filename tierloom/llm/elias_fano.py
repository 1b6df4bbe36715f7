"""Elias-Fano sequences over numpy arrays that may be memory-mapped."""

from __future__ import annotations

from pathlib import Path

import numpy as np

# Of each byte: its zeros, and the places of its zeros and of its ones.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
ZEROS = (8 - _BITS.sum(axis=1)).astype(np.uint8)
ZERO_AT = np.argsort(_BITS, axis=1, kind="stable").astype(np.uint8)
ONE_AT = np.argsort(1 - _BITS.astype(np.int8), axis=1, kind="stable").astype(np.uint8)
PARTS = ("low", "high", "zeros", "ones")


class EliasFano:
    """A strictly rising sequence of unsigned 64-bit numbers.

    The low bits of each number are packed side by side; the high bits are a bit vector in which number ``i`` with
    high part ``h`` sets bit ``h + i``. Two directories hold the zeros and the ones before each 64-bit word of it.
    """

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> None:
        self.n, self.width, self.low, self.high, self.zeros, self.ones = n, width, low, high, zeros, ones

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        width = min(width, 56)  # so that a number and its bit offset lie within eight bytes
        places = ((values >> np.uint64(width)) + np.arange(n, dtype=np.uint64)).astype(np.int64)
        bits = np.zeros((((top >> width) + n + 1) // 64 + 1) * 64, np.uint8)
        bits[places] = 1
        ones = bits.reshape(-1, 64).sum(axis=1, dtype=np.int64)
        zeros, before = (np.concatenate([[0], np.cumsum(c)]).astype(np.int64) for c in (64 - ones, ones))
        low = np.zeros(n * width // 8 + 9, np.uint8)
        if width and n:
            flat = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")[:, :width]
            packed = np.packbits(flat.ravel(), bitorder="little")
            low[: len(packed)] = packed
        return cls(n, width, low, np.packbits(bits, bitorder="little"), zeros, before)

    def save(self, folder: Path, name: str) -> None:
        np.savez(folder / f"{name}.npz", n=self.n, width=self.width)
        for part in PARTS:
            np.save(folder / f"{name}.{part}.npy", getattr(self, part))

    @classmethod
    def open(cls, folder: Path, name: str) -> EliasFano:
        with np.load(folder / f"{name}.npz") as facts:
            n, width = int(facts["n"]), int(facts["width"])
        return cls(n, width, *(np.load(folder / f"{name}.{part}.npy", mmap_mode="r") for part in PARTS))

    def _place(self, k: np.ndarray, before: np.ndarray, zeros: bool) -> np.ndarray:
        """Position of the k-th zero or one of the high bits, counted from 0; ``before`` is its directory."""
        word = np.searchsorted(before, k, "right") - 1
        rest = k - before[word]
        held = np.asarray(self.high).reshape(-1, 8)[word]
        upto = np.cumsum(ZEROS[held] if zeros else 8 - ZEROS[held], axis=1, dtype=np.uint8)
        byte = (upto <= rest[:, None]).sum(axis=1)
        rows = np.arange(len(k))
        rest -= np.where(byte > 0, upto[rows, byte - 1], 0)
        return word * 64 + byte * 8 + (ZERO_AT if zeros else ONE_AT)[held[rows, byte], rest]

    def _zero(self, k: np.ndarray) -> np.ndarray:
        return self._place(k, self.zeros, True)

    def at(self, index: np.ndarray) -> np.ndarray:
        """Numbers at these places of the sequence."""
        out = np.zeros(len(index), np.uint64)
        for start in range(0, len(index), 65_536):
            some = index[start : start + 65_536].astype(np.int64)
            high = (self._place(some, self.ones, False) - some).astype(np.uint64)
            out[start : start + len(some)] = (high << np.uint64(self.width)) | self._low(some)
        return out

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(index), np.uint64)
        bit = index * self.width
        start = bit >> 3
        raw = np.asarray(self.low)[start[:, None] + np.arange(8)]
        word = np.ascontiguousarray(raw).view("<u8").ravel() >> (bit & 7).astype(np.uint64)
        return word & np.uint64((1 << self.width) - 1)

    def find(self, values: np.ndarray, first: np.ndarray | None = None, stop: np.ndarray | None = None) -> np.ndarray:
        """Index of each value, -1 if it is not there: binary search among the numbers that share its high part.

        With ``first`` and ``stop`` only that range of the sequence is searched for each value.
        """
        out = np.full(len(values), -1, np.int64)
        if not self.n or not len(values):
            return out
        values = values.astype(np.uint64)
        high = values >> np.uint64(self.width)
        inside = np.flatnonzero(high < np.uint64(self.zeros[-1]))
        for start in range(0, len(inside), 65_536):
            rows = inside[start : start + 65_536]
            h = high[rows].astype(np.int64)
            end = self._zero(h) - h
            at = np.where(h > 0, self._zero(np.maximum(h - 1, 0)) - h + 1, 0)
            if first is not None:
                at, end = np.maximum(at, first[rows]), np.minimum(end, stop[rows])
            wanted = values[rows] & np.uint64((1 << self.width) - 1)
            low, high_end = at, end.copy()
            live = np.flatnonzero(low < high_end)
            while len(live):
                middle = (low[live] + high_end[live]) // 2
                less = self._low(middle) < wanted[live]
                low[live[less]] = middle[less] + 1
                high_end[live[~less]] = middle[~less]
                live = live[low[live] < high_end[live]]
            there = np.flatnonzero(low < end)
            there = there[self._low(low[there]) == wanted[there]]
            out[rows[there]] = low[there]
        return out
