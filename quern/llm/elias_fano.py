"""Monotone sequences in Elias-Fano form, in numpy arrays that may lie in a memory-mapped file."""

from __future__ import annotations

import mmap
import tempfile

import numpy as np


class MonotoneSequence:
    """Non-decreasing unsigned 64-bit values: low bits packed side by side, high parts in unary.

    ``arrays`` hold all there is to keep: about 2 + log2(universe / n) bits for each value.
    """

    BLOCK = 1 << 16

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.low_bits = (int(x) for x in arrays["head"])
        self.arrays = arrays
        self.low = arrays["low"]
        self._starts: np.ndarray | None = None

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> MonotoneSequence:
        n = len(values)
        low_bits = min(56, max(0, (universe // max(n, 1)).bit_length() - 1))
        values = values.astype(np.uint64)
        packed = []
        for start in range(0, n, cls.BLOCK):  # a multiple of 8 values: blocks end on whole bytes
            low = values[start : start + cls.BLOCK] & np.uint64((1 << low_bits) - 1)
            bits = (low[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
            packed.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"))
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        unary = np.zeros(n + int(high[-1] if n else 0) + 2, np.uint8)
        unary[high + np.arange(n)] = 1
        low = np.concatenate([*packed, np.zeros(8, np.uint8)])  # room for reads of eight bytes
        return cls({"head": np.array([n, low_bits]), "low": low, "high": np.packbits(unary, bitorder="little")})

    @property
    def starts(self) -> np.ndarray:
        """Index of the first value with high part h, for every h; decoded when first needed."""
        if self._starts is None:
            bits = np.unpackbits(self.arrays["high"], bitorder="little")
            zeros = np.flatnonzero(bits == 0)
            ends = zeros - np.arange(len(zeros))
            self._starts = np.concatenate([[0], ends])
        return self._starts

    def low_at(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), np.uint64)
        bit = index.astype(np.int64) * self.low_bits
        words = np.ndarray((len(self.low) - 7,), "<u8", buffer=self.low, strides=(1,))
        return (words[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        """Every value."""
        if not self.n:
            return np.empty(0, np.uint64)
        counts = np.diff(self.starts)
        high = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)[: self.n]
        return (high << np.uint64(self.low_bits)) | self.low_at(np.arange(self.n))

    def find(self, values: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Index of each value, -1 if it is absent: the least successor inside its bucket, and inside [first, last)."""
        out = np.full(len(values), -1, np.int64)
        if not self.n or not len(values):
            return out
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        known = np.flatnonzero(high < len(self.starts) - 1)
        high, low = high[known], values[known] & np.uint64((1 << self.low_bits) - 1)
        a, b = self.starts[high], np.minimum(self.starts[high + 1], self.n)
        if first is not None:
            a, b = np.maximum(a, first[known]), np.minimum(b, last[known])
        b = np.maximum(a, b)
        end, open_ = b.copy(), np.flatnonzero(a < b)
        while len(open_):
            middle = (a[open_] + b[open_]) >> 1
            less = self.low_at(middle) < low[open_]
            a[open_[less]] = middle[less] + 1
            b[open_[~less]] = middle[~less]
            open_ = open_[a[open_] < b[open_]]
        inside = np.flatnonzero(a < end)
        hit = inside[self.low_at(a[inside]) == low[inside]]
        out[known[hit]] = a[hit]
        return out


def mapped(groups: dict[str, dict[str, np.ndarray]]) -> dict[str, dict[str, np.ndarray]]:
    """The same arrays in a memory-mapped file without a name: it goes with the arrays, whatever ends the task."""
    with tempfile.TemporaryFile() as file:
        places = {}
        for group, arrays in groups.items():
            for name, array in arrays.items():
                file.write(b"\0" * (-file.tell() % 8))
                places[group, name] = (file.tell(), array.dtype, len(array))
                file.write(np.ascontiguousarray(array).data)
        file.write(b"\0" * 8)
        file.flush()
        data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    out: dict[str, dict[str, np.ndarray]] = {group: {} for group in groups}
    for (group, name), (start, kind, size) in places.items():
        out[group][name] = np.frombuffer(data, kind, size, start)
    return out
