"""Elias-Fano coded monotone sequences in memory-mapped files, searched in bulk.

A sequence of n values below u keeps the lowest ``l = log2(u / n)`` bits of each value
packed one after another, and the rest in unary: about ``2 + l`` bits a value. Searches
take whole arrays of queries: the place of a query's high part is found by a
select over the zeros of the unary part, its low part by binary search there.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_ONES = _BITS.sum(1)
#: place of the k-th zero or one of a byte: [byte, k] (what stands behind the last is never read)
_ZERO_AT = np.argsort(_BITS, axis=1, kind="stable")
_ONE_AT = np.argsort(1 - _BITS.astype(np.int8), axis=1, kind="stable")


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` low bits of each value, packed into 64-bit words (one spare word)."""
    n = len(values)
    out = np.zeros(n * bits // 64 + 2, U64)
    if bits == 0 or n == 0:
        return out
    at = np.arange(n, dtype=np.int64) * bits
    word, shift = at >> 6, (at & 63).astype(U64)
    np.bitwise_or.at(out, word, values << shift)
    over = (at & 63) + bits > 64
    np.bitwise_or.at(out, word[over] + 1, values[over] >> (U64(64) - shift[over]))
    return out


class EliasFano:
    """``EliasFano.build(sorted values)`` gives arrays for a file; ``EliasFano(arrays)`` reads."""

    PARTS = 3

    @staticmethod
    def build(values: np.ndarray) -> list[np.ndarray]:
        values = np.ascontiguousarray(values, U64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(1, n)).bit_length() - 1)
        high = (values >> U64(low_bits)).astype(np.int64) if low_bits < 64 else np.zeros(n, np.int64)
        size = (int(high[-1]) if n else 0) + n + 2
        flags = np.zeros(-(-size // 64) * 64, np.uint8)
        flags[high + np.arange(n)] = 1
        unary = np.packbits(flags, bitorder="little")
        lows = _pack(values & ((U64(1) << U64(low_bits)) - U64(1)), low_bits)
        return [np.array([n, low_bits, int(high[-1]) if n else -1], np.int64), lows, unary]

    def __init__(self, parts: list[np.ndarray]):
        (self.n, self.low_bits, self.top), self.lows, self.unary = (
            [int(x) for x in parts[0]], *parts[1:])
        # zeros and ones before each byte of the unary part
        self.zeros = np.concatenate([[0], np.cumsum(8 - _ONES[self.unary].astype(np.int64))])
        self.ones = np.arange(len(self.zeros)) * 8 - self.zeros

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), U64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(U64)
        x = self.lows[word] >> shift
        spill = np.where(shift > 0, self.lows[word + 1] << ((U64(64) - shift) & U64(63)), U64(0))
        return (x | spill) & ((U64(1) << U64(self.low_bits)) - U64(1))

    def _select0(self, k: np.ndarray) -> np.ndarray:
        """Bit position of the k-th zero (from 0)."""
        byte = np.searchsorted(self.zeros, k, "right") - 1
        return byte * 8 + _ZERO_AT[self.unary[byte], k - self.zeros[byte]]

    def find(self, x: np.ndarray) -> np.ndarray:
        """Position of each query's successor (the first value >= it) if that equals the
        query, else -1."""
        x = np.ascontiguousarray(x, U64)
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        high = (x >> U64(self.low_bits)).astype(np.int64)
        rows = np.flatnonzero((high <= self.top) & (high >= 0))
        if not len(rows):
            return out
        high = high[rows]
        low = x[rows] & ((U64(1) << U64(self.low_bits)) - U64(1))
        lo = np.where(high > 0, self._select0(np.maximum(high - 1, 0)) - (high - 1), 0)
        hi = self._select0(high) - high
        end = hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low(mid) < low[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        ok = lo < end
        ok[ok] = self._low(lo[ok]) == low[ok]
        out[rows[ok]] = lo[ok]
        return out

    def at(self, i: np.ndarray) -> np.ndarray:
        """Values at the positions i (used for monotone pointers: one select each)."""
        byte = np.searchsorted(self.ones, i, "right") - 1
        pos = byte * 8 + _ONE_AT[self.unary[byte], i - self.ones[byte]]
        return ((pos - i).astype(U64) << U64(self.low_bits)) | self._low(i)


def to_bytes(arrays: list[np.ndarray]) -> bytes:
    """Arrays one after another, each behind its type and length, on 8-byte borders."""
    out = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        raw = np.ascontiguousarray(a).tobytes()
        kind = a.dtype.str.encode().ljust(8)
        out.append(kind + np.array([len(raw)], np.int64).tobytes() + raw + b"\0" * (-len(raw) % 8))
    return b"".join(out)


def from_buffer(buf) -> list[np.ndarray]:
    """Views of the arrays in a buffer or memory map (nothing is copied)."""
    data = np.frombuffer(buf, np.uint8) if not isinstance(buf, np.ndarray) else buf
    out, at = [], 8
    for _ in range(int(data[:8].view(np.int64)[0])):
        kind = bytes(data[at:at + 8]).strip().decode()
        size = int(data[at + 8:at + 16].view(np.int64)[0])
        out.append(data[at + 16:at + 16 + size].view(kind))
        at += 16 + size + (-size % 8)
    return out
