"""Vectorised text helpers used inside tasks: words, rolling hashes, anchors.

All functions work on the concatenated UTF-8 bytes of a slice of an Arrow batch
(``TextBlock``), so the cost is per byte, not per document or per word. Word
and window identities are 64-bit polynomial hashes over random tables; callers
that need more combine two of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240917))
BYTE_MIX = _RNG.integers(0, 2**64, 256, dtype=U64)
_SHINGLE = _RNG.integers(0, 2**63, 64, dtype=U64) * U64(2) + U64(1)
BASE = U64(0x9E3779B97F4A7C13)          # = 3 mod 8: differences of powers keep few factors of two
BASE_INV = U64(pow(int(BASE), -1, 2**64))
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LOWER_MIX = BYTE_MIX[LOWER]
_SEPARATES = SEPARATOR.tobytes()
BLOCK_BYTES = 1 << 20

_pow = np.ones(1, U64)
_inv = np.ones(1, U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n (kept per worker)."""
    global _pow, _inv
    if len(_pow) < n:
        size = max(n, 1 << 16)
        for base, name in ((BASE, "_pow"), (BASE_INV, "_inv")):
            p = np.full(size, base, U64)
            p[0] = 1
            globals()[name] = np.multiply.accumulate(p)
    return _pow[:n], _inv[:n]


def fmix(h: np.ndarray) -> np.ndarray:
    """Final bit mixing of 64-bit hashes."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string or binary column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type)
                            else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    kind = np.int64 if wide else np.int32
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, kind, len(col) + 1, col.offset * kind().itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


class TextBlock:
    """Documents ``lo:hi`` of a batch as one byte array with offsets."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, lo: int = 0):
        self.data, self.offs, self.lo = data, offs, lo
        self.n = len(offs) - 1

    def words(self, lower: bool = False) -> "Words":
        data, offs = self.data, self.offs
        n = len(data)
        if n == 0:
            return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64),
                         np.zeros(len(offs), np.int64))
        sep = np.frombuffer(data.tobytes().translate(_SEPARATES), bool)
        filled = offs[1:] > offs[:-1]
        before = np.empty(n, bool)
        before[0] = True
        before[1:] = sep[:-1]
        before[offs[:-1][filled]] = True
        after = np.empty(n, bool)
        after[-1] = True
        after[:-1] = sep[1:]
        after[offs[1:][filled] - 1] = True
        word = ~sep
        starts = np.flatnonzero(word & before)
        ends = np.flatnonzero(word & after) + 1
        up, down = powers(n)
        sums = np.take(_LOWER_MIX if lower else BYTE_MIX, data)
        sums *= up
        np.cumsum(sums, out=sums)
        low = np.where(starts > 0, sums[starts - 1], U64(0))
        h = (sums[ends - 1] - low) * down[starts]
        return Words(starts, ends, fmix(h + (ends - starts).astype(U64)),
                     np.searchsorted(starts, offs))


class Words:
    """Words of a block: byte ranges, hashes, and each document's range of words."""

    def __init__(self, starts, ends, hashes, offs):
        self.starts, self.ends, self.hashes, self.offs = starts, ends, hashes, offs


def blocks(col: pa.Array, size: int = BLOCK_BYTES) -> Iterator[TextBlock]:
    """Whole documents of a column in blocks of about ``size`` bytes (a longer document: alone)."""
    data, offs = text_buffers(col)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, "right")) - 1)
        yield TextBlock(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], lo)
        lo = hi


def owners(offs: np.ndarray, n: int) -> np.ndarray:
    """The document of each of n positions, from the documents' offsets."""
    return np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:n]


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, 64-bit hash) of every ``size``-word shingle; a shorter non-empty
    document has its whole word sequence as its one shingle. Repeats are kept."""
    h, offs = w.hashes, w.offs
    lengths = np.diff(offs)
    doc = owners(offs, len(h))
    out_doc, out_hash = [], []
    if len(h) >= size:
        m = len(h) - size + 1
        s = np.zeros(m, U64)
        for j in range(size):
            s += h[j:j + m] * _SHINGLE[j]
        ok = doc[:m] == doc[size - 1:]
        out_doc.append(doc[:m][ok])
        out_hash.append(fmix(s[ok]))
    for d in np.flatnonzero((lengths > 0) & (lengths < size)):
        part = h[offs[d]:offs[d + 1]]
        out_doc.append(np.array([d]))
        whole = np.array([(part * _SHINGLE[:len(part)]).sum(dtype=U64)])
        out_hash.append(fmix(whole + _SHINGLE[20:21] * U64(len(part))))
    if not out_doc:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    return np.concatenate(out_doc), np.concatenate(out_hash)


def sliding(a: np.ndarray, w: int, op) -> np.ndarray:
    """out[i] = op over a[i:i+w] (windows cut at the end), by doubling."""
    out, span = a.copy(), 1
    while span * 2 <= w:
        out[:-span] = op(out[:-span], out[span:])
        span *= 2
    rest = w - span
    if rest and rest < len(out):
        out[:-rest] = op(out[:-rest], out[rest:])
    return out


class Windows:
    """Windows of ``size`` tokens over a block, seen through content-chosen anchors.

    ``tokens`` are 64-bit token values of all documents one after another and
    ``offs`` the documents' ranges. A window's anchor is the k-gram in it with the
    smallest hash (the leftmost on a tie), so equal windows hold equal anchors at equal
    places. ``at`` are the anchors; the windows of one start at ``first .. last``.
    """

    PARTS = 4

    def __init__(self, tokens: np.ndarray, offs: np.ndarray, size: int, k: int):
        n = len(tokens)
        self.size, self.k, self.offs, self.n = size, k, offs, n
        self.step = -(-(size - k + 1) // self.PARTS)
        up, down = powers(n + 1)
        self.sums = np.empty(n + 1, U64)
        self.sums[0] = 0
        np.cumsum(tokens * up[:n], dtype=U64, out=self.sums[1:])
        self.down = down
        empty = np.zeros(0, np.int64)
        self.at = self.first = self.last = self.doc = empty
        self.key = np.zeros(0, U64)
        if n < size:
            return
        grams = (self.sums[k:] - self.sums[:-k]) * down[:n - k + 1]
        order = (grams * U64(0xD6E8FEB86659FD93)) & U64(0xFFFFFFFF00000000)
        order |= np.arange(n - k + 1, dtype=U64)
        low = sliding(order, size - k + 1, np.minimum)
        ends = np.repeat(offs[1:], np.diff(offs))[:n - k + 1]
        starts = np.flatnonzero(np.arange(size, n - k + 1 + size) <= ends)
        if not len(starts):
            return
        anchor = (low[starts] & U64(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        self.at = anchor[new]
        self.first = starts[new]
        self.last = starts[np.append(new[1:], len(starts)) - 1]
        self.key = fmix(grams[self.at])
        self.doc = np.searchsorted(offs, self.at, "right") - 1

    def contexts(self) -> np.ndarray:
        """Hash of everything the anchor's windows cover, with the anchor's place in it."""
        lo, hi = self.first, self.last + self.size
        h = (self.sums[hi] - self.sums[lo]) * self.down[lo]
        place = ((self.at - lo).astype(U64) << U64(32)) + (hi - lo).astype(U64)
        return fmix(h + place * U64(0x9E3779B97F4A7C15))

    def part(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        """The anchors' windows that start ``q * step`` to ``q * step + step - 1`` before them."""
        return (np.maximum(self.first, self.at - (q + 1) * self.step + 1),
                np.minimum(self.last, self.at - q * self.step))

    def signatures(self) -> np.ndarray:
        """Per anchor four 16-bit hashes: of what all windows of a part share (0: no window).
        Two anchors hold an equal window in a part only if these are equal."""
        out = np.zeros(len(self.at), U64)
        for q in range(self.PARTS):
            lo, hi = self.part(q)
            begin = self.at - q * self.step
            end = self.at + self.size - min((q + 1) * self.step - 1, self.size - self.k)
            own = lo <= hi
            b, e = begin[own], end[own]
            h = fmix((self.sums[e] - self.sums[b]) * self.down[b])
            out[own] |= ((h >> U64(49)) + U64(1)) << U64(16 * q)
        return out

    def window_hashes(self, starts: np.ndarray) -> np.ndarray:
        h = (self.sums[starts + self.size] - self.sums[starts]) * self.down[starts]
        return fmix(h ^ U64(0xD6E8FEB86659FD93))


def expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges first..last, with the index of their range."""
    count = last - first + 1
    which = np.repeat(np.arange(len(first)), count)
    begin = np.repeat(np.cumsum(count) - count, count)
    return first[which] + np.arange(len(which)) - begin, which


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Mask of the n positions that lie in a window beginning at one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, n), -1)
    return np.cumsum(edge[:n]) > 0
