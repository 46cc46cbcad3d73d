"""Lyndon arrays by the first phase of Baier's suffix sorter, and runs from Lyndon roots."""

from __future__ import annotations

from array import array

import numpy as np


def lyndon_array(letters: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each position (smaller letters first).

    Baier's grouping: suffixes start grouped by their first letter. Groups are taken from the
    highest to the lowest, including those made on the way. For every member the nearest
    position before it in a lower group is found by following such pointers of members
    already taken. Positions pointed at by ``k`` members of the group have their own prefix
    followed by the group's prefix ``k`` times: they move to a new group directly above their
    old one, higher for larger ``k``. A member's prefix, when its group is taken, is its longest
    Lyndon prefix.
    """
    n = len(letters)
    if n == 0:
        return np.zeros(0, np.int64)
    order = np.argsort(letters, kind="stable").astype(np.int32)
    new = np.flatnonzero(np.diff(letters[order])) + 1
    bounds = np.concatenate([[0], new, [n]]).tolist()
    first = len(bounds) - 1                        # groups of one letter; their members stay in order
    rank = np.zeros(n, np.int32)
    rank[new] = 1
    begin = np.empty(n, np.int32)
    begin[order] = np.cumsum(rank)
    group = array("i", begin.tobytes())
    size = array("i", [1]) * first                 # length of a group's common prefix
    below = array("i", range(-1, first - 1))
    above = array("i", range(1, first + 1))
    above[first - 1] = -1
    moved_to: dict[int, list[int]] = {}            # members of groups made on the way
    taken = bytearray(n)
    lower = array("i", [-1]) * n
    out = array("i", [0]) * n
    g = first - 1
    while g >= 0:
        length = size[g]
        found, counts = [], []
        last = -1
        for i in moved_to.pop(g) if g >= first else order[bounds[g]:bounds[g + 1]].tolist():
            if group[i] != g:                      # moved to a higher group since
                continue
            out[i] = length
            j = i - 1
            while j >= 0 and taken[j]:
                j = lower[j]
            lower[i] = j
            taken[i] = 1
            if j < 0:
                continue
            if j == last:
                counts[-1] += 1
            else:
                found.append(j)
                counts.append(1)
                last = j
        moves: dict = {}
        for j, k in zip(found, counts):
            moves.setdefault((k, group[j]), []).append(j)
        for k, old in sorted(moves, reverse=True):
            fresh, up = len(size), above[old]
            moved_to[fresh] = moves[k, old]
            size.append(size[old] + k * length)
            below.append(old)
            above.append(up)
            above[old] = fresh
            if up >= 0:
                below[up] = fresh
            for j in moves[k, old]:
                group[j] = fresh
        g = below[g]
    return np.frombuffer(out, np.int32).astype(np.int64)


class Extensions:
    """Longest common extensions of pairs of positions, by prefix sums modulo two primes."""

    PRIMES = (2147483647, 2147483629)
    BASES = (1103515245, 1566083941)

    def __init__(self, letters: np.ndarray):
        n = self.n = len(letters)
        self.sums, self.powers = [], []
        value = letters.astype(np.uint64) + np.uint64(1)
        for prime, base in zip(self.PRIMES, self.BASES):
            p = np.uint64(prime)
            power = np.ones(1, np.uint64)
            while len(power) < n + 1:
                power = np.concatenate([power, power * (power[-1] * np.uint64(base) % p) % p])
            power = power[:n + 1]
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(value % p * power[:n] % p, out=total[1:])
            self.sums.append(total % p)
            self.powers.append(power)

    def same(self, i: np.ndarray, j: np.ndarray, size) -> np.ndarray:
        """Whether ``size`` letters from i equal those from j (i < j)."""
        ok = np.ones(len(i), bool)
        for prime, total, power in zip(self.PRIMES, self.sums, self.powers):
            p = np.uint64(prime)
            a = (total[i + size] + p - total[i]) % p * power[j - i] % p
            ok &= a == (total[j + size] + p - total[j]) % p
        return ok

    def _longest(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
        got = np.zeros(len(i), np.int64)
        step = 1 << int(limit.max(initial=0)).bit_length()
        while step:
            at = np.flatnonzero(got + step <= limit)
            if len(at):
                shift = -(got[at] + step) + 1 if back else got[at]
                ok = self.same(i[at] + shift, j[at] + shift, step)
                got[at[ok]] += step
            step >>= 1
        return got

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Letters that agree from i and j (i < j) onwards."""
        return self._longest(i, j, self.n - j, False)

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Letters that agree up to and with i and j (i < j), backwards."""
        return self._longest(i, j, i + 1, True)


def runs(letters: np.ndarray, least: int) -> np.ndarray:
    """(start, length, period) of every run of at least ``least`` letters, sorted.

    Every run holds a square of a Lyndon word of one of the two orders of the alphabet, as
    long as its period, that is the longest Lyndon word where it starts. So the Lyndon arrays of
    both orders name a root for every run, which is extended to both sides.
    """
    n = len(letters)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    at = np.arange(n)
    start = np.concatenate([at, at])
    period = np.concatenate([lyndon_array(letters), lyndon_array(letters.max() - letters)])
    ok = start + period < n
    start, period = start[ok], period[ok]
    next_ = start + period
    ok = (letters[start] == letters[next_]) | ((start > 0) & (letters[start - 1] == letters[next_ - 1]))
    start, period = start[ok], period[ok]
    reach = Extensions(letters)
    right = reach.right(start, start + period)
    left = np.zeros(len(start), np.int64)
    inner = np.flatnonzero(start > 0)
    left[inner] = reach.left(start[inner] - 1, start[inner] - 1 + period[inner])
    length = left + period + right
    ok = length >= np.maximum(least, 2 * period)
    found = np.stack([start - left, length, period], axis=1)[ok]
    return np.unique(found[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


__all__ = ["lyndon_array", "Extensions", "runs"]
