"""Algorithms on short sequences that column functions can't express; used in pandas UDFs."""

from __future__ import annotations

from functools import lru_cache


@lru_cache(maxsize=64)
def _table(length: int, least: int) -> tuple[list[int], ...]:
    """``ways[j][i]``: how many sequences of ``i`` more places there are after ``j`` places of the run at hand, if no inner run is shorter than ``least``.

    The last run may be of any length. ``j`` stops at ``least``.
    """
    ways = [[1] * (length + 1) for _ in range(least + 1)]
    for i in range(1, length + 1):
        for j in range(1, least + 1):
            stay = ways[min(j + 1, least)][i - 1]
            ways[j][i] = stay + (ways[1][i - 1] if j >= least else 0)
    return tuple(ways)


class RunCode:
    """Binary sequences of one length, none of whose runs but the first and last is of ``short`` places or fewer, as numbers and back."""

    def __init__(self, length: int, short: int):
        self.length, self.least = length, short + 1
        self.ways = _table(length, self.least)

    @property
    def size(self) -> int:
        return 2 * self.ways[self.least][self.length - 1] if self.length else 1

    def rank(self, bits: list[int]) -> int:
        """The place of a valid sequence among all, in lexicographic order."""
        if not bits:
            return 0
        n, run = bits[0] * self.ways[self.least][self.length - 1], self.least
        for k in range(1, self.length):
            left = self.length - k - 1
            same = bits[k] == bits[k - 1]
            if not same and run < self.least:
                raise ValueError("a run is too short")
            other_first = bits[k] == 1  # sequences with 0 here come before
            if other_first:
                if bits[k - 1] == 0:
                    n += self.ways[min(run + 1, self.least)][left]
                elif run >= self.least:
                    n += self.ways[1][left]
            run = min(run + 1, self.least) if same else 1
        return n

    def unrank(self, n: int) -> list[int]:
        if not 0 <= n < self.size:
            raise ValueError("no such sequence")
        if not self.length:
            return []
        half = self.ways[self.least][self.length - 1]
        bits, n, run = [int(n >= half)], n % half, self.least
        for k in range(1, self.length):
            left = self.length - k - 1
            zero_same = bits[-1] == 0
            zeros = self.ways[min(run + 1, self.least)][left] if zero_same else self.ways[1][left] if run >= self.least else 0
            if n < zeros:
                b = 0
            else:
                n -= zeros
                b = 1
            run = min(run + 1, self.least) if b == bits[-1] else 1
            bits.append(b)
        return bits


def repaired(bits: list[int], short: int) -> list[int]:
    """Inner runs of ``short`` places or fewer are merged into the run before them, the first one first, until none is left."""
    b = list(bits)
    while True:
        cuts = [0, *[i for i in range(1, len(b)) if b[i] != b[i - 1]], len(b)]
        bad = next((k for k in range(1, len(cuts) - 2) if cuts[k + 1] - cuts[k] <= short), None)
        if bad is None:
            return b
        for i in range(cuts[bad], cuts[bad + 1]):
            b[i] = b[cuts[bad] - 1]
