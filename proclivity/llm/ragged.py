"""Pair merging by rank over many symbol sequences at once, in flat numpy arrays."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

#: Rank of a pair that is never merged.
NONE = 1 << 30
#: Sequences with more symbols are merged one by one.
LONG = 256


@dataclass
class PairTable:
    """Pairs sorted by ``left * size + right`` with their ranks and merged symbols; negative symbols never merge."""

    size: int
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray

    @classmethod
    def of(cls, size: int, rows: list[tuple[int, int, int, int]]) -> PairTable:
        """From (left, right, rank, merged)."""
        left, right, ranks, merged = (np.array(c, np.int64) for c in zip(*rows, strict=True))
        order = np.argsort(left * size + right)
        return cls(size, (left * size + right)[order], ranks[order], merged[order])

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE where the pair is not listed) and place in the table of each pair."""
        key = np.where((left >= 0) & (right >= 0), left * self.size + right, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE), at

    def merge(self, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All sequences merged to the end: their symbols one after another, and how many each has.

        In each step every sequence merges its best-ranked pair, the leftmost of equal ones.
        """
        long = lengths > LONG
        if not long.any():
            return self._together(flat, lengths)
        parts = np.split(flat, np.cumsum(lengths)[:-1])
        short, counts = self._together(np.concatenate([flat[:0], *(p for p, x in zip(parts, long, strict=True) if not x)]), lengths[~long])
        shorts = iter(np.split(short, np.cumsum(counts)[:-1]))
        merged = [self._alone(p.tolist()) if x else next(shorts) for p, x in zip(parts, long, strict=True)]
        return np.concatenate(merged), np.array([len(m) for m in merged], np.int64)

    def _together(self, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat = flat.copy()
        if not len(flat):
            return flat, lengths.copy()
        # Symbols keep their places in ``result``; a merge writes the left place and empties the right one.
        result, alive = flat.copy(), np.ones(len(flat), bool)
        where, final = np.arange(len(flat)), lengths.copy()
        owner = np.flatnonzero(lengths)
        lengths = lengths[owner]
        starts = np.cumsum(lengths) - lengths
        ranks, at = np.full(len(flat), NONE), np.zeros(len(flat), np.int64)
        ranks[:-1], at[:-1] = self.look_up(flat[:-1], flat[1:])
        ranks[starts + lengths - 1] = NONE
        while len(flat):
            # The best rank of each sequence and, of equal ones, the leftmost place: both in one number.
            best = np.minimum.reduceat(ranks << 32 | np.arange(len(flat)), starts)
            going = best < NONE << 32
            hits = best[going] & 0xFFFFFFFF
            flat[hits] = self.merged[at[hits]]
            result[where[hits]] = flat[hits]
            alive[where[hits + 1]] = False
            keep = np.repeat(going, lengths)
            keep[hits + 1] = False
            here = (np.cumsum(keep) - 1)[hits]
            flat, ranks, at, where = flat[keep], ranks[keep], at[keep], where[keep]
            owner, lengths = owner[going], lengths[going] - 1
            starts = np.cumsum(lengths) - lengths
            final[owner] -= 1
            ranks[here] = NONE
            for pair in (here[here < starts + lengths - 1], here[here > starts] - 1):
                ranks[pair], at[pair] = self.look_up(flat[pair], flat[pair + 1])
        return result[alive], final

    def _alone(self, symbols: list[int]) -> np.ndarray:
        """One sequence of any length, in the same order of merges, with a heap."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks, at = self.look_up(np.array(symbols[:-1], np.int64), np.array(symbols[1:], np.int64))
        live: list[int | None] = list(symbols)
        heap = [
            (int(r), i, symbols[i], symbols[i + 1], int(self.merged[k]))
            for i, (r, k) in enumerate(zip(ranks, at, strict=True))
            if r < NONE
        ]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if live[i] != a or j >= n or live[j] != b:
                continue
            live[i], live[j] = new, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if right < n and live[left] >= 0 and live[right] >= 0:
                    k = int(np.searchsorted(self.keys, key := live[left] * self.size + live[right]))
                    if k < len(self.keys) and self.keys[k] == key:
                        heapq.heappush(heap, (int(self.ranks[k]), left, live[left], live[right], int(self.merged[k])))
        return np.array([s for s in live if s is not None], np.int64)
