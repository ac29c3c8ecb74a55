"""Pair merging over many short sequences at once, on flat numpy arrays.

A batch of sequences is one array of symbols with offsets. Each round finds the best rank of every sequence's
neighbouring pairs (a segmented minimum), merges all its leftmost, non-overlapping occurrences in all sequences
together, and compacts the arrays. A sequence leaves when none of its pairs is in the table.

Merging one occurrence at a time gives the same symbols unless a merge makes a pair of the same or a better rank
while other occurrences wait. The round looks for just that, and such a sequence is redone one merge at a time.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np

NONE = np.iinfo(np.int32).max
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Rank and product of a pair of symbols, in an open hash table that is probed for whole arrays."""

    def __init__(self, left: Iterable[int], right: Iterable[int], rank: Iterable[int], product: Iterable[int]):
        keys = (np.asarray(left, np.uint64) << np.uint64(32)) | np.asarray(right, np.uint64)
        keys, first = np.unique(keys, return_index=True)
        rank, product = np.asarray(rank, np.int32)[first], np.asarray(product, np.int32)[first]
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.rank = np.full(1 << bits, NONE, np.int32)
        self.product = np.full(1 << bits, -1, np.int32)
        slot, left_over = self._slot(keys), np.arange(len(keys))
        while len(left_over):
            at = slot[left_over]
            free = self.key[at] == np.uint64(0xFFFFFFFFFFFFFFFF)
            _, first = np.unique(np.where(free, at, -1 - left_over), return_index=True)
            put = first[free[first]]
            self.key[at[put]] = keys[left_over[put]]
            self.rank[at[put]], self.product[at[put]] = rank[left_over[put]], product[left_over[put]]
            stay = np.ones(len(left_over), bool)
            stay[put] = False
            left_over = left_over[stay]
            slot[left_over] = (slot[left_over] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE`` if absent) and product of each pair."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(keys)
        seen = self.key[slot]
        open_ = np.flatnonzero((seen != keys) & (seen != np.uint64(0xFFFFFFFFFFFFFFFF)))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            seen = self.key[slot[open_]]
            open_ = open_[(seen != keys[open_]) & (seen != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return self.rank[slot], self.product[slot]

    def find_one(self, left: int, right: int) -> tuple[int, int]:
        rank, product = self.find(np.array([left]), np.array([right]))
        return int(rank[0]), int(product[0])


def merge_in_order(symbols: list[int], table: PairTable) -> list[int]:
    """One merge at a time: the best rank first, the leftmost of equals."""
    n = len(symbols)
    symbols, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            rank, product = table.find_one(symbols[i], symbols[j])
            if rank != NONE:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[j], product))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, b, product = heapq.heappop(heap)
        if not alive[i] or symbols[i] != a or after[i] >= n or symbols[after[i]] != b:
            continue
        j = after[i]
        symbols[i], alive[j], after[i] = product, False, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [s for s, a in zip(symbols, alive) if a]


def _runs_even(at: np.ndarray) -> np.ndarray:
    """Every other position of each run of neighbouring positions, from its first."""
    fresh = np.empty(len(at), bool)
    fresh[:1] = True
    fresh[1:] = at[1:] != at[:-1] + 1
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
    return at[(np.arange(len(at)) - begin) % 2 == 0]


def merge_all(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merged symbols of all sequences, flat and in order, and the new lengths. Empty sequences stay empty."""
    n = len(lengths)
    first = np.concatenate(([0], np.cumsum(lengths)))
    given, sym = symbols, symbols.astype(np.int32)
    own = np.repeat(np.arange(n), lengths)
    ended: list[tuple[np.ndarray, np.ndarray]] = []
    apart: list[int] = []
    rank = np.full(len(sym), NONE, np.int32)
    product = np.full(len(sym), -1, np.int32)
    inner = np.flatnonzero(own[1:] == own[:-1]) if len(own) else np.empty(0, np.int64)
    rank[inner], product[inner] = table.find(sym[inner], sym[inner + 1])
    while len(sym):
        starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        sizes = np.diff(np.append(starts, len(sym)))
        best = np.minimum.reduceat(rank, starts)
        done = best == NONE
        if done.any():
            out = np.repeat(done, sizes)
            ended.append((own[out], sym[out]))
            sym, own, rank, product = sym[~out], own[~out], rank[~out], product[~out]
            best, sizes = best[~done], sizes[~done]
            if not len(sym):
                break
        best = np.repeat(best, sizes)
        at = _runs_even(np.flatnonzero(rank == best))
        limit = best[at]
        # A merged symbol next to the first symbol of the following merge, before that one is merged.
        close = np.flatnonzero((at[1:] == at[:-1] + 2) & (own[at[1:]] == own[at[:-1]]))
        bad = []
        if len(close):
            between, _ = table.find(product[at[close]], sym[at[close + 1]])
            bad.append(own[at[close[between <= limit[close]]]])
        many = np.zeros(len(at), bool)
        same = own[at[1:]] == own[at[:-1]]
        many[1:] |= same
        many[:-1] |= same
        sym[at] = product[at]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        place = np.cumsum(keep)[at] - 1
        sym, own, rank, product = sym[keep], own[keep], rank[keep], product[keep]
        rank[place] = NONE
        right = place[place + 1 < len(sym)]
        right = right[own[right] == own[right + 1]]
        left = place[place > 0] - 1
        left = left[own[left] == own[left + 1]]
        again = np.concatenate((left, right))
        rank[again], product[again] = table.find(sym[again], sym[again + 1])
        for near in (place, np.maximum(place - 1, 0)):
            bad.append(own[place[many & (rank[near] <= limit) & (own[near] == own[place])]])
        bad = np.unique(np.concatenate(bad))
        if len(bad):
            apart += bad.tolist()
            stay = ~np.isin(own, bad)
            sym, own, rank, product = sym[stay], own[stay], rank[stay], product[stay]
    for i in apart:
        out = np.array(merge_in_order(given[first[i] : first[i + 1]].tolist(), table), np.int32)
        ended.append((np.full(len(out), i), out))
    if not ended:
        return np.empty(0, np.int32), np.zeros(n, np.int64)
    own, sym = (np.concatenate(x) for x in zip(*ended))
    order = np.argsort(own, kind="stable")
    return sym[order], np.bincount(own, minlength=n)


def gather(values: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Slices ``values[offsets[i]:offsets[i + 1]]`` for each ``i`` of ``index``, one after the other."""
    sizes = offsets[index + 1] - offsets[index]
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return values[:0]
    return values[np.repeat(offsets[index] - ends + sizes, sizes) + np.arange(ends[-1])]
