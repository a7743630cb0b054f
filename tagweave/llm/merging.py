"""Rank-synchronous merging of symbol sequences in ragged numpy arrays.

Sequences stand one after the other in one array. Each round applies to every sequence, at once,
its lowest-rank pair, at its places from the left, up to the first merge that brings about a pair
that goes before the next one. Finished sequences leave, until none is left. Some sequences have no more than a
place or two in each round, such as long runs of a sign whose pieces all have one rank; after some rounds that
merge little of what is left, that is finished by a queue of pairs, so the work stays in proportion to the length.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np

#: A round merges little if it is less than one of so many symbols; rounds of that kind before the queue.
LITTLE, SLOW_ROUNDS = 64, 8
NEVER = np.int32(2**31 - 1)


class RankMerger:
    """Merges by a table of pairs: (left, right) -> rank and the symbol made; symbols are below ``size``."""

    def __init__(self, left: list[int], right: list[int], made: list[int], rank: list[int], size: int):
        self.size = size
        left, right, made, rank = np.array(left, np.int64), np.array(right, np.int64), np.array(made, np.int32), np.array(rank, np.int32)
        keys = left * size + right
        # an open-addressing table with room enough that most probes hit at once
        self.bits = max(4, int(len(keys) * 8).bit_length())
        slots = 1 << self.bits
        self.keys = np.full(slots, -1, np.int64)
        self.made, self.rank = np.zeros(slots, np.int32), np.full(slots, NEVER, np.int32)
        at, waiting = self._slot(keys), np.arange(len(keys))
        while len(waiting):
            chosen = waiting[self.keys[at[waiting]] == -1]
            places, first = np.unique(at[chosen], return_index=True)
            won = chosen[first]
            self.keys[places], self.made[places], self.rank[places] = keys[won], made[won], rank[won]
            waiting = np.setdiff1d(waiting, won)
            at[waiting] = (at[waiting] + 1) & (slots - 1)
        self.pairs: dict[int, tuple[int, int]] | None = None
        # a rank may go to all its places at once if whatever its symbols can merge with next comes later
        following = np.full(size, NEVER, np.int32)
        np.minimum.at(following, left, rank)
        np.minimum.at(following, right, rank)
        self.at_once = np.ones(int(rank.max(initial=0)) + 1, bool)
        self.at_once[rank[following[made] <= rank]] = False

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slots of the pairs in the table; a free slot (rank NEVER) where there is no such pair."""
        keys = a.astype(np.int64) * self.size + b
        at = self._slot(keys)
        held = self.keys[at]
        wrong = np.flatnonzero((held != keys) & (held != -1))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[wrong]]
            wrong = wrong[(held != keys[wrong]) & (held != -1)]
        return at

    def ranks(self, symbols: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Rank of each symbol with the next of its sequence."""
        out = np.full(len(symbols), NEVER, np.int32)
        if len(symbols) > 1:
            out[:-1] = np.where(part[:-1] == part[1:], self.rank[self.find(symbols[:-1], symbols[1:])], NEVER)
        return out

    def merge(self, symbols: np.ndarray, part: np.ndarray, rank: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The surviving symbols and their sequences, in order. ``part`` ascends: the number of each symbol's sequence."""
        symbols, rank = symbols.copy(), self.ranks(symbols, part) if rank is None else rank
        done: list[tuple[np.ndarray, np.ndarray]] = []
        slow = 0
        while len(symbols) and slow < SLOW_ROUNDS:
            starts, lengths = _runs(part)
            least = np.minimum.reduceat(rank, starts)
            over = least == NEVER
            if over.any():
                gone = np.repeat(over, lengths)
                done.append((symbols[gone], part[gone]))
                symbols, rank, part = symbols[~gone], rank[~gone], part[~gone]
                if not len(symbols):
                    break
                least, lengths = least[~over], lengths[~over]
            hit = np.flatnonzero(rank == np.repeat(least, lengths))
            hit = self._chosen(hit, symbols, part, rank)
            slow += LITTLE * len(hit) < len(symbols)
            symbols[hit] = self.made[self.find(symbols[hit], symbols[hit + 1])]
            stay = np.ones(len(symbols), bool)
            stay[hit + 1] = False
            at = np.cumsum(stay)[hit] - 1
            symbols, rank, part = symbols[stay], rank[stay], part[stay]
            last = len(symbols) - 1
            for places in (at, at[at > 0] - 1):  # the merged symbol's pairs with the next and the one before
                nxt = np.minimum(places + 1, last)
                same = (part[places] == part[nxt]) & (places < last)
                rank[places] = np.where(same, self.rank[self.find(symbols[places], symbols[nxt])], NEVER)
        for start, length in zip(*(a.tolist() for a in _runs(part)), strict=True):
            left = self.one_by_one(symbols[start : start + length].tolist())
            done.append((np.array(left, symbols.dtype), np.full(len(left), part[start], part.dtype)))
        if not done:
            return symbols, part
        symbols, part = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(part, kind="stable")
        return symbols[order], part[order]

    def one_by_one(self, symbols: list[int]) -> list[int]:
        """The surviving symbols of one sequence, by a queue of pairs: the lowest rank first, of equal ranks the leftmost."""
        if self.pairs is None:
            held = np.flatnonzero(self.keys >= 0)
            self.pairs = dict(zip(self.keys[held].tolist(), zip(self.rank[held].tolist(), self.made[held].tolist(), strict=True), strict=True))
        find, size, n = self.pairs.get, self.size, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [found[0] << 32 | k for k in range(n - 1) if (found := find(symbols[k] * size + symbols[k + 1]))]
        heapify(queue)
        while queue:
            rank, k = divmod(heappop(queue), 1 << 32)
            if symbols[k] < 0 or (right := after[k]) >= n:
                continue
            found = find(symbols[k] * size + symbols[right])
            if found is None or found[0] != rank:  # another pair stands there by now
                continue
            symbols[k], symbols[right] = found[1], -1
            after[k] = right = after[right]
            if right < n:
                before[right] = k
                if found := find(symbols[k] * size + symbols[right]):
                    heappush(queue, found[0] << 32 | k)
            if (left := before[k]) >= 0 and (found := find(symbols[left] * size + symbols[k])):
                heappush(queue, found[0] << 32 | left)
        return [x for x in symbols if x >= 0]

    def _chosen(self, hit: np.ndarray, symbols: np.ndarray, part: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Those of the places of each sequence's lowest rank that are merged in this round."""
        own = part[hit]
        begins = np.diff(own, prepend=-1) != 0  # the leftmost of each sequence
        if begins.all():
            return hit
        # places side by side share a symbol: from the left, every other one of such a run is merged
        run = begins | (np.diff(hit, prepend=-2) != 1)
        nth = np.arange(len(hit)) - np.flatnonzero(run)[np.cumsum(run) - 1]
        chosen = nth % 2 == 0
        hit, own, begins = hit[chosen], own[chosen], begins[chosen]
        asked = np.flatnonzero(~self.at_once[rank[hit]])
        if len(asked):
            # a merged symbol's pairs with what is on its left by then and on its right: is one of them the next to go?
            at, last = hit[asked], len(symbols) - 1
            made = self.made[self.find(symbols[at], symbols[at + 1])]
            left, right = np.maximum(at - 1, 0), np.minimum(at + 2, last)
            beside = symbols[left]
            after = np.flatnonzero((asked > 0) & (hit[asked - 1] == at - 2) & ~begins[asked])
            beside[after] = self.made[self.find(symbols[at[after] - 2], symbols[at[after] - 1])]
            goes_first = (at > 0) & (part[left] == own[asked]) & (self.rank[self.find(beside, made)] <= rank[at])
            goes_first |= (at + 2 <= last) & (part[right] == own[asked]) & (self.rank[self.find(made, symbols[right])] <= rank[at])
            stops = np.zeros(len(hit), np.int64)
            stops[asked] = goes_first
            before = np.cumsum(stops) - stops
            hit = hit[before == before[np.flatnonzero(begins)[np.cumsum(begins) - 1]]]
        return hit


def _runs(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal numbers."""
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    return starts, np.diff(np.append(starts, len(part)))
