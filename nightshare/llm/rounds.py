"""Vectorised merge rounds of byte-pair encoding over flat symbol arrays."""

from __future__ import annotations

import heapq

import numpy as np

NONE = np.iinfo(np.int32).max
#: Words of more symbols merge by a heap of their own: rounds would take their length squared.
LONGEST = 256


def pair(a, b):
    """Two symbols or letters as one number."""
    return a * (1 << 25) + b if isinstance(a, int) else a.astype(np.int64) * (1 << 25) + b


class Lookup:
    """Whole numbers to whole numbers for arrays at once: a hash table with linear probing; -1 where a key is missing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        todo = np.arange(len(keys))
        at = self.place(keys)
        while len(todo):
            free = np.flatnonzero(self.keys[at[todo]] < 0)
            slots, one = np.unique(at[todo[free]], return_index=True)
            won = todo[free[one]]
            self.keys[slots], self.values[slots] = keys[won], values[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self.place(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], np.int32(-1))
        todo = np.flatnonzero((held != keys) & (held >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
            held = self.keys[at[todo]]
            out[todo] = np.where(held == keys[todo], self.values[at[todo]], np.int32(-1))
            todo = todo[(held != keys[todo]) & (held >= 0)]
        return out


class MergeRounds:
    """Needs ``pairs`` (pair -> merged symbol, -1 if none) and ``rank`` (by merged symbol, smallest first)."""

    pairs: Lookup
    rank: np.ndarray

    def merge(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols left when no pair remains, the part each belongs to), in order."""
        lengths = np.diff(bounds)
        done, owners = [], []
        for p in np.flatnonzero(lengths > LONGEST):
            left = self.merge_long(symbols[bounds[p] : bounds[p + 1]])
            done.append(left), owners.append(np.full(len(left), p))
        part = np.flatnonzero((lengths > 0) & (lengths <= LONGEST))
        owner = np.repeat(np.arange(len(lengths)), lengths)
        keep = (lengths <= LONGEST)[owner]
        symbols, lengths = symbols[keep], lengths[part]
        last = np.zeros(len(symbols), bool)
        last[np.cumsum(lengths) - 1] = True
        into = np.full(len(symbols), -1, np.int32)
        at = np.flatnonzero(~last)
        into[at] = self.pairs.get(pair(symbols[at], symbols[at + 1]))
        while len(symbols):
            rank = np.where(into >= 0, self.rank[into], NONE)
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            best = np.minimum.reduceat(rank, starts)
            live = best < NONE
            if not live.all():
                stays = np.repeat(live, lengths)
                done.append(symbols[~stays]), owners.append(np.repeat(part[~live], lengths[~live]))
                symbols, into, last, rank = symbols[stays], into[stays], last[stays], rank[stays]
                part, lengths, best = part[live], lengths[live], best[live]
                if not len(symbols):
                    break
            word = np.repeat(np.arange(len(part)), lengths)
            equal = np.flatnonzero(rank == best[word])
            first = equal[np.concatenate([[True], word[equal[1:]] != word[equal[:-1]]])]
            symbols[first] = into[first]
            last[first] = last[first + 1]
            gone = np.ones(len(symbols), bool)
            gone[first + 1] = False
            first -= np.arange(len(first))
            symbols, into, last = symbols[gone], into[gone], last[gone]
            lengths = lengths - 1
            into[first] = -1
            at = first[~last[first]]
            before = first[first > 0] - 1
            at = np.concatenate([at, before[~last[before]]])
            into[at] = self.pairs.get(pair(symbols[at], symbols[at + 1]))
        if not done:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(done)[order], owner[order]

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """One long part: pairs wait in a heap by rank and place, neighbours are linked."""
        held = symbols.astype(np.int64)
        after, before = list(range(1, len(held) + 1)), list(range(-1, len(held) - 1))
        found = self.pairs.get(pair(held[:-1], held[1:]))
        value = held.tolist()
        heap = [(int(self.rank[i]), at, value[at], value[at + 1], int(i)) for at, i in enumerate(found.tolist()) if i >= 0]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}
        while heap:
            _, at, a, b, i = heapq.heappop(heap)
            nxt = after[at]
            if value[at] != a or nxt >= len(value) or value[nxt] != b:
                continue
            value[at], value[nxt] = i, -1
            after[at] = after[nxt]
            if after[nxt] < len(value):
                before[after[nxt]] = at
            for x, y in ((before[at], at), (at, after[at])):
                if x < 0 or y >= len(value):
                    continue
                key = value[x], value[y]
                if key not in known:
                    known[key] = int(self.pairs.get(np.array([pair(*key)], np.int64))[0])
                if known[key] >= 0:
                    heapq.heappush(heap, (int(self.rank[known[key]]), x, *key, known[key]))
        return np.array([v for v in value if v >= 0], np.int32)
