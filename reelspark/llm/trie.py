"""X-fast tries over whole-number keys of many entities at once, as hash tables in numpy arrays.

A trie holds every prefix of every key, by level, in one hash table, with the first and the last key below it. The longest
prefix that a query shares with the keys of its entity is found by binary search on the prefix length, which is a few table
look-ups for any number of keys; predecessor and successor follow from the prefix's keys and the order of all keys.
"""

from __future__ import annotations

import numpy as np

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Table:
    """An open-addressing hash table from different whole numbers to their places in the array given."""

    def __init__(self, keys: np.ndarray) -> None:
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = keys
        self.slot = np.full(1 << self.bits, -1, np.int64)
        todo, at = np.arange(len(keys)), self._home(keys)
        while len(todo):
            free = self.slot[at] < 0
            self.slot[at[free]] = todo[free]
            lost = self.slot[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        x = keys.astype(np.uint64)
        return (((x ^ (x >> np.uint64(32))) * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 if it is not there."""
        out = np.full(len(keys), -1)
        todo, at = np.arange(len(keys)), self._home(keys)
        while len(todo):
            held = self.slot[at]
            there = held >= 0
            hit = there.copy()
            hit[there] = self.keys[held[there]] == keys[todo[there]]
            out[todo[hit]] = held[hit]
            on = there & ~hit
            todo, at = todo[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out


class XFastTrie:
    """Tries of ``bits``-bit keys, one for each entity. ``entity`` and ``key`` are sorted, their pairs differ.

    ``bits`` plus the bits of the largest entity number must stay below 57.
    """

    def __init__(self, entity: np.ndarray, key: np.ndarray, bits: int) -> None:
        self.bits, self.entity, self.key = bits, entity.astype(np.int64), key.astype(np.int64)
        names, low, high = [], [], []
        for level in range(bits + 1):  # prefixes of so many bits
            prefix = self._name(self.entity, self.key >> (bits - level), level)
            new = np.ones(len(prefix), bool)
            new[1:] = prefix[1:] != prefix[:-1]
            first = np.flatnonzero(new)
            names.append(prefix[first])
            low.append(first)
            high.append(np.append(first[1:], len(prefix)) - 1)
        self.low, self.high = np.concatenate(low), np.concatenate(high)
        self.table = Table(np.concatenate(names))

    def _name(self, entity: np.ndarray, prefix: np.ndarray, level: np.ndarray | int) -> np.ndarray:
        return (((entity << self.bits) | prefix) << 6) | level

    def around(self, entity: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the equal key, the predecessor and the successor of each query among the keys of its entity, -1 if none."""
        n = len(entity)
        node = self.table.find(self._name(entity, np.zeros(n, np.int64), 0))  # the root: -1 for an unknown entity
        least, most = np.zeros(n, np.int64), np.where(node >= 0, self.bits, 0)
        while (least < most).any():
            mid = (least + most + 1) // 2
            hit = self.table.find(self._name(entity, key >> (self.bits - mid), mid))
            found = (hit >= 0) & (least < most)
            node = np.where(found, hit, node)
            most = np.where(~found & (least < most), mid - 1, most)
            least = np.where(found, mid, least)
        known = node >= 0
        exact = known & (least == self.bits)
        low, high = self.low[np.maximum(node, 0)], self.high[np.maximum(node, 0)]
        after = (key >> np.maximum(self.bits - 1 - least, 0)) & 1  # the bit that no key has after this prefix
        before = np.where(exact, low - 1, np.where(after == 1, high, low - 1))
        behind = np.where(exact, high + 1, np.where(after == 1, high + 1, low))
        mine = lambda at: known & (at >= 0) & (at < len(self.key)) & (self.entity[np.clip(at, 0, max(len(self.key) - 1, 0))] == entity) if len(self.key) else np.zeros(n, bool)
        return np.where(exact, low, -1), np.where(mine(before), before, -1), np.where(mine(behind), behind, -1)
