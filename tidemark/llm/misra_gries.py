"""Misra-Gries summaries of 64-bit keys: counters that bound from below how often a key occurs, and can be merged."""

from __future__ import annotations

import numpy as np


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, ascending, with the sum of its counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


class Summary:
    """At most `capacity` counters; what was taken off any counter is at most `lost`.

    Each reduction takes the same amount off more than `capacity` counters, so `lost` is less than the mass divided by
    the capacity, however many summaries are merged into one. A key that occurs more often than that has a counter.
    New entries are gathered until they are as many as the counters, so that a reduction costs little for each.
    """

    def __init__(self, capacity: int, gathered: int = 1 << 16):
        self.capacity, self.gathered, self.lost = capacity, max(capacity, gathered), 0
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Counts of keys, which may repeat; the counters of another summary of the same capacity are added alike."""
        self.waiting.append((keys, counts))
        self.n_waiting += len(keys)
        if self.n_waiting > self.gathered:
            self.reduce()

    def reduce(self) -> None:
        parts = [(self.keys, self.counts), *self.waiting]
        self.keys, self.counts = summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
        self.waiting, self.n_waiting = [], 0
        if len(self.keys) > self.capacity:
            off = np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1]
            stay = self.counts > off
            self.keys, self.counts, self.lost = self.keys[stay], self.counts[stay] - off, self.lost + int(off)

    def at_least(self, threshold: int) -> np.ndarray:
        """Every key that may occur `threshold` times: all that do, and few others."""
        self.reduce()
        return self.keys[self.counts + self.lost >= threshold]


def capacity_for(mass: int, threshold: int, slack: int = 8) -> int:
    """Counters that suffice for all keys of `threshold` occurrences, times `slack`, so that few rarer keys stay."""
    return slack * (mass // threshold + 1)
