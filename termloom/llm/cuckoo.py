"""Cuckoo filters in numpy: batches of 64-bit keys are added, removed and looked up at once."""

from __future__ import annotations

import numpy as np

from .buffers import mix

SLOTS = 4
_MAX_ROUNDS = 500


class CuckooFilter:
    """A set of 16-bit fingerprints in buckets of four, each in one of two buckets.

    Never misses a key that was added and not removed; a foreign key is found with a chance below
    2 * SLOTS / 65535 per table.  A key must be removed as often as it was added.  When a table is
    full another of the same size is chained, so adding always succeeds.
    """

    def __init__(self, capacity: int = 0, tables: list[np.ndarray] | None = None):
        if tables is None:
            buckets = 1 << max(4, (int(capacity / (0.8 * SLOTS)) - 1).bit_length() if capacity > 1 else 4)
            tables = [np.zeros((buckets, SLOTS), np.uint16)]
        self.tables = tables
        self._mask = np.uint64(len(tables[0]) - 1)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashed = mix(np.asarray(keys).view(np.uint64))
        marks = (hashed >> np.uint64(48)).astype(np.uint16)
        marks[marks == 0] = 1  # 0 is an empty slot
        return marks, (hashed & self._mask).astype(np.int64)

    def _other(self, bucket: np.ndarray, marks: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(marks.astype(np.uint64)) & self._mask).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        marks, first = self._places(keys)
        second = self._other(first, marks)
        found = np.zeros(len(marks), bool)
        for table in self.tables:
            found |= (table[first] == marks[:, None]).any(1) | (table[second] == marks[:, None]).any(1)
        return found

    def add(self, keys: np.ndarray) -> None:
        marks, at = self._places(keys)
        while True:
            marks, at = self._fill(self.tables[-1], marks, at)
            if not len(marks):
                return
            self.tables.append(np.zeros_like(self.tables[0]))

    def _fill(self, table: np.ndarray, marks: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put marks into a table; returns those left over."""
        for turn in range(_MAX_ROUNDS):
            if not len(marks):
                break
            order = np.argsort(at, kind="stable")
            marks, at = marks[order], at[order]
            starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            rank = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
            free = table[at] == 0
            fits = rank < free.sum(1)
            # the rank-th free slot of the bucket
            slot = np.argmax(np.cumsum(free, 1) > rank[:, None], 1)
            table[at[fits], slot[fits]] = marks[fits]
            marks, at, rank = marks[~fits], at[~fits], rank[~fits]
            if turn and len(marks):
                # in a full bucket the first one waiting changes places with a mark that lies there
                lowest = np.concatenate([[True], at[1:] != at[:-1]])
                victim = (turn + at) % SLOTS
                out = table[at[lowest], victim[lowest]]
                table[at[lowest], victim[lowest]] = marks[lowest]
                marks[lowest] = out
            at = self._other(at, marks)
        return marks, at

    def remove(self, keys: np.ndarray) -> None:
        marks, first = self._places(keys)
        second = self._other(first, marks)
        waiting = np.arange(len(marks))
        for table in self.tables:
            for bucket in (first, second):
                waiting = _clear(table, marks, bucket, waiting)

    def to_bytes(self) -> bytes:
        head = np.array([len(self.tables), len(self.tables[0])], np.int64)
        return head.tobytes() + b"".join(t.tobytes() for t in self.tables)

    @classmethod
    def from_bytes(cls, content: bytes) -> CuckooFilter:
        n, buckets = np.frombuffer(content, np.int64, 2)
        slots = np.frombuffer(content, np.uint16, offset=16).copy().reshape(n, buckets, SLOTS)
        return cls(tables=list(slots))


def _clear(table: np.ndarray, marks: np.ndarray, bucket: np.ndarray, waiting: np.ndarray) -> np.ndarray:
    """Empty one slot for each waiting key whose mark lies in its bucket; returns the others.

    Marks that are alike and share one bucket share both, so it does not matter which is taken.
    """
    missed = []
    while len(waiting):
        # in each turn one key of every bucket
        one = np.unique(bucket[waiting], return_index=True)[1]
        turn, waiting = waiting[one], np.delete(waiting, one)
        alike = table[bucket[turn]] == marks[turn][:, None]
        found = alike.any(1)
        table[bucket[turn[found]], np.argmax(alike[found], 1)] = 0
        missed.append(turn[~found])
    return np.concatenate(missed) if missed else waiting
