"""Equal strings of a given length in one block of bytes, by the Burrows-Wheeler transform.

Suffixes are sorted by prefix doubling, as deep as the wanted length.  On the transform, intervals
of suffixes that share a string are then extended backwards breadth first: the intervals of length
l give those of length l + 1, and the end of each new one is a place where two neighbouring
suffixes share exactly l bytes.  Common prefixes thus appear by increasing length, and the search
stops at the wanted one: neighbours not parted by then share at least that much.
"""

from __future__ import annotations

import numpy as np


def sorted_suffixes(block: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of at least their first ``depth`` bytes, and the inverse."""
    n = len(block)
    key = block.astype(np.uint64)
    for width in (1, 2, 4):  # eight bytes as one number
        after = np.zeros(n, np.uint64)
        after[: n - width] = key[width:]
        key = (key << np.uint64(8 * width)) | after
    reach = 8
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.uint64)
        new = np.ones(n, np.uint64)
        new[1:] = ranked[1:] != ranked[:-1]
        rank[order] = np.cumsum(new)
        if reach >= depth or rank[order[-1]] == n:
            return order, rank
        after = np.zeros(n, np.uint64)
        after[: n - reach] = rank[reach:]
        key = (rank << np.uint64(32)) | after
        reach *= 2


def parted(block: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix in order shares fewer than ``length`` bytes with the one before it."""
    n = len(block)
    transform = block[order - 1]  # the byte before each suffix, in a circle
    source = np.argsort(transform, kind="stable")  # where the suffix one byte shorter lies
    target = np.empty(n, np.int64)
    target[source] = np.arange(n)
    initial = transform[source]  # first byte of each suffix
    apart = np.zeros(n + 1, bool)
    low, high = np.array([0], np.int64), np.array([n], np.int64)
    for _ in range(length):
        widths = high - low
        interval = np.repeat(np.arange(len(low)), widths)
        inside = np.arange(len(interval)) - np.repeat(np.cumsum(widths) - widths, widths) + low[interval]
        keys = np.sort((interval << 32) | target[inside])
        at, interval = keys & 0xFFFFFFFF, keys >> 32
        first = np.ones(len(at), bool)
        first[1:] = (interval[1:] != interval[:-1]) | (initial[at[1:]] != initial[at[:-1]])
        starts = np.flatnonzero(first)
        low, high = at[starts], at[np.append(starts[1:], len(at)) - 1] + 1
        fresh = ~apart[high]
        low, high = low[fresh], high[fresh]
        apart[high] = True
        if not len(low):
            break
    apart[0] = True
    return apart[:n]


def classes(block: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order and the number of each one's class: equal first ``length`` bytes."""
    order, _ = sorted_suffixes(block, length)
    return order, np.cumsum(parted(block, order, length))
