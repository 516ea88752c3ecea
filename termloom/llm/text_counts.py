"""Counts of words, symbols, repeated lines and repeated word windows of whole texts, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import buffers

WINDOW_WORDS = 5
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
NAMES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeats(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For values told apart by row: how often each occurs, and whether it is the first of its kind."""
    keys = buffers.mix(hashes + rows.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    starts = np.flatnonzero(new)
    times, first = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    times[order] = np.repeat(np.diff(np.append(starts, len(keys))), np.diff(np.append(starts, len(keys))))
    first[order] = new
    return times, first


def count(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts named in ``NAMES`` for each text; null as empty.

    A word is a run of bytes other than ASCII blanks; ``n_lines`` are the lines with a word.
    """
    data, at = buffers.utf8(texts)
    n = len(at) - 1
    buffer, begins = buffers.separated(data, at)
    ends = begins + np.diff(at)
    inside = ~buffers.SPACE[buffer]

    def inner(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return sums[ends] - sums[begins]

    hashes = buffers.RangeHash(buffer)
    start, end = buffers.spans(inside)
    word_row = buffers.owner(begins, start)
    counts = {
        "n_words": buffers.per_row(word_row, n),
        "word_chars": inner(inside & ((buffer & 0xC0) != 0x80)),
        "n_symbols": inner(_SYMBOL[buffer]),
    }

    breaks = np.flatnonzero(buffer == buffers.BREAK)
    line_start, line_end = breaks[:-1] + 1, breaks[1:]
    worded = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end = line_start[worded], line_end[worded]
    line_row = buffers.owner(begins, line_start)
    _, first = _repeats(line_row, hashes.of(line_start, line_end))
    counts["n_lines"] = buffers.per_row(line_row, n)
    counts["n_dup_lines"] = buffers.per_row(line_row[~first], n)

    counts["n_repeat_words"] = np.zeros(n, np.int64)
    windows = len(start) - WINDOW_WORDS + 1
    if windows > 0:
        words = hashes.of(start, end)
        joined = words[:windows].copy()
        for k in range(1, WINDOW_WORDS):
            joined = joined * np.uint64(0xD1342543DE82EF95) + words[k : k + windows]
        whole = np.flatnonzero(word_row[:windows] == word_row[WINDOW_WORDS - 1 :])
        times, _ = _repeats(word_row[whole], joined[whole])
        again = whole[times > 1]
        edge = np.zeros(len(start) + 1, np.int64)
        np.add.at(edge, again, 1)
        np.add.at(edge, again + WINDOW_WORDS, -1)
        covered = np.cumsum(edge[:-1]) > 0
        counts["n_repeat_words"] = buffers.per_row(word_row[covered], n)
    return counts
