"""Texts as bytes inside a task: Arrow columns to numpy, words, lines, and hashes of any range."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text handled at once in a task; one longer text is a piece of its own.
PIECE_BYTES = 1 << 20
BREAK = 0x0A
# Range hashes are polynomials modulo this prime, at a fixed large place.
_PRIME = (1 << 61) - 1
_PLACES = (0x1A3779B97F4A7C15, 0x0D1342543DE82EF9)
_LOW31 = np.uint64((1 << 31) - 1)
_LOW30 = np.uint64((1 << 30) - 1)
# A longer range is hashed in parts: up to this length, sums of 40-bit products fit into 64 bits.
_PART = 1 << 23

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each row begins; null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    return offsets_of(column.cast(pa.large_string()))


def utf8_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same for a column of bytes without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return offsets_of(column.cast(pa.large_binary()))


def offsets_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``limit`` bytes of text; texts are never cut."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def separated(data: np.ndarray, at: np.ndarray, gap: int = 1, fill: int = BREAK) -> tuple[np.ndarray, np.ndarray]:
    """The texts with ``gap`` filler bytes before the first and after each; where each text begins."""
    n = len(at) - 1
    out = np.full(len(data) + gap * (n + 1), fill, np.uint8)
    begins = at[:-1] + gap * np.arange(1, n + 1)
    keep = np.ones(len(out), bool)
    holes = np.concatenate([[0], at[1:] + gap * np.arange(1, n + 1)])
    for k in range(gap):
        keep[holes + k] = False
    out[keep] = data
    return out, begins


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True in a mask that begins and ends with False."""
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    return edges[0::2], edges[1::2]


def owner(begins: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The row that each position lies in."""
    return np.searchsorted(begins, positions, "right") - 1


def per_row(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Counts, or sums of whole numbers below 2**53, by row."""
    return np.bincount(rows, weights, n).astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _folded(x: np.ndarray) -> np.ndarray:
    """Modulo the prime."""
    x = (x & np.uint64(_PRIME)) + (x >> np.uint64(61))
    return np.where(x >= np.uint64(_PRIME), x - np.uint64(_PRIME), x)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a * b`` modulo the prime, both below it, in halves of 31 bits."""
    a_high, a_low = a >> np.uint64(31), a & _LOW31
    b_high, b_low = b >> np.uint64(31), b & _LOW31
    middle = a_high * b_low + a_low * b_high
    high = np.uint64(2) * a_high * b_high + (middle >> np.uint64(30))
    return _folded(high + ((middle & _LOW30) << np.uint64(31)) + a_low * b_low)


@lru_cache(maxsize=3)
def _powers(bits: int, place: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the place and of its inverse, by doubling."""
    tables = []
    for base in (place, pow(place, -1, _PRIME)):
        table = np.array([1], np.uint64)
        for k in range(bits):
            step = np.full(len(table), pow(base, 1 << k, _PRIME), np.uint64)
            table = np.concatenate([table, _product(table, step)])
        tables.append(table)
    return tables[0], tables[1]


class RangeHash:
    """Hashes of byte ranges, each in constant time: equal ranges, equal hashes.

    The bytes of a range are the coefficients of a polynomial, taken modulo 2**61 - 1 at a fixed place and
    then spread over 64 bits.  Two different ranges of n bytes share a value for at most n of all places;
    ``seed`` 1 and 2 take two places.
    """

    def __init__(self, buffer: np.ndarray, seed: int = 1):
        up, self._down = _powers(max(21, len(buffer).bit_length()), _PLACES[seed - 1])
        codes, up = buffer.astype(np.uint64) + np.uint64(1), up[: len(buffer)]
        self._low = np.zeros(len(buffer) + 1, np.uint64)
        self._high = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(codes * (up & _LOW31), out=self._low[1:])
        np.cumsum(codes * (up >> np.uint64(31)), out=self._high[1:])

    def _between(self, low: np.ndarray, high: np.ndarray, down: np.ndarray) -> np.ndarray:
        """The polynomial of a range from the sums of its halves, moved to the power 0."""
        high = _folded(high)
        moved = (high >> np.uint64(30)) + ((high & _LOW30) << np.uint64(31))
        return _product(_folded(_folded(low) + moved), down)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        starts, ends = np.asarray(starts), np.asarray(ends)
        first = np.minimum(ends, starts + _PART)
        raw = self._between(self._low[first] - self._low[starts], self._high[first] - self._high[starts], self._down[starts])
        for i in np.flatnonzero(first < ends):
            for at in range(int(first[i]), int(ends[i]), _PART):
                part = self.of(np.array([at]), np.array([min(at + _PART, int(ends[i]))]))
                raw[i : i + 1] = mix(raw[i : i + 1] + part)
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(buffer: np.ndarray, width: int) -> np.ndarray:
    """The hash of every window of ``width`` bytes, by its first byte, from eight bytes at a time."""
    n = len(buffer) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    eight = buffer.astype(np.uint64)
    for step in (1, 2, 4):  # eight bytes as one number
        eight[: len(buffer) - step] |= eight[step:] << np.uint64(8 * step)
    if width < 8:
        eight &= np.uint64((1 << 8 * width) - 1)
    whole = np.zeros(n, np.uint64)
    # The last eight bytes may overlap those before.
    for at in sorted({*range(0, max(width - 7, 1), 8), max(width - 8, 0)}):
        whole = (whole + eight[at : at + n]) * np.uint64(0x9E3779B97F4A7C15 + 2 * at)
    return mix(whole)


def arrow(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A batch of ``schema`` from arrays, numpy arrays or lists."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )
