"""Near-duplicate documents by SimHash fingerprints.

A fingerprint is cut into 2-bit segments, and each segment is mapped to its number of set bits: a
point in a 32-dimensional grid.  A differing bit moves one coordinate by at most 1, so the
Manhattan distance of two points never exceeds the Hamming distance of their fingerprints.  The
coordinates lie in ``GROUPS`` groups.  Points at a distance of at most ``d`` differ in at most
``d`` groups and therefore share the grid cell of some ``GROUPS - d`` groups: the join is on those
cells, the Manhattan distance prunes inside a cell, and the Hamming distance decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.plans.sizing import broadcast_limit

from . import buffers
from .components import components
from .storage import free_prefix, id_out, id_text, settle

SHINGLE_WORDS = 4
MAX_BITS = 4
GROUPS = 7
HASH_SEED = 42
_SEGMENTS = 32
_LOW = 0x5555555555555555
# Cells up to this size are compared pair by pair, larger ones by a search that spares members.
_SMALL_CELL = 32
# Cells above this size are divided further.
HOT_CELL = 1 << 16
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_BLOCK = 1 << 16


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits."""
    total = np.zeros(64, np.int64)
    for start in range(0, len(hashes), _BLOCK):
        block = hashes[start : start + _BLOCK]
        bits = np.unpackbits(block.view(np.uint8), bitorder="little").view(np.uint64)
        bits = bits.reshape(len(block), 8)  # eight counters of a byte each to a number
        for part in range(0, len(block), 255):
            total += np.add.reduce(bits[part : part + 255], axis=0).view(np.uint8)
    return total


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    width = min(width, len(words))
    ranges = map(slice, starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    count = len(words) - width + 1
    shingles = map(joined.__getitem__, ranges)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(HASH_SEED)), np.uint64, count)
    majority = 2 * _set_bits(hashes) > count
    return int(np.packbits(majority, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fingerprint`` (as a signed long) of every whole text, row by row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.pieces(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            values = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            yield buffers.arrow(schema, batch.column("doc_id"), values)

    return id_text(docs, key, text).mapInArrow(rows, "doc_id bigint, fingerprint bigint")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def embedded(value: Column) -> Column:
    """Set bits per segment in unary: their XOR has as many bits as the Manhattan distance."""
    low = F.lit(_LOW)
    other = F.shiftrightunsigned(value, 1)
    either = value.bitwiseOR(other).bitwiseAND(low)
    both = value.bitwiseAND(other).bitwiseAND(low)
    return either.bitwiseOR(F.shiftleft(both, 1))


def _embedded(values: np.ndarray) -> np.ndarray:
    low, one = np.uint64(_LOW), np.uint64(1)
    other = values >> one
    return ((values | other) & low) | (((values & other) & low) << one)


def cell_masks(groups: int = GROUPS, max_bits: int = MAX_BITS) -> list[int]:
    """The coordinates, as bits, of every choice of ``groups - max_bits`` groups."""
    bounds = [_SEGMENTS * g // groups for g in range(groups + 1)]
    masks = [((1 << 2 * b) - 1) ^ ((1 << 2 * a) - 1) for a, b in zip(bounds, bounds[1:])]
    return [sum(chosen) for chosen in combinations(masks, groups - max_bits)]


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Where two fingerprints are near: first by the lower bound, then exactly."""
    at = np.flatnonzero(np.bitwise_count(_embedded(a) ^ _embedded(b)) <= max_bits)
    if a.ndim == 0 or len(a) == 1:
        return at[np.bitwise_count(a ^ b[at]) <= max_bits]
    return at[np.bitwise_count(a[at] ^ b[at]) <= max_bits]


def _small_cells(cells: np.ndarray, values: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    at, lag = np.arange(len(cells)), 1
    while True:
        at = at[at + lag < len(cells)]
        at = at[cells[at] == cells[at + lag]]
        if not len(at):
            return
        near = at[_near(values[at], values[at + lag], max_bits)]
        if len(near):
            yield values[near], values[near + lag]
        lag += 1


def _large_cell(values: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Stars that connect whatever is linked within one cell.

    Each member is taken off the list as soon as it is reached, so a dense group costs few
    comparisons and gives one link per member.
    """
    left = values
    while len(left):
        root, left = left[:1], left[1:]
        waiting = [root]
        while waiting and len(left):
            members = waiting.pop()
            for k in range(len(members)):
                found = _near(members[k : k + 1], left, max_bits)
                if len(found):
                    reached = left[found]
                    yield np.repeat(root, len(reached)), reached
                    left = np.delete(left, found)
                    waiting.append(reached)
                    if not len(left):
                        break


def links_in_cells(max_bits: int):
    """For tasks that get ``cell, value`` sorted by cell: links, all of a cell connected as it should be."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            waiting.append((batch.column("cell").to_numpy(), batch.column("value").to_numpy().view(np.uint64)))
            if waiting[0][0][0] == waiting[-1][0][-1]:
                continue  # still inside one cell
            cells, values = (np.concatenate(x) for x in zip(*waiting))
            cut = int(np.searchsorted(cells, cells[-1]))
            yield from _linked(cells[:cut], values[:cut], max_bits)
            waiting = [(cells[cut:], values[cut:])]
        if waiting:
            yield from _linked(*(np.concatenate(x) for x in zip(*waiting)), max_bits)

    return rows


def _linked(cells: np.ndarray, values: np.ndarray, max_bits: int) -> Iterator[pa.RecordBatch]:
    starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    sizes = np.diff(np.append(starts, len(cells)))
    small = np.repeat((sizes > 1) & (sizes <= _SMALL_CELL), sizes)
    found = list(_small_cells(cells[small], values[small], max_bits))
    for k in np.flatnonzero(sizes > _SMALL_CELL):
        found.extend(_large_cell(values[starts[k] : starts[k] + sizes[k]], max_bits))
    if found:
        pairs = np.stack([np.concatenate(side) for side in zip(*found)], axis=1)
        pairs = np.unique(pairs.view(np.int64), axis=0)
        yield buffers.arrow(_LINKS, pairs[:, 0], pairs[:, 1])


def links(values: DataFrame, column: str = "fingerprint", max_bits: int = MAX_BITS, groups: int = GROUPS) -> DataFrame:
    """Links ``a, b`` between different fingerprints that connect all those ``max_bits`` apart or less.

    A cell gives a spanning star where it is large, so a ball of many copies does not give all its
    pairs; any two fingerprints within ``max_bits`` share a cell and end in one component.  A cell
    with more than ``HOT_CELL`` fingerprints is divided: of ``max_bits + 1`` parts of the 64 bits
    two near fingerprints share one, so each part's bits name a smaller cell.
    """
    point = embedded(F.col(column))
    keys = [F.xxhash64(F.lit(i), point.bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(cell_masks(groups, max_bits))]
    cells = values.select(F.col(column).alias("value"), F.explode(F.array(*keys)).alias("cell"))
    hot = settle(cells.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > HOT_CELL).select("cell"))
    n_hot = hot.count()
    if n_hot:
        few = 64 * n_hot <= broadcast_limit(values.sparkSession)
        hot = F.broadcast(hot) if few else hot
        bounds = [64 * part // (max_bits + 1) for part in range(max_bits + 2)]
        masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(bounds, bounds[1:])]
        smaller = [
            F.xxhash64("cell", F.lit(i), F.col("value").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)
        ]
        divided = cells.join(hot, "cell").select("value", F.explode(F.array(*smaller)).alias("cell"))
        cells = cells.join(hot, "cell", "left_anti").select("value", "cell").unionAll(divided)
    sorted_cells = cells.repartition("cell").sortWithinPartitions("cell")
    return sorted_cells.mapInArrow(links_in_cells(max_bits), "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Words are runs of other than ASCII blanks, A-Z lower-cased; a text with fewer than ``width``
    words is one shingle, one without words has fingerprint 0, and null is such a text.  Documents
    whose fingerprints differ in at most ``max_bits`` bits are linked; ``component_id`` is the
    smallest id reachable.  Copies share a fingerprint and are linked through it once.  A null id
    is the last of all; rows with the same id are rows of one document.
    """
    marked = settle(fingerprints(docs, key, text, width))
    firsts = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(firsts.select("fingerprint"), max_bits=max_bits)).withColumnRenamed("node", "fingerprint")
    placed = firsts.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    names = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = placed.join(names, "root").select("fingerprint", "component_id")
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return marked.join(named, "fingerprint").select(
        id_out("doc_id"), hexed.alias("fingerprint"), id_out("component_id")
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of the smallest document of every group of near duplicates, with all columns."""
    found, name = near_duplicates(docs, key, text), f"{free_prefix(docs)}head"
    heads = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(name))
    return docs.join(heads.distinct(), docs[key].cast("bigint").eqNullSafe(F.col(name)), "left_semi")
