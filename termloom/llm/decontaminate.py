"""Benchmark items inside documents, also in edited form.

Item and document are sequences of words, compared by edit distance over words.  A window of the
size of an item is mapped by a CGK random walk: at each step the walk writes the word it stands
on, and a random bit that depends on step and word says whether it moves on.  Few edits change few
places of the result, so edit distance becomes Hamming distance; a few places, sampled repeatedly,
are the keys under which windows of documents and items meet.  An edit takes the two walks apart until
they meet again, so places that agree stand together: each sample is drawn within a short span of
steps, and in the first half, for with every lost word it takes longer until walks meet.  Whatever meets is decided by the
exact distance between the item and the best part of the document there.

Windows that cannot match are left out first: a part within the allowed distance of an item has at
most so many words that no item has.

A copy that lost words may be shorter than the window.  So windows reach over the end of a text,
where a walk finds only ``PAD``: those of documents as far as the shortest copy needs it, those of
items as far as words may be missing before them.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import buffers
from .storage import free_prefix, id_out, id_text

# An item is found where at most this share of its words must be inserted, removed or replaced.
MAX_EDITED = 0.2
# Sampled places in a key, the steps among which they are drawn, walks, and keys of each walk: chosen
# for a recall of 0.95 at the largest distance allowed, see tests/llm/test_llm_exact.py.
PLACES = 5
SPAN = 12
WALKS = 6
KEYS = 5
# Items are indexed in blocks of so many bytes; each block is one pass over the documents.  A block
# of words of five letters has some 260,000 windows with WALKS * KEYS entries of 16 bytes: 130 MB;
# where each character of three bytes is a word, 260 MB.
BLOCK_BYTES = 3 << 19
MAX_WINDOW = 128
SEED = 11
_WORD = np.zeros(256, bool)
_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
PAD = np.uint64(0x5851F42D4C957F2D)  # the word after the last one of a text
_APART, _LETTER, _SYMBOL, _MARK = range(4)
# Scripts written without blanks between words, by first and last character: Thai, Lao; Myanmar; Khmer;
# Tai Le, New Tai Lue; Tai Tham; Balinese; Han radicals; Han, kana, Bopomofo; Han, Yi; Javanese, Myanmar;
# Myanmar, Tai Viet; Han; kana; kana of earlier times; Han.
_UNSPACED = [
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F),
    (0x2E80, 0x2FDF), (0x3005, 0x312F), (0x31A0, 0x31FF), (0x3400, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAADF),
    (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF),
]
_FILTER_BITS = 20
_VERIFIED = 256  # candidates compared at once
_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item", pa.int64()),
        ("distance", pa.int32()),
        ("n_words", pa.int32()),
        ("begin", pa.int64()),
        ("end", pa.int64()),
    ]
)


def max_edits(n_words: int) -> int:
    return int(MAX_EDITED * n_words + 1e-9)


def _levels() -> list[int]:
    sizes = [1, 2, 3, 4]
    while sizes[-1] < MAX_WINDOW:
        sizes.append(min(MAX_WINDOW, sizes[-1] * 5 // 4 + (sizes[-1] < 8)))
    return sizes


LEVELS = _levels()


def stride(level: int) -> int:
    """Windows of documents begin so many words apart, from the first word of each and closer at its
    end; those of items begin at every word."""
    return max(1, level // 6)


def level_of(n_words: int) -> int:
    """The window size for an item: about its own, so that every copy holds a whole window."""
    return max(size for size in LEVELS if size + stride(size) - 1 <= n_words)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """What each character is: part of a word, a word of its own, a mark on what stands before, or none.

    Characters that this version of Unicode does not know, and private ones, are letters.
    """
    kinds = {"L": _LETTER, "N": _LETTER, "M": _MARK, "C": _LETTER}
    of = np.full(0x110000, _LETTER, np.uint8)
    for code in (*range(0x80, 0x33480), *range(0xE0000, 0xE01F0)):
        category = unicodedata.category(chr(code))
        of[code] = _APART if category in ("Cc", "Cf") else kinds.get(category[0], _APART)
    of[[0x200C, 0x200D]] = _MARK  # joiners inside words
    for first, last in _UNSPACED:
        part = of[first : last + 1]
        part[part == _LETTER] = _SYMBOL
    return of


def _code_points(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, length and code point of the characters of more than one byte."""
    at = np.flatnonzero(buffer >= 0xC0)
    lead = buffer[at]
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    code = (lead & (0x7F >> size)).astype(np.int64)
    for k in range(1, 4):
        more = size > k
        code[more] = code[more] << 6 | buffer[at[more] + k] & 0x3F
    return at, size, code


def _word_spans(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = _WORD[buffer]
    at, size, code = _code_points(buffer)
    if not len(at):
        return buffers.spans(inside)
    kind = _classes()[code]
    for k in range(4):
        inside[at[(size > k) & (kind != _APART)] + k] = True
    start, end = buffers.spans(inside)
    symbol = kind == _SYMBOL
    if not symbol.any():
        return start, end
    # a symbol goes up to the last of the marks that follow it
    stop = at + size
    head = np.concatenate([[True], (kind[1:] != _MARK) | (at[1:] != stop[:-1])])
    last = np.append(np.flatnonzero(head)[1:], len(at)) - 1
    cuts = np.concatenate([at[symbol], stop[last][symbol[head]]])
    cuts = np.setdiff1d(cuts[inside[cuts]], start)
    return np.sort(np.concatenate([start, cuts])), np.sort(np.concatenate([end, cuts]))


def words(data: np.ndarray, at: np.ndarray):
    """Hash, row, first and last byte of the words, A-Z lower-cased: runs of Unicode letters, digits
    and marks; a character of a script without blanks between words is a word, with its marks."""
    buffer, begins = buffers.separated(data, at)
    start, end = _word_spans(buffer)
    row = buffers.owner(begins, start)
    shift = begins[row] - at[row]
    return buffers.RangeHash(buffers.LOWER[buffer]).of(start, end), row, start - shift, end - shift


def padded(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with a ``PAD`` after each row, where each row begins, and where its ``PAD`` stands."""
    shift = np.arange(len(first) - 1)
    return np.insert(hashes, first[1:], PAD), first[:-1] + shift, first[1:] + shift


def window_starts(sizes: np.ndarray, level: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and first word, counted in the row, of the windows of rows of so many words.

    They begin ``stride`` apart as long as ``shortest`` words are left, and at every word where
    fewer than ``level`` or just as many are.
    """
    step = stride(level)
    regular = np.maximum(sizes - shortest + step, 0) // step
    tail = np.clip(sizes - shortest + 1, 0, level - shortest + 1)
    row = np.arange(len(sizes))
    rows = np.concatenate([np.repeat(row, regular), np.repeat(row, tail)])
    places = np.concatenate([_counted(regular) * step, np.repeat(sizes - shortest, tail) - _counted(tail)])
    doubled = np.concatenate([np.zeros(regular.sum(), bool), places[regular.sum() :] % step == 0])
    return rows[~doubled], places[~doubled]


def _counted(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def walk(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray, steps: int, seed: int) -> np.ndarray:
    """The words that the walks from ``starts`` write, step by window; no walk passes the ``PAD`` at
    its place of ``stops``."""
    written = np.empty((steps, len(starts)), np.uint64)
    at = starts.copy()
    for step in range(steps):
        here = hashes[at]
        written[step] = here
        coin = (here ^ np.uint64((seed * 1_000_003 + step) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
        at += (coin >> np.uint64(63)).astype(np.int64)
        np.minimum(at, stops, out=at)
    return written


def sampled_places(level: int) -> list[list[np.ndarray]]:
    """For each walk the steps in each key, among those that a window of ``level`` words almost surely covers."""
    draw = np.random.default_rng(SEED + level)
    steps = max(1, level * 3 // 2)
    span = min(steps, SPAN)
    one = lambda: draw.integers((steps - span) // 2 + 1) + np.sort(draw.choice(span, min(PLACES, span), replace=False))
    return [[one() for _ in range(KEYS)] for _ in range(WALKS)]


def keys(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray, level: int) -> Iterator[np.ndarray]:
    """For each repetition a key per window."""
    for number, samples in enumerate(sampled_places(level)):
        written = walk(hashes, starts, stops, 1 + max(int(places[-1]) for places in samples), SEED + number)
        for repetition, places in enumerate(samples):
            key = np.full(len(starts), (level << 16) + number * KEYS + repetition, np.uint64)
            for place in places:
                key = buffers.mix(key + written[place])
            yield key


@dataclass(frozen=True)
class ItemIndex:
    """Items of one block: their words, and by level the sorted keys of their windows."""

    ids: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    known: np.ndarray
    levels: dict[int, tuple]

    @classmethod
    def build(cls, ids: list[int], texts: list[str]) -> ItemIndex:
        data, at = buffers.utf8(pa.array(texts, pa.string()))
        hashes, row, _, _ = words(data, at)
        first = np.searchsorted(row, np.arange(len(ids) + 1))
        sizes = np.diff(first)
        known = np.zeros(1 << _FILTER_BITS, bool)
        known[hashes >> np.uint64(64 - _FILTER_BITS)] = True
        by_level: dict[int, list[int]] = {}
        for item, size in enumerate(sizes.tolist()):
            if size:
                by_level.setdefault(level_of(size), []).append(item)
        levels = {}
        spread, begin, stop = padded(hashes, first)
        for level, items in sorted(by_level.items()):
            n = sizes[items]
            edits = np.array([max_edits(size) for size in n.tolist()])
            counts = np.maximum(n - level, edits) + 1
            owner, offset = np.repeat(items, counts), _counted(counts)
            found = np.concatenate(list(keys(spread, begin[owner] + offset, stop[owner], level)))
            offset = np.tile(offset.astype(np.int32), WALKS * KEYS)
            owner = np.tile(owner.astype(np.int32), WALKS * KEYS)
            order = np.argsort(found, kind="stable")
            likely = np.zeros(1 << _FILTER_BITS, bool)
            likely[found >> np.uint64(64 - _FILTER_BITS)] = True
            shortest = min(level, int((n - edits).min()))
            levels[level] = (int(edits.max()), shortest, found[order], owner[order], offset[order], likely)
        return cls(np.array(ids, np.int64), hashes, first, known, levels)

    def candidates(self, hashes: np.ndarray, row_first: np.ndarray):
        """Item, the word it would begin at, and the row, for windows that share a key with one of its windows.

        Of begins that differ by no more words than the item may be edited in, the first stands for
        all: ``verify`` looks far enough on both sides.
        """
        unknown = np.concatenate([[0], np.cumsum(~self.known[hashes >> np.uint64(64 - _FILTER_BITS)])])
        spread, _, stop = padded(hashes, row_first)
        sizes = np.diff(row_first)
        found = [np.zeros((0, 3), np.int64)]
        for level, (allowed, shortest, sorted_keys, owner, offset, likely) in self.levels.items():
            rows, places = window_starts(sizes, level, shortest)
            starts = row_first[rows] + places
            ends = np.minimum(starts + level, row_first[rows + 1])
            fitting = np.flatnonzero(unknown[ends] - unknown[starts] <= allowed)
            rows, starts = rows[fitting], starts[fitting]
            if not len(starts):
                continue
            for key in keys(spread, starts + rows, stop[rows], level):
                hit = np.flatnonzero(likely[key >> np.uint64(64 - _FILTER_BITS)])
                low = np.searchsorted(sorted_keys, key[hit], "left")
                same = sorted_keys[np.minimum(low, len(sorted_keys) - 1)] == key[hit]
                hit, low = hit[same], low[same]
                if not len(hit):
                    continue
                count = np.searchsorted(sorted_keys, key[hit], "right") - low
                entry = np.repeat(low, count) + _counted(count)
                hit = np.repeat(hit, count)
                found.append(np.stack([owner[entry], starts[hit] - offset[entry], rows[hit]], 1))
        item, begin, row = np.concatenate(found).T
        allowed = (MAX_EDITED * np.diff(self.first) + 1e-9).astype(np.int64)
        near = (begin - row_first[row]) // (allowed[item] + 1)
        order = np.lexsort((begin, near, row, item))
        item, begin, row, near = item[order], begin[order], row[order], near[order]
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (row[1:] != row[:-1]) | (near[1:] != near[:-1])
        return item[new], begin[new], row[new]


def _distances(item: np.ndarray, parts: np.ndarray, free_start: bool) -> np.ndarray:
    """Edit distances of an item to what ends at each place of each part (candidate x place + 1)."""
    width = parts.shape[1]
    places = np.arange(width + 1, dtype=np.int32)
    row = np.zeros((len(parts), width + 1), np.int32) if free_start else np.tile(places, (len(parts), 1))
    for n, word in enumerate(item.tolist(), 1):
        new = row + 1
        np.minimum(new[:, 1:], row[:, :-1] + (parts != np.uint64(word)), out=new[:, 1:])
        row = np.minimum.accumulate(new - places, 1) + places
        if not free_start:
            row[:, 0] = n
    return row


def verify(index: ItemIndex, item: int, begins: np.ndarray, hashes: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Exact least distance of an item around each supposed begin within words ``low`` to ``high``,
    and the first and last word of the best part; distance -1 where it is too far."""
    own = index.hashes[index.first[item] : index.first[item + 1]]
    n, allowed = len(own), max_edits(len(own))
    ordered = np.sort(own)
    width = n + 4 * allowed + 2
    lead = begins - 2 * allowed - 1
    out = np.full((len(begins), 3), -1, np.int64)
    for start in range(0, len(begins), _VERIFIED):
        part = slice(start, start + _VERIFIED)
        at = lead[part][:, None] + np.arange(width)
        inside = (at >= low[part][:, None]) & (at < high[part][:, None])
        # 0 stands for what is outside the document; a word's hash is 0 with a chance of 2**-64
        segment = np.where(inside, hashes[np.clip(at, 0, len(hashes) - 1)], np.uint64(0))
        # a part near enough has all words of the item but those that may be missing
        shared = ordered[np.minimum(np.searchsorted(ordered, segment), n - 1)] == segment
        rich = np.flatnonzero(shared.sum(1) >= n - allowed)
        segment = segment[rich]
        found = _distances(own, segment, True)
        last, best = found.argmin(1), found.min(1)
        for k in np.flatnonzero(best <= allowed):
            reversed_part = segment[k : k + 1, : last[k]][:, ::-1]
            back = _distances(own[::-1], np.ascontiguousarray(reversed_part), False)[0]
            size = int(np.flatnonzero(back == best[k])[0])
            place = int(lead[part][rich[k]] + last[k])
            out[start + rich[k]] = best[k], place - size, place
    return out


def search(index: ItemIndex, data: np.ndarray, at: np.ndarray):
    """Row, item, distance, first and last byte of the best occurrence of each item in each text."""
    hashes, row, start, end = words(data, at)
    n = len(at) - 1
    row_first = np.searchsorted(row, np.arange(n + 1))
    results = []
    if len(hashes) and len(index.ids):
        # a candidate belongs to the text that its window lies in, even if it begins before it
        items, begins, rows = index.candidates(hashes, row_first)
        for item in np.unique(items):
            mine = items == item
            owner = rows[mine]
            found = verify(index, int(item), begins[mine], hashes, row_first[owner], row_first[owner + 1])
            good = found[:, 0] >= 0
            for text, (distance, first, last) in zip(owner[good].tolist(), found[good].tolist()):
                a, b = (int(start[first]), int(end[last - 1])) if last > first else (0, 0)
                results.append((text, int(item), distance, a - int(at[text]), b - int(at[text])))
    best: dict[tuple[int, int], tuple] = {}
    for text, item, distance, a, b in sorted(results):
        best.setdefault((text, item), (text, item, distance, a, b))
    return list(best.values())


def matches(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, item_id, distance, item_words, begin, end``: items found in whole texts.

    One row per document row and item: the least distance in words and the bytes of the first part
    that has it.  Items without a word match nothing, nor do null or empty texts; items or
    documents that occur twice are found twice; items with null ids are left out as unnamed; an
    empty table on either side gives no rows.  The items are a given query set, taken in blocks of
    ``block_bytes``; each block is sent to the executors and passed over the documents.
    """
    named = items.select(F.col(item_key).cast("bigint").alias("item"), F.col(item_text).cast("string").alias("text"))
    named = named.where("item IS NOT NULL AND text IS NOT NULL")
    total = named.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // block_bytes))
    placed = named.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    texts = id_text(docs, key, text)
    found = None
    for block in range(blocks):
        rows = sorted((r["item"], r["text"]) for r in placed.where(F.col("block") == block).collect())
        part = _pass(texts, ItemIndex.build([r[0] for r in rows], [r[1] for r in rows]))
        found = part if found is None else found.unionByName(part)
    return found.select(
        id_out(), F.col("item").alias("item_id"), "distance", F.col("n_words").alias("item_words"), "begin", "end"
    )


def _pass(texts: DataFrame, index: ItemIndex) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(index)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        sizes = np.diff(known.first)
        for batch in buffers.pieces(batches, "text"):
            ids = batch.column("doc_id").to_numpy()
            found = search(known, *buffers.utf8(batch.column("text")))
            if found:
                row, item, distance, begin, end = (np.array(c, np.int64) for c in zip(*found))
                yield buffers.arrow(
                    _FOUND, ids[row], known.ids[item], distance.astype(np.int32), sizes[item].astype(np.int32), begin, end
                )

    schema = "doc_id bigint, item bigint, distance int, n_words int, begin bigint, end bigint"
    return texts.mapInArrow(rows, schema)


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The rows of documents in which no item was found, with all their columns."""
    name = f"{free_prefix(docs)}hit"
    hit = matches(docs, items, key, text, **names).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(hit, docs[key].cast("bigint").eqNullSafe(F.col(name)), "left_anti")
