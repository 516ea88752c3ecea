"""Licences in documents, by the Dice coefficient of word bigrams.

Text and templates are normalised to words: runs of letters and digits, A-Z lower-cased.  A passage
of a document matches a template if 2 * common / (its bigrams + the template's) reaches the
threshold, where a bigram is common as often as both have it.  That bounds how much smaller or larger than the template a
passage may be, and how many of the template's bigrams the document must have at all; templates out
of these bounds are left out before any passage is compared.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import buffers
from .decontaminate import words
from .license_texts import TEMPLATES

THRESHOLD = 0.8
_FILTER_BITS = 16
# Passages of more bigrams are compared by whole arrays, which gives the same.
_LONG = 100
_FOUND = pa.schema(
    [("doc_id", pa.int64()), ("license", pa.string()), ("dice", pa.float64()), ("begin", pa.int64()), ("end", pa.int64())]
)


def _bigrams(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of adjacent words of one row, and the first word of each."""
    first = np.flatnonzero(row[1:] == row[:-1])
    return buffers.mix(hashes[first] * np.uint64(0x9E3779B97F4A7C15) + hashes[first + 1]), first


class TemplateIndex:
    """The bigrams of all templates, and which template has which."""

    def __init__(self, templates: Sequence[tuple[str, str]], threshold: float = THRESHOLD):
        self.names = [name for name, _ in templates]
        self.threshold = threshold
        bags = []
        for _, text in templates:
            hashes, row, _, _ = words(*buffers.utf8(pa.array([text])))
            bags.append(_bigrams(hashes, row)[0])
        self.sizes = np.array([len(b) for b in bags], np.int64)
        self.known = np.unique(np.concatenate([*bags, np.zeros(0, np.uint64)]))
        width = len(self.known)
        # how often each template has each bigram
        self.counts = np.array([np.bincount(np.searchsorted(self.known, b), minlength=width) for b in bags], np.int64)
        self.counts = self.counts.reshape(len(bags), width)
        self.likely = np.zeros(1 << _FILTER_BITS, bool)
        self.likely[self.known >> np.uint64(64 - _FILTER_BITS)] = True

    def bounds(self, template: int) -> tuple[int, int]:
        """Least and most bigrams of a passage; it must also share at least the least."""
        size, t = int(self.sizes[template]), self.threshold
        return max(1, int(np.ceil(t / (2 - t) * size - 1e-9))), int((2 - t) / t * size + 1e-9)

    def locate(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of bigrams that some template has, and their numbers."""
        at = np.flatnonzero(self.likely[grams >> np.uint64(64 - _FILTER_BITS)])
        number = np.searchsorted(self.known, grams[at])
        same = self.known[np.minimum(number, len(self.known) - 1)] == grams[at] if len(self.known) else at < 0
        return at[same], number[same]


def _best_passage(index: TemplateIndex, template: int, places: np.ndarray, numbers: np.ndarray):
    """The best passage that begins and ends with a bigram of the template: Dice, first and last place.

    ``places`` are those of the template's bigrams in the document, ``numbers`` says which.  No
    passage longer than the bound is looked at, so the work per place is limited by the template.
    """
    size, counts = int(index.sizes[template]), index.counts[template]
    least, most = index.bounds(template)
    best = (0.0, 0, 0)
    stops = np.searchsorted(places, places + most)
    if most > _LONG:
        return _best_long_passage(size, counts, least, places, numbers, stops, index.threshold)
    places, numbers = places.tolist(), numbers.tolist()
    for k, start in enumerate(places):
        used: dict[int, int] = {}
        common = 0
        for j in range(k, stops[k]):
            times = used[numbers[j]] = used.get(numbers[j], 0) + 1
            common += times <= counts[numbers[j]]
            total = places[j] - start + 1
            dice = 2 * common / (total + size)
            if total >= least and dice > best[0]:
                best = (dice, start, places[j])
        if best[0] == 1.0:
            break
    return best if best[0] >= index.threshold else None


def _best_long_passage(size, counts, least, places, numbers, stops, threshold):
    order = np.argsort(numbers, kind="stable")
    heads = np.searchsorted(numbers[order], numbers[order])
    rank = np.empty(len(numbers), np.int64)  # how often the bigram stood before
    rank[order] = np.arange(len(numbers)) - heads
    limit = rank - counts[numbers]
    before = np.zeros(len(counts), np.int64)
    best = (0.0, 0, 0)
    for k, stop in enumerate(stops.tolist()):
        here = numbers[k:stop]
        total = places[k:stop] - places[k] + 1
        common = np.cumsum(limit[k:stop] < before[here])
        dice = np.where(total >= least, 2 * common / (total + size), 0.0)
        j = int(dice.argmax())
        if dice[j] > best[0]:
            best = (float(dice[j]), int(places[k]), int(places[k + j]))
        before[numbers[k]] += 1
        if best[0] == 1.0:
            break
    return best if best[0] >= threshold else None


def scan_texts(index: TemplateIndex, data: np.ndarray, at: np.ndarray) -> list[tuple[int, str, float, int, int]]:
    """Row, licence, Dice, first and last byte of the best passage of each licence in each text."""
    hashes, row, start, end = words(data, at)
    grams, first = _bigrams(hashes, row)
    where, number = index.locate(grams)
    gram_row = row[first[where]]
    found: dict[tuple[int, str], tuple] = {}
    heads = np.flatnonzero(np.concatenate([[True], gram_row[1:] != gram_row[:-1]])) if len(where) else []
    for a, b in zip(heads, [*heads[1:], len(where)]):
        text = int(gram_row[a])
        distinct = np.unique(number[a:b])
        shared = index.counts[:, distinct].sum(1)
        for template in np.flatnonzero(index.sizes > 0):
            if shared[template] < index.bounds(template)[0]:
                continue
            own = index.counts[template, number[a:b]] > 0
            best = _best_passage(index, int(template), where[a:b][own], number[a:b][own])
            if best is None:
                continue
            dice, low, high = best
            begin, stop = int(start[first[low]] - at[text]), int(end[first[high] + 1] - at[text])
            name = (text, index.names[template])
            if name not in found or dice > found[name][2]:
                found[name] = (*name, dice, begin, stop)
    return list(found.values())


def scan(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, license, dice, begin, end``: per row and licence the best passage, by its bytes.

    Several templates may stand for one licence.  Row by row over whole texts: null and empty texts
    have no licence, repeated rows repeat their result, null ids stay null, and an empty table
    gives no rows.  Of equally good passages the first counts.
    """
    index = docs.sparkSession.sparkContext.broadcast(TemplateIndex(templates, threshold))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.pieces(batches, "text"):
            found = scan_texts(index.value, *buffers.utf8(batch.column("text")))
            if found:
                row, names, dice, begin, end = zip(*found)
                ids = batch.column("doc_id").take(pa.array(row))
                yield buffers.arrow(_FOUND, ids, list(names), list(dice), list(begin), list(end))

    narrow = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(rows, "doc_id bigint, license string, dice double, begin bigint, end bigint")
