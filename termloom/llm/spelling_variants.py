"""Spelling variants: words one edit apart, each tied to the most frequent spelling around it.

Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF), lower-cased in ASCII.  A known share
of them gets a typing error first: where 97 divides the CRC-32 of ``<doc_id>:<run>``, the code point
at that value modulo the length is left out.  What has enough code points and occurrences is kept.

Two near words share the first or the last half of the shorter one, so words meet in groups by
halves.  A group is a sorted list of what lies between the shared parts.  Rows of the edit matrix,
a band of three cells, belong to prefixes of that list: words with a common prefix share its row,
and a range whose prefix is more than one edit away from a word is not entered.  Groups that are too large
are halved again, down to a single free place, which bounds them by the alphabet.

Odd rows: a null text has no words; a null id is written as nothing before the colon; every row
counts, also repeated ones; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.plans.sizing import broadcast_limit

from . import buffers
from .storage import settle

MIN_POINTS = 5
MIN_COUNT = 3
TYPO_ONE_IN = 97
# A form is at least this many times as frequent.
FORM_TIMES = 2

PIECE_BYTES = 4 << 20
# Runs of more bytes than this are hashed one by one.
LONG_RUN = 64
# Words of one group; larger groups are halved.
GROUP_ROWS = 20_000
BLOCK_ROWS = 40_000
QUERY_ROWS = 2_048
FAR = 2


def _crc_table() -> np.ndarray:
    """What the CRC-32 makes of each byte (reflected polynomial EDB88320)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC_TABLE = _crc_table()

COUNTED = pa.schema([("word", pa.string()), ("n", pa.int64())])
NEAR = pa.schema(
    [("pre", pa.string()), ("rest", pa.string()), ("suf", pa.string()), ("n_near", pa.int64()),
     ("best", pa.string()), ("best_n", pa.int64())]
)


# -- words and their counts -------------------------------------------------------------------
def _digests(lower: np.ndarray, start: np.ndarray, end: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """CRC-32 of each run, going on from the seed of its row: all runs byte by byte at once."""
    lengths = end - start
    order = np.argsort(-np.minimum(lengths, LONG_RUN + 1).astype(np.int16), kind="stable")
    ranked, first = lengths[order], start[order]
    state = (seeds ^ np.uint32(0xFFFFFFFF))[order]
    n_long = int(np.count_nonzero(lengths > LONG_RUN))
    for j in range(int(ranked[n_long]) if n_long < len(ranked) else 0):
        stop = n_long + int(np.searchsorted(-ranked[n_long:], -j, "left"))
        s = state[n_long:stop]
        state[n_long:stop] = _CRC_TABLE[(s ^ lower[first[n_long:stop] + j]) & np.uint32(0xFF)] ^ (s >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in order[:n_long]:
        out[i] = zlib.crc32(lower[start[i] : end[i]].tobytes(), int(seeds[i]))
    return out


def _misspelt(run: bytes, digest: int) -> str:
    text = run.decode()
    at = digest % len(text)
    return text[:at] + text[at + 1 :]


def _count_piece(texts: pa.Array, ids: pa.Array, min_points: int) -> pa.RecordBatch:
    data, at = buffers.utf8(texts)
    buffer, begins = buffers.separated(data, at)
    lower = buffers.LOWER[buffer]
    # U+00C0 to U+00FF are what begins with the byte C3.
    lead = buffer == 0xC3
    inside = ((lower >= ord("a")) & (lower <= ord("z"))) | lead
    inside[1:] |= lead[:-1]
    start, end = buffers.spans(inside)
    leads = np.concatenate([[0], np.cumsum(lead)])
    points = end - start - (leads[end] - leads[start])
    enough = points >= min_points
    start, end, points = start[enough], end[enough], points[enough]
    row = buffers.owner(begins, start)
    seeds = np.array([zlib.crc32(f"{i}:".encode()) for i in ids.to_pylist()], np.uint32)
    digests = _digests(lower, start, end, seeds[row]) if len(start) else np.zeros(0, np.uint32)
    wrong = np.flatnonzero(digests % TYPO_ONE_IN == 0)
    typos = [
        _misspelt(lower[start[i] : end[i]].tobytes(), int(digests[i])) for i in wrong if points[i] > min_points
    ]
    plain = np.ones(len(start), bool)
    plain[wrong] = False
    start, end = start[plain], end[plain]
    edge = np.zeros(len(buffer) + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1
    chosen = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    runs = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(lower[chosen]))
    counts = pc.value_counts(pa.chunked_array([runs, pa.array(typos, pa.large_string())]))
    return buffers.arrow(COUNTED, counts.field("values").cast(pa.string()), counts.field("counts"))


def word_counts(docs: DataFrame, key: str, text: str, min_points: int = MIN_POINTS) -> DataFrame:
    """``word, n`` of all words of at least ``min_points`` code points, typing errors included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in buffers.pieces(batches, "text", PIECE_BYTES):
            yield _count_piece(piece.column("text"), piece.column("id"), min_points)

    slim = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(text).cast("string").alias("text")
    )
    counted = slim.mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


# -- groups -----------------------------------------------------------------------------------
def _entries(words: DataFrame) -> DataFrame:
    """Each word by the halves it shares with a word as long as it is, and with one a point shorter or longer.

    ``l`` is the length of the shorter word of a pair, ``a`` and ``b`` are the lengths of the shared
    beginning and end; a pair that also shares ``most`` first points is met in another group.
    """
    long = F.length("word")
    ways = []
    for short in (long, long - 1):
        half = F.floor(short / 2).cast("int")
        first = F.struct(short.alias("l"), half.alias("a"), F.lit(0).alias("b"), (short + 1).alias("most"))
        last = F.struct(short.alias("l"), F.lit(0).alias("a"), half.alias("b"), half.alias("most"))
        ways += [first, last]
    entries = words.select("word", "n", F.explode(F.array(*ways)).alias("way"))
    return _keyed(entries.select("word", "n", "way.*").where(F.col("l") >= MIN_POINTS))


def _keyed(entries: DataFrame) -> DataFrame:
    long = F.length("word")
    return entries.select(
        "word", "n", "l", "a", "b", "most",
        F.expr("substring(word, 1, a)").alias("pre"),
        F.substr(F.col("word"), long - F.col("b") + 1, F.col("b")).alias("suf"),
        F.substr(F.col("word"), F.col("a") + 1, long - F.col("a") - F.col("b")).alias("rest"),
    )


KEYS = ["l", "a", "b", "most", "pre", "suf"]


def _halved(entries: DataFrame) -> DataFrame:
    """The same pairs in finer groups: the free part is halved again."""
    half = F.floor((F.col("l") - F.col("a") - F.col("b")) / 2).cast("int")
    edge = F.col("a") + half
    first = F.struct("l", edge.alias("a"), "b", "most")
    last = F.struct("l", "a", (F.col("b") + half).alias("b"), F.least("most", edge).alias("most"))
    ways = entries.select("word", "n", F.explode(F.array(first, last)).alias("way"))
    return _keyed(ways.select("word", "n", "way.*"))


def _groups(words: DataFrame, group_rows: int) -> DataFrame:
    """Entries in groups of at most ``group_rows``, or with a single free place."""
    rest, done = _entries(words), []
    while True:
        sizes = rest.groupBy(*KEYS).agg(F.count("*").alias("size"))
        large = settle(sizes.where((F.col("size") > group_rows) & (F.col("l") - F.col("a") - F.col("b") > 1)).drop("size"))
        n_large = large.count()
        if n_large == 0:
            break
        # There are at most as many large groups as entries divided by their least size.
        near = F.broadcast(large) if n_large * 256 <= broadcast_limit(words.sparkSession) else large
        done.append(rest.join(near, KEYS, "left_anti"))
        rest = _halved(rest.join(near, KEYS, "left_semi"))
    for part in done:
        rest = rest.unionByName(part)
    return rest


# -- near words of one block of groups -----------------------------------------------------------
class _SortedLists:
    """Several groups, each a sorted list of distinct strings, and the bands of words against them."""

    def __init__(self, rest: pa.Array, new_group: np.ndarray):
        data, at = buffers.utf8(rest)
        lead = data == 0xC3
        after = np.zeros(len(data), bool)
        after[1:] = lead[:-1]
        letters = np.where(after, data + np.uint8(0x40), data)[~lead]
        leads = np.concatenate([[0], np.cumsum(lead)])
        ends = at - leads[at]
        self.begin, self.long = ends[:-1], np.diff(ends)
        self.letters = np.append(letters, np.uint8(0))
        n = len(self.long)
        self.starts = np.flatnonzero(new_group)
        self.group = np.cumsum(new_group) - 1
        self.stops = np.append(self.starts[1:], n)
        self.shared = self._prefixes(new_group)
        self._levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def letter(self, rows: np.ndarray, at: int) -> np.ndarray:
        """The letter at a place, 0 beyond the end."""
        if at < 0:
            return np.zeros(len(rows), np.uint8)
        inside = at < self.long[rows]
        return np.where(inside, self.letters[np.where(inside, self.begin[rows] + at, 0)], 0)

    def _prefixes(self, new_group: np.ndarray) -> np.ndarray:
        """How much each string shares with the one before; -1 at the start of a group."""
        shared = np.where(new_group, -1, 0)
        open_ = np.flatnonzero(~new_group)
        depth = 0
        while len(open_):
            same = (depth < self.long[open_]) & (self.letter(open_, depth) == self.letter(open_ - 1, depth))
            open_ = open_[same]
            shared[open_] += 1
            depth += 1
        return shared

    def level(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the lists that share their first ``depth`` letters: where they start and stop."""
        if depth not in self._levels:
            edges = np.flatnonzero(self.shared < depth)
            stops = np.append(edges[1:], len(self.long))
            real = self.long[edges] >= depth
            self._levels[depth] = edges[real], stops[real]
        return self._levels[depth]

    def near(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of an asked row and a row of its group one edit away, and their common prefix."""
        q = asked
        lo, hi = self.starts[self.group[q]], self.stops[self.group[q]]
        # The band: edits between the range's prefix and the word's first depth - 1, depth, depth + 1 letters.
        left = np.full(len(q), FAR, np.int8)
        mid = np.zeros(len(q), np.int8)
        right = np.where(self.long[q] > 0, 1, FAR).astype(np.int8)
        common = np.zeros(len(q), np.int32)
        found, depth = [], 0
        while len(q):
            over = self.long[q] - depth
            whole = self.long[lo] == depth
            edits = np.where(over == -1, left, np.where(over == 0, mid, np.where(over == 1, right, FAR)))
            hit = whole & (edits == 1)
            found.append((q[hit], lo[hit], common[hit]))
            starts, stops = self.level(depth + 1)
            a, b = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
            many = b - a
            item = np.repeat(np.arange(len(q)), many)
            child = np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many) + a[item]
            q, lo, hi = q[item], starts[child], stops[child]
            c, over = self.letter(lo, depth), over[item]
            l0, m0, r0, common = left[item], mid[item], right[item], common[item]
            left = np.minimum(l0 + (self.letter(q, depth - 1) != c), m0 + 1)
            left[over < 0] = FAR
            mid = np.minimum(np.minimum(m0 + (self.letter(q, depth) != c), r0 + 1), left + 1)
            mid[over < 1] = FAR
            right = np.minimum(r0 + (self.letter(q, depth + 1) != c), mid + 1)
            right[over < 2] = FAR
            common[mid == 0] = depth + 1
            go = np.minimum(np.minimum(left, mid), right) <= 1
            q, lo, hi, common = q[go], lo[go], hi[go], common[go]
            left, mid, right = left[go].astype(np.int8), mid[go].astype(np.int8), right[go].astype(np.int8)
            depth += 1
        return tuple(np.concatenate(part) for part in zip(*found))


def _near_block(block: pa.Table, new_group: np.ndarray) -> pa.RecordBatch:
    """For every row with near words in its group: how many, and the most frequent of them."""
    rest, count = block.column("rest").combine_chunks(), block.column("n").to_numpy()
    lists = _SortedLists(rest, new_group)
    l, a, most = (block.column(c).to_numpy() for c in ("l", "a", "most"))
    long = pc.utf8_length(block.column("word")).to_numpy()
    order = pc.sort_indices(block.column("word").cast(pa.binary())).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    rows, near, best = [], [], []
    for first in range(0, len(l), QUERY_ROWS):
        q, v, common = lists.near(np.arange(first, min(first + QUERY_ROWS, len(l))))
        # Pairs of two longer words, and those sharing more at the front, are met elsewhere.
        own = (np.minimum(long[q], long[v]) == l[q]) & (a[q] + common < most[q])
        q, v = q[own], v[own]
        ranked = np.lexsort((rank[v], -count[v], q))
        q, v = q[ranked], v[ranked]
        new = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
        rows.append(q[new])
        best.append(v[new])
        near.append(np.diff(np.append(new, len(q))))
    at, best = np.concatenate(rows), np.concatenate(best)
    pre, suf = (block.column(c).combine_chunks().take(pa.array(at)) for c in ("pre", "suf"))
    return buffers.arrow(
        NEAR, pre, rest.take(pa.array(at)), suf, np.concatenate(near), rest.take(pa.array(best)), count[best]
    )


def _near_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups, in blocks; rows come sorted by group and string."""

    def edges(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for key in KEYS:
            column = table.column(key).combine_chunks()
            new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        return new

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK_ROWS:
            table = pa.Table.from_batches(held)
            new = edges(table)
            # The last group may go on in the next batch.
            cut = int(np.flatnonzero(new)[-1])
            if cut:
                yield _near_block(table.slice(0, cut), new[:cut])
            held = table.slice(cut).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield _near_block(table, edges(table))


def near_words(words: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``word, n_near, form, form_n`` of the words that have near words; the form is the most frequent one."""
    entries = _groups(words, group_rows)
    dealt = entries.repartition(*KEYS).sortWithinPartitions(*KEYS, F.col("rest").cast("binary"))
    found = dealt.mapInArrow(_near_rows, "pre string, rest string, suf string, n_near bigint, best string, best_n bigint")
    spelt = found.select(
        F.concat("pre", "rest", "suf").alias("word"),
        "n_near",
        F.struct((-F.col("best_n")).alias("less"), F.concat("pre", "best", "suf").alias("form")).alias("best"),
    )
    each = spelt.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return each.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: every step follows as many forms as all steps before.

    A form is at least twice as frequent as its word, so paths are short.  At most as many words
    have one form as there are strings an edit away, so no key of the join is hot.
    """
    reached = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = settle(reached.join(further, "root", "left"))
        reached = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.where("next IS NOT NULL").isEmpty():
            return reached


def variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of the documents."""
    words = settle(word_counts(docs, key, text).where(F.col("n") >= min_count))
    near = near_words(words, group_rows)
    joined = words.join(near, "word", "left")
    close = F.col("form_n") >= FORM_TIMES * F.col("n")
    tied = settle(joined.select(
        "word",
        F.when(close, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(close, F.col("form_n")).alias("form_n"),
    ))
    ends = roots(tied.where("form IS NOT NULL"))
    return tied.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
