"""Language identification by prediction by partial matching over bytes.

Each language has a context tree: how often each byte follows each context of up to
``MAX_ORDER`` bytes.  A byte costs -log2 of its probability: it is predicted in the longest
context that the tree has, with an escape to the next shorter one where it is new there.  The
escape weighs as much as the context has different bytes, bytes already ruled out by the longer
context are left out of the counts, and after the empty context all remaining bytes are equally
likely.  The statistics are frozen after training, so the code length of a text is exact and does
not depend on other texts.

All trees are laid over one trie of byte sequences.  With frozen statistics the cost of a byte is
a constant of the longest sequence that ends there plus a constant of the longest context before
it, both tabulated for every language; a text's code length is a sum of table rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import buffers

MAX_ORDER = 3
# Training: at most about so many rows of a language, drawn by a hash from all rows.
SAMPLE_ROWS = 1500
# Sequences seen fewer times over all languages are left out beyond this length.
ALWAYS_KEPT = 2
MIN_COUNT = 2
UNDETERMINED = "und"
_BLOCK = 1 << 17
_LETTER = regex.compile(r"\p{L}")
_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


def training_rows(
    docs: DataFrame, eligible: Column, key: str, text: str, lang: str, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """``lang, text``: about ``rows`` whole texts of each language, or all where there are fewer.

    The share taken of a language follows from its number of rows, counted over the whole table.
    """
    known = docs.where(eligible & F.col(lang).isNotNull() & F.col(text).isNotNull())
    named = known.select(
        F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(key), F.col(text)).alias("drawn"),
    )
    shares = named.groupBy("lang").agg((F.lit(float(rows)) / F.count("*")).alias("share"))
    drawn = F.pmod("drawn", F.lit(1 << 30)) / F.lit(float(1 << 30))
    return named.join(F.broadcast(shares), "lang").where(drawn < F.col("share")).select("lang", "text")


def _gram_counts(order: int):
    """Counts of all byte sequences up to a context and its byte; a marker bit keeps their length."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.pieces(batches, "text"):
            langs = batch.column("lang").to_pylist()
            for name in sorted(set(langs)):
                chosen = batch.filter(pa.array([x == name for x in langs]))
                data, at = buffers.utf8(chosen.column("text"))
                place = np.arange(len(data)) - np.repeat(at[:-1], np.diff(at))
                gram = np.ones(len(data), np.int64)
                for size in range(1, order + 2):
                    rest = gram[:-1] if size > 1 else gram
                    gram = ((rest << 8) | data[size - 1 :]) if len(data) >= size else gram[:0]
                    grams, n = np.unique(gram[place[size - 1 :] >= size - 1], return_counts=True)
                    yield buffers.arrow(_COUNTS, [name] * len(grams), grams, n)

    return rows


@dataclass(frozen=True)
class Model:
    """``symbols`` maps a byte to a dense number, 0 for bytes never seen; ``steps[k]`` maps a
    sequence of k bytes and the next symbol to the sequence of k + 1 bytes, 0 where it is unknown;
    ``cost`` and ``context`` have a row for every sequence of every length, ``first[k]`` is where
    those of length k begin.  Sequence 0 of any length is none."""

    langs: list[str]
    order: int
    symbols: np.ndarray
    steps: list[np.ndarray]
    first: np.ndarray
    cost: np.ndarray
    context: np.ndarray


def build_model(counts: dict[str, dict[int, int]], order: int = MAX_ORDER) -> Model:
    """Tabulate the costs from counts of sequences, given as numbers with a leading 1 byte."""
    langs = sorted(counts)
    n_langs = len(langs)
    total: dict[int, int] = {}
    for table in counts.values():
        for gram, n in table.items():
            total[gram] = total.get(gram, 0) + n
    grams = np.array(sorted(total), np.int64)
    sizes = np.array([(int(g).bit_length() - 1) // 8 for g in grams], np.int64)
    grams = grams[(sizes <= ALWAYS_KEPT) | (np.array([total[int(g)] for g in grams], np.int64) >= MIN_COUNT)] if len(grams) else grams
    sizes = np.array([(int(g).bit_length() - 1) // 8 for g in grams], np.int64)

    levels = [grams[sizes == k] for k in range(1, order + 2)]  # sorted; a prefix is as frequent, so it is kept too
    symbols = np.zeros(256, np.int64)
    seen = levels[0] & 255
    symbols[seen] = np.arange(1, len(seen) + 1)
    width = len(seen) + 1
    first = np.cumsum([1] + [len(x) + 1 for x in levels])  # row 0 stands for the empty sequence
    steps, before = [], np.array([1], np.int64)
    for k, level in enumerate(levels):
        step = np.zeros((len(before) if k == 0 else len(before) + 1, width), np.int32)
        parent = np.searchsorted(before, level >> 8) + (k > 0)
        step[parent, symbols[level & 255]] = np.arange(1, len(level) + 1)
        steps.append(step)
        before = level

    n_rows = int(first[-1])
    cost = np.zeros((n_rows, n_langs))
    context = np.zeros((n_rows, n_langs))
    for column, lang in enumerate(langs):
        _fill_costs(counts[lang], levels, first, cost[:, column], context[:, column], order)
    return Model(langs, order, symbols.astype(np.uint8 if width <= 256 else np.int64), steps, first, cost, context)


def _suffix_rows(level: np.ndarray, shorter: np.ndarray, k: int) -> np.ndarray:
    """Where each sequence of k bytes, less its first byte, is among those of k - 1 bytes."""
    tail = (level & ((1 << 8 * (k - 1)) - 1)) | (1 << 8 * (k - 1))
    return np.searchsorted(shorter, tail)


def _fill_costs(table: dict[int, int], levels, first, cost, context, order) -> None:
    # n[k]: the language's counts of the sequences of length k; the root is length 0
    n = [np.array([table.get(int(g), 0) for g in level], np.float64) for level in levels]
    nodes = [np.array([1], np.int64), *levels]
    sums, kinds, parents = [], [], []
    for k in range(order + 1):  # totals and numbers of different bytes after each context
        parent = np.searchsorted(nodes[k], levels[k] >> 8)
        parents.append(parent)
        sums.append(np.bincount(parent, n[k], len(nodes[k])))
        kinds.append(np.bincount(parent, n[k] > 0, len(nodes[k])))

    # what an escape from a context costs beyond coding the byte afresh in the next shorter one
    escape = []
    for k in range(order + 1):
        used = kinds[k] > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            own = np.where(used, np.log2(sums[k] + kinds[k]) - np.log2(kinds[k]), 0.0)
        if k:
            tail = _suffix_rows(nodes[k], nodes[k - 1], k)
            # occurrences in the shorter context of bytes that the longer one has ruled out
            after = _suffix_rows(levels[k], levels[k - 1], k + 1)
            ruled_out = np.bincount(parents[k], np.where(n[k] > 0, n[k - 1][after], 0.0), len(nodes[k]))
            whole = sums[k - 1][tail] + kinds[k - 1][tail]
            with np.errstate(divide="ignore", invalid="ignore"):
                own = np.where(used, own + np.log2(whole - ruled_out) - np.log2(whole), 0.0)
        escape.append(own)

    below = float(np.log2(max(1, 256 - (kinds[0][0] if len(kinds[0]) else 0))))
    new = escape[0][0] + below  # a byte that the language has never shown
    stacked = [escape[0]]
    for k in range(1, order + 1):
        tail = _suffix_rows(nodes[k], nodes[k - 1], k)
        stacked.append(escape[k] + stacked[k - 1][tail])
    shorter = np.full(1, new)  # cost of the byte in the context one byte shorter
    for k in range(order + 1):
        if k:
            shorter_cost = shorter[_suffix_rows(levels[k], levels[k - 1], k + 1)]
        else:
            shorter_cost = np.full(len(levels[0]), below)
        with np.errstate(divide="ignore", invalid="ignore"):
            found = np.log2(sums[k] + kinds[k])[parents[k]] - np.log2(n[k])
        whole_cost = np.where(n[k] > 0, found, escape[k][parents[k]] + shorter_cost)
        rows = first[k] + 1 + np.arange(len(levels[k]))
        cost[rows] = whole_cost - stacked[k][parents[k]]
        if k + 1 <= order:
            context[rows] = stacked[k + 1]
        else:  # the context that goes on from a longest sequence is its tail
            context[rows] = stacked[order][_suffix_rows(levels[k], levels[k - 1], k + 1)]
        shorter = whole_cost
    cost[0], context[0] = new - escape[0][0], escape[0][0]


def train(
    docs: DataFrame, eligible: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", order: int = MAX_ORDER
) -> Model:
    """Learn the trees from a bounded sample of the eligible rows.

    Counting is distributed; what reaches the driver are the different sequences of the sample.
    """
    sample = training_rows(docs, eligible, key, text, lang)
    counted = sample.mapInArrow(_gram_counts(order), "lang string, gram bigint, n bigint")
    summed = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    counts: dict[str, dict[int, int]] = {}
    if summed.num_rows:
        for name in pc.unique(summed.column("lang")).to_pylist():
            own = summed.filter(pc.equal(summed.column("lang"), name))
            counts[name] = dict(zip(own.column("gram").to_pylist(), own.column("n").to_pylist()))
    return build_model(counts, order)


def code_lengths(model: Model, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bits for each text by each language.  Works through the bytes in blocks of a fixed size."""
    n, order = len(at) - 1, model.order
    bits = np.zeros((n, len(model.langs)))
    empty = model.context[0]
    starts = at[:-1]
    for begin in range(0, len(data), _BLOCK):
        lead = max(0, begin - order)
        end = min(begin + _BLOCK, len(data))
        symbol = model.symbols[data[lead:end]].astype(np.int32)
        fresh = starts[(starts >= lead) & (starts < end)] - lead  # texts that begin here
        known = np.zeros(len(symbol), np.int32)
        longest = np.zeros(len(symbol), np.int64)
        for k, step in enumerate(model.steps):
            if k == 0:
                known = step[0][symbol]
            else:
                before = np.empty_like(known)
                before[1:], before[:1] = known[:-1], 0
                before[fresh] = 0
                known = step.ravel()[before * np.int32(step.shape[1]) + symbol]
            longest = np.where(known > 0, model.first[k] + known, longest)
        own = longest[begin - lead :]
        inner = np.unique(np.concatenate([[begin], starts[(starts > begin) & (starts < end)]])).astype(np.int64)
        sums = np.add.reduceat(model.cost[own] + model.context[own], inner - begin, axis=0)
        rows = buffers.owner(at[:-1], inner)
        np.add.at(bits, rows, sums)
        # a context counts for the byte after it: add that of a text's start, take off that of its end
        ends = at[1:][(at[1:] > begin) & (at[1:] <= end) & (at[1:] > at[:-1])]
        last = buffers.owner(at[:-1], ends - 1)
        np.add.at(bits, last, -model.context[own[ends - 1 - begin]])
    bits[np.diff(at) > 0] += empty
    return bits


def _judge(learned: Model, texts: pa.Array):
    """Language, score and bits per byte of each text."""
    lettered = np.array([bool(x) and _LETTER.search(x) is not None for x in texts.to_pylist()], bool)
    if not learned.langs:
        lettered[:] = False
    names, scores, rates = [UNDETERMINED] * len(texts), np.zeros(len(texts)), [None] * len(texts)
    if lettered.any():
        data, at = buffers.utf8(texts)
        bits = code_lengths(learned, data, at)
        best = bits.argmin(1)
        least = bits[np.arange(len(bits)), best]
        share = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(1)
        for i in np.flatnonzero(lettered):
            names[i], scores[i] = learned.langs[best[i]], share[i]
            rates[i] = least[i] / (at[i + 1] - at[i])
    return names, scores, rates


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, bits_per_byte`` of every whole text, row by row.

    The language with the shortest code wins, the first by name among equals; the score is its
    share of the probability of the text.  A null text, one without a letter, and any text if no
    language was learned is ``und`` with score 0 and null bits per byte.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_byte", pa.float64())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.pieces(batches, "text"):
            yield buffers.arrow(schema, batch.column("doc_id"), *_judge(shared.value, batch.column("text")))

    narrow = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(rows, "doc_id bigint, lang_pred string, score double, bits_per_byte double")


def annotate(docs: DataFrame, model: Model, text: str = "text", prefix: str = "__") -> DataFrame:
    """The rows with all their columns, and ``lang`` and ``bits`` (per byte) as in ``predict``, named with the prefix."""
    added = [f"{prefix}lang", f"{prefix}bits"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.pieces(batches, text):
            names, _, rates = _judge(shared.value, batch.column(text))
            more = [pa.array(names, pa.string()), pa.array(rates, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *added])

    schema = T.StructType([*docs.schema, T.StructField(added[0], T.StringType()), T.StructField(added[1], T.DoubleType())])
    return docs.mapInArrow(rows, schema)
