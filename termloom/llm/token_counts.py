"""Token counts of whole texts: each distinct pre-token is split into pieces once for the corpus.

The texts are read twice.  The first pass counts distinct pre-tokens; each is then given to the
tokenizer's model once, which yields a table of piece counts.  The second pass counts the pre-tokens
of each document and adds up: the most frequent entries, as many as fit a fixed number of bytes, are at
hand in the tasks, the others are joined to the document's frequencies.  Ids are never written.

A pre-token is the tokenizer's own.  Texts fall apart at blanks, tabs and line breaks, across which
neither normalisation nor splitting reaches.  Runs of printable ASCII are split by byte classes in numpy;
other runs go through the tokenizer's normalizer and splitter, once per distinct run of a piece of
text.  A run with ``<|`` may hold a special token and is one pre-token, counted as the library does.

Odd rows: a null text is an empty one, with no token; every row gives one row, also with a null or
repeated id; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termloom.plans.sizing import salted_join

from . import buffers
from .storage import settle

# The splitting pattern of the tokenizers that this module counts for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LIMIT = 2_048

PIECE_BYTES = 2 << 20
# Frequent pre-tokens at hand in every task: bytes of them, with a number each.
HOT_BYTES = 12 << 20
# A longer pre-token is never at hand; it is joined apart, as it may yet be frequent.
LONG_BYTES = 256
# Distinct runs outside ASCII that a worker remembers.
MEMO_RUNS = 100_000
# What marks a run that is counted as a whole; no pre-token holds this byte.
WHOLE = "\0"

LETTER, DIGIT, OTHER = 1, 2, 3
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = LETTER
_CLASS[ord("0") : ord("9") + 1] = DIGIT
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0D]] = True
_PRINTABLE = np.zeros(256, bool)
_PRINTABLE[0x21:0x7F] = True

FOUND = pa.schema([("piece", pa.string()), ("n", pa.int64())])
COUNTED = pa.schema([("piece", pa.string()), ("n", pa.int64()), ("size", pa.int64())])
COLD = pa.list_(pa.struct([("piece", pa.string()), ("n", pa.int64())]))
ROWS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_hot", pa.int64()), ("cold", COLD)])


def load(path: str) -> str:
    """The tokenizer's file as text, if it splits texts in the way this module does."""
    text = Path(path).read_text(encoding="utf-8")
    config = json.loads(text)
    steps = [
        {k: v for k, v in s.items() if k in ("type", "pattern", "behavior", "invert", "add_prefix_space", "use_regex")}
        for s in (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    ]
    normal = [n["type"] for n in (config.get("normalizer") or {}).get("normalizers", [])]
    wanted = [
        {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False},
    ]
    plain = all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"]) for t in config["added_tokens"])
    if steps != wanted or normal != ["NFC", "Replace", "Lowercase"] or not plain:
        raise ValueError(f"{path} does not split lower-cased words in the way known here")
    return text


class _Splitter:
    """Pre-tokens of texts; keeps what it found for runs outside ASCII."""

    def __init__(self, tokenizer: str):
        self._tokenizer = Tokenizer.from_str(tokenizer)
        self._tokenizer.no_truncation()
        self._memo: dict[str, list[str]] = {}

    def size(self, piece: str) -> int:
        """How many tokens a pre-token becomes."""
        if piece.startswith(WHOLE):
            return len(self._tokenizer.encode(piece[1:], add_special_tokens=False).ids)
        return len(self._tokenizer.model.tokenize(piece))

    def _run(self, run: str) -> list[str]:
        known = self._memo.get(run)
        if known is None:
            if "<|" in run:
                known = [WHOLE + run]
            else:
                normal = self._tokenizer.normalizer.normalize_str(run)
                known = [piece for piece, _ in self._tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
            if len(run) <= LONG_BYTES:
                if len(self._memo) >= MEMO_RUNS:
                    self._memo.clear()
                self._memo[run] = known
        return known

    def split(self, texts: pa.Array) -> tuple[np.ndarray, pa.ChunkedArray]:
        """Every pre-token of the texts, and the row it is in."""
        data, at = buffers.utf8(texts)
        buffer, begins = buffers.separated(data, at)
        # Two more bytes, so that looking ahead stays inside.
        buffer = np.concatenate([buffer, np.full(2, buffers.BREAK, np.uint8)])
        blank = _BLANK[buffer]
        odd = ~(_PRINTABLE[buffer] | blank)
        odd[:-1] |= (buffer[:-1] == ord("<")) & (buffer[1:] == ord("|"))
        start, end = buffers.spans(~blank)
        oddities = np.concatenate([[0], np.cumsum(odd)])
        strange = oddities[end] > oddities[start]
        edge = np.zeros(len(buffer) + 1, np.int8)
        edge[start[~strange]] += 1
        edge[end[~strange]] -= 1
        plain = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        lower = buffers.LOWER[buffer]
        kind = np.where(plain, _CLASS[lower], 0)
        first, last = _ascii_pieces(lower, kind)
        pieces = _strings(lower[plain], last - first)
        rows = buffers.owner(begins, first)
        start, end = start[strange], end[strange]
        if not len(start):
            return rows, pa.chunked_array([pieces])
        edge[:] = 0
        edge[start] += 1
        edge[end] -= 1
        taken = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        runs = pc.dictionary_encode(_strings(buffer[taken], end - start))
        split = [self._run(run) for run in runs.dictionary.to_pylist()]
        of = runs.indices.to_numpy()
        many = np.array([len(s) for s in split], np.int64)
        offsets = np.concatenate([[0], np.cumsum(many)])
        times = many[of]
        inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        flat = pa.array([p for s in split for p in s], pa.large_string())
        more = flat.take(pa.array(np.repeat(offsets[:-1][of], times) + inner))
        strange_rows = np.repeat(buffers.owner(begins, start), times)
        return np.concatenate([rows, strange_rows]), pa.chunked_array([pieces, more])


def _strings(letters: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters)))


def _ascii_pieces(lower: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens by byte classes: letters, single digits, runs of anything else.

    An apostrophe that begins a run of other marks takes the ending after it along ("'s", "'re").
    """
    before = np.concatenate([np.zeros(1, np.uint8), kind[:-1]])
    starts = (kind != 0) & ((kind != before) | (kind == DIGIT))
    quote = np.flatnonzero((lower[:-2] == ord("'")) & (kind[:-2] == OTHER) & (before[:-2] != OTHER) & (kind[1:-1] == LETTER))
    one, two = lower[quote + 1], np.where(kind[quote + 2] == LETTER, lower[quote + 2], 0)
    short = np.isin(one, list(b"stmd"))
    long = np.zeros(len(quote), bool)
    for a, b in (b"re", b"ve", b"ll"):
        long |= (one == a) & (two == b)
    starts[quote[short | long] + 1] = False
    after = np.concatenate([quote[short] + 2, quote[long] + 3])
    starts[after[kind[after] == LETTER]] = True
    edges = np.flatnonzero(starts | ((kind == 0) & (before != 0)))
    opens = starts[edges]
    return edges[opens], np.append(edges, len(kind))[1:][opens]


def _piece_counts(docs: DataFrame, tokenizer) -> DataFrame:
    """``piece, n, size`` of all pre-tokens: how often in the corpus, and how many tokens each."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = _Splitter(tokenizer.value)
        for part in buffers.pieces(batches, "text", PIECE_BYTES):
            counts = pc.value_counts(splitter.split(part.column("text"))[1])
            yield buffers.arrow(FOUND, counts.field("values").cast(pa.string()), counts.field("counts"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = _Splitter(tokenizer.value)
        for batch in batches:
            sizes = [splitter.size(piece) for piece in batch.column("piece").to_pylist()]
            yield buffers.arrow(COUNTED, batch.column("piece"), batch.column("n"), sizes)

    found = docs.select("text").mapInArrow(find, "piece string, n bigint")
    total = found.groupBy("piece").agg(F.sum("n").alias("n"))
    return settle(total.mapInArrow(measure, "piece string, n bigint, size bigint"))


def _at_hand(counted: DataFrame, hot_bytes: int) -> pa.Table:
    """``piece, size`` of the most frequent pre-tokens, ``hot_bytes`` at most.

    Frequencies are cut at a step of a logarithmic scale, whose few steps are summed up first.
    """
    room = F.octet_length("piece") + 16
    step = F.floor(8 * F.log2("n")).alias("step")
    short = counted.where(F.octet_length("piece") <= LONG_BYTES)
    steps = short.groupBy(step).agg(F.sum(room).alias("room")).orderBy(F.desc("step")).collect()
    least, used = None, 0
    for row in steps:
        used += row["room"]
        if used > hot_bytes:
            break
        least = row["step"]
    if least is None:
        return pa.table({"piece": pa.array([], pa.large_string()), "size": pa.array([], pa.int64())})
    hot = short.where(F.floor(8 * F.log2("n")) >= least).select("piece", "size").toArrow()
    return hot.set_column(0, "piece", hot.column("piece").cast(pa.large_string()))


def _per_document(docs: DataFrame, tokenizer, hot) -> DataFrame:
    """Per row: what the pre-tokens at hand add up to, and how often it has each of the others."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, known = _Splitter(tokenizer.value), hot.value
        names = known.column("piece").combine_chunks()
        sizes = known.column("size").to_numpy()
        for part in buffers.pieces(batches, "text", PIECE_BYTES):
            rows, pieces = splitter.split(part.column("text"))
            place = pc.index_in(pieces, names).combine_chunks()
            cold = place.is_null().to_numpy(zero_copy_only=False)
            place = pc.fill_null(place, 0).to_numpy()
            n = part.num_rows
            n_hot = buffers.per_row(rows[~cold], n, sizes[place[~cold]]) if len(sizes) else np.zeros(n, np.int64)
            others = pa.table({"row": rows[cold], "piece": pieces.filter(pa.array(cold))})
            groups = others.group_by(["row", "piece"]).aggregate([([], "count_all")]).sort_by("row")
            ends = np.searchsorted(groups.column("row").to_numpy(), np.arange(n + 1))
            each = pa.StructArray.from_arrays(
                [groups.column("piece").combine_chunks().cast(pa.string()), groups.column("count_all").combine_chunks()],
                fields=list(COLD.value_type),
            )
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)
            yield buffers.arrow(ROWS, part.column("doc_id"), part.column("n_bytes"), n_hot, lists)

    return docs.mapInArrow(add, "doc_id bigint, n_bytes bigint, n_hot bigint, cold array<struct<piece:string,n:bigint>>")


def count_tokens(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT, hot_bytes: int = HOT_BYTES
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, for the tokenizer in the file ``path``."""
    context = docs.sparkSession.sparkContext
    tokenizer = context.broadcast(load(path))
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    slim = docs.select(
        F.col(key).cast("bigint").alias("doc_id"), F.octet_length(value).cast("bigint").alias("n_bytes"), value.alias("text")
    )
    counted = _piece_counts(slim, tokenizer)
    hot = context.broadcast(_at_hand(counted, hot_bytes))
    # Numbered before it is written, so a row keeps its number.
    rows = settle(_per_document(slim, tokenizer, hot).withColumn("at", F.monotonically_increasing_id()))
    cold = rows.select("at", F.explode("cold").alias("c")).select("at", "c.*")
    known = counted.select("piece", "size")
    # A short pre-token that is not at hand is rarer than all that are; a long one may be in every row.
    is_long = F.octet_length("piece") > LONG_BYTES
    short = cold.where(~is_long).join(known.where(~is_long), "piece")
    long = salted_join(cold.where(is_long), known.where(is_long), ["piece"], F.col("at"))
    sums = short.select("at", "n", "size").unionByName(long.select("at", "n", "size"))
    rest = sums.groupBy("at").agg(F.sum(F.col("n") * F.col("size")).alias("n_cold"))
    total = F.col("n_hot") + F.coalesce("n_cold", F.lit(0))
    joined = rows.select("at", "doc_id", "n_bytes", "n_hot").join(rest, "at", "left")
    return joined.select("doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit"))
