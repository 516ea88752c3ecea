"""Byte-level BPE by backtracking over longest matches.

Two neighbouring tokens are compatible if merging by rank would leave the border between them
alone.  A sequence whose neighbours are all compatible is the one that merging by rank yields, so
encoding is a search: take the longest token that starts here, fall back to shorter prefixes, and
give up a position for good once nothing compatible starts there.  Each position is given up at
most once and each token tried at most once from it, which keeps the search linear.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import buffers

# Encoded words a task remembers; the memory starts afresh when it is full.
REMEMBERED_WORDS = 250_000
REMEMBERED_LENGTH = 64
REMEMBERED_PAIRS = 250_000
_IDS, _LISTED = itemgetter(0), itemgetter(1)
DIGEST = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
)


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and number."""
    return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in content.splitlines() if x)}


def latin1_pattern(pattern: str) -> re.Pattern | None:
    """The same pattern for texts within Latin-1, with its classes spelled out, or None.

    The standard engine is twice as fast but knows no Unicode properties.
    """
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        members = "".join(re.escape(c) for c in map(chr, range(256)) if regex.fullmatch(name, c))
        pattern = re.sub(r"\[[^\]]*\]", lambda m: m[0].replace(name, members), pattern)
        pattern = pattern.replace(name, f"[{members}]")
        if name == r"\s":
            pattern = pattern.replace(r"\S", f"[^{members}]")
    return None if re.search(r"\\[pPSwWdDbBX]", pattern) else re.compile(pattern)


class BytePairEncoder:
    """Encodes and decodes by a rank table that holds every single byte."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._words = regex.compile(pattern)
        self._latin1_words = latin1_pattern(pattern)
        self._automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self._automaton.make_automaton()
        self._dense = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]
        self._sizes = {rank: len(token) for rank, token in self.tokens.items()}
        self._shorter: dict[int, int] = {}
        self._parts: dict[int, tuple[int, int]] = {}
        self._made: dict[tuple[int, int], int] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        for rank in sorted(self.tokens):
            self._take_apart(rank)
        self._memory: dict[str, tuple[tuple[int, ...], str]] = {}

    def _prefix(self, token: int) -> int:
        """The longest token that is a proper prefix of a token, or -1."""
        content, ranks = self.tokens[token], self.ranks
        return next((ranks[content[:n]] for n in range(len(content) - 1, 0, -1) if content[:n] in ranks), -1)

    def _take_apart(self, token: int) -> None:
        """Find the last merge that makes a token out of two of lower rank."""
        content = self.tokens[token]
        left = self._shorter[token] = self._prefix(token)
        while left >= 0:
            right = self.ranks.get(content[len(self.tokens[left]) :], -1)
            if left < token and 0 <= right < token and self._border_holds(left, right):
                self._parts[token] = (left, right)
                self._made[left, right] = token
                return
            left = self._prefix(left)

    def _border_holds(self, left: int, right: int) -> bool:
        """Whether no merge across the border comes before one of the merges inside the two.

        Undo the merges next to the border from the latest to the earliest, and look each time
        whether the two neighbours would have merged first.
        """
        bound = 1 << 62
        while True:
            across = self._made.get((left, right))
            if across is not None and across < bound:
                return False
            undo_left = left > right
            parts = self._parts.get(left if undo_left else right)
            if parts is None:  # a single byte: the other side may still have merges to undo
                undo_left = not undo_left
                parts = self._parts.get(left if undo_left else right)
                if parts is None:
                    return True
            if undo_left:
                bound, left = left, parts[1]
            else:
                bound, right = right + 1, parts[0]

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(word)
        if whole is not None:
            return (whole,)
        n = len(word)
        longest = [0] * n
        for end, (size, token) in self._automaton.iter(word.decode("latin-1")):
            longest[end - size + 1] = token  # ends grow, so the last one is the longest
        sizes, shorter, fits = self._sizes, self._shorter, self._fits
        usable = [True] * (n + 1)
        path: list[int] = []
        at, token, last = 0, longest[0], -1
        while True:
            end = at + sizes[token]
            if usable[end]:
                good = last < 0 or fits.get((last, token))
                if good is None:
                    if len(fits) >= REMEMBERED_PAIRS:
                        fits.clear()
                    good = fits[last, token] = self._border_holds(last, token)
                if good:
                    path.append(token)
                    if end == n:
                        return tuple(path)
                    at, last, token = end, token, longest[end]
                    continue
            token = shorter[token]
            while token < 0:
                usable[at] = False
                if last < 0:
                    raise ValueError("no valid sequence of tokens")
                path.pop()
                at -= sizes[last]
                token, last = shorter[last], path[-1] if path else -1

    def _entry(self, match: str) -> tuple[tuple[int, ...], str]:
        ids = self.encode_word(match.encode("utf-8"))
        entry = (ids, " ".join(map(str, ids)))
        if len(match) <= REMEMBERED_LENGTH:
            if len(self._memory) >= REMEMBERED_WORDS:
                self._memory.clear()
            self._memory[match] = entry
        return entry

    def encode(self, text: str) -> tuple[list[int], str]:
        """The ids of a text, and the same in decimal, joined by a space.

        Special tokens are ordinary text.
        """
        words = self._words
        if self._latin1_words is not None:
            try:
                text.encode("latin-1")
                words = self._latin1_words
            except UnicodeEncodeError:
                pass
        matches = words.findall(text)
        if not matches:
            return [], ""
        entries = list(map(self._memory.get, matches))
        if None in entries:
            entries = [e or self._memory.get(m) or self._entry(m) for e, m in zip(entries, matches)]
        return list(chain.from_iterable(map(_IDS, entries))), " ".join(map(_LISTED, entries))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self._dense.__getitem__, ids))


_encoders: dict[tuple[str, str], BytePairEncoder] = {}


def encoder(content: bytes, pattern: str) -> BytePairEncoder:
    """One encoder per worker process and vocabulary."""
    name = (hashlib.sha256(content).hexdigest(), pattern)
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = BytePairEncoder(parse_ranks(content), pattern)
    return _encoders[name]


def _ranks(docs: DataFrame, rank_file: str):
    # A vocabulary is a file of a fixed size, read once and sent to each executor once.
    with open(rank_file, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _inputs(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))


def encode(docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids``: every text as token ids.  A null or empty text has no ids."""
    ranks = _ranks(docs, rank_file)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(ranks.value, pattern)
        for batch in buffers.pieces(batches, "text"):
            ids = [coder.encode(x or "")[0] for x in batch.column("text").to_pylist()]
            yield buffers.arrow(schema, batch.column("doc_id"), ids)

    return _inputs(docs, key, text).mapInArrow(rows, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, rank_file: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, content``: the bytes that the ids stand for.  Null ids stand for none."""
    ranks = _ranks(encoded, rank_file)
    schema = pa.schema([("doc_id", pa.int64()), ("content", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(ranks.value, "")
        for batch in batches:
            content = [coder.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield buffers.arrow(schema, batch.column("doc_id"), content)

    narrow = encoded.select(F.col(key).cast("bigint").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    return narrow.mapInArrow(rows, "doc_id bigint, content binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text, decode the ids, and return digests of both.

    ``doc_id, n_tokens, ids_sha256`` (of the decimal ids joined by a space) and
    ``decoded_sha256``.  Row by row: nothing is shuffled, a null or empty text has 0 tokens and
    the digests of nothing, repeated rows give repeated results, a null id stays null.
    """
    ranks = _ranks(docs, rank_file)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(ranks.value, pattern)
        for batch in buffers.pieces(batches, "text"):
            counts, id_sums, decoded_sums = [], [], []
            for value in batch.column("text").to_pylist():
                ids, listed = coder.encode(value or "")
                counts.append(len(ids))
                id_sums.append(hashlib.sha256(listed.encode("ascii")).hexdigest())
                decoded_sums.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield buffers.arrow(DIGEST, batch.column("doc_id"), counts, id_sums, decoded_sums)

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _inputs(docs, key, text).mapInArrow(rows, schema)
