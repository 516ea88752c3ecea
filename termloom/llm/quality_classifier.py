"""A quality score of whole documents, learned from labelled ones by a network over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import buffers, byte_cnn

# Training: about so many labelled rows drawn from all by a hash, with their whole texts.
SAMPLE_ROWS = 3000
THRESHOLD = 0.3


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int64()), ("chunks", pa.binary())])
    for batch in buffers.pieces(batches, "text"):
        data, at = buffers.utf8(batch.column("text"))
        out = []
        for begin, end in zip(at[:-1], at[1:]):
            starts = np.array(byte_cnn.chunk_starts(int(end - begin)), np.int64) + begin
            out.append(byte_cnn.cut(data, starts, np.full(len(starts), end)).tobytes())
        yield buffers.arrow(schema, batch.column("doc_id"), batch.column("label"), out)


def train(
    docs: DataFrame, labels: DataFrame, label: str, eligible: Column, key: str = "doc_id", text: str = "text",
    rows: int = SAMPLE_ROWS,
) -> byte_cnn.ByteNet:
    """Learn from at most about ``rows`` of the labelled rows that ``eligible``, on the labels, lets through."""
    usable = labels.where(eligible & F.col(label).isin(0, 1) & F.col(key).isNotNull())
    marked = usable.groupBy(F.col(key).cast("bigint").alias("doc_id")).agg(F.max(label).cast("bigint").alias("label"))
    share = rows / max(1, marked.count())
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = marked.where(drawn < share)  # about `rows` rows, whatever the table's size
    texts = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = texts.join(F.broadcast(sample), "doc_id").mapInArrow(
        _chunks, "doc_id bigint, label bigint, chunks binary"
    ).toArrow().sort_by([("doc_id", "ascending"), ("chunks", "ascending")])
    parts = [np.frombuffer(c, np.uint8).reshape(-1, byte_cnn.CHUNK) for c in found.column("chunks").to_pylist()]
    if not parts:
        return byte_cnn.fit(np.zeros((0, byte_cnn.CHUNK), np.uint8), np.zeros(0, np.int64), np.zeros(0))
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return byte_cnn.fit(np.concatenate(parts), owner, found.column("label").to_numpy())


def predict(
    docs: DataFrame, net: byte_cnn.ByteNet, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, score, predicted`` for every whole text, row by row.

    A null or empty text is one chunk of nothing and gets the score of that; with labels of one
    kind, or none, every score is the smoothed share of label 1.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.pieces(batches, "text"):
            scores = byte_cnn.score(shared.value, *buffers.utf8(batch.column("text")))
            yield buffers.arrow(schema, batch.column("doc_id"), scores, (scores >= threshold).astype(np.int32))

    narrow = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(rows, "doc_id bigint, score double, predicted int")
