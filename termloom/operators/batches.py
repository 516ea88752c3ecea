"""Batches of a matrix: shapes, export and concatenation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.numbering import sum_before
from ..plans.sizing import broadcast_limit, salted_join
from .matrix import coo

_OFFSET_BYTES = 64  # generous size of one (batch_id, offset) pair in a broadcast


def batch_coo(docs: DataFrame) -> DataFrame:
    """``(batch_id, row, col, data)`` of scrolled or scanned documents, rows from 0 per batch."""
    return coo(docs.withColumn("row", F.col("row_in_batch")), ["batch_id", "row"])


def batch_shapes(docs: DataFrame, n_cols: int) -> DataFrame:
    """``(batch_id, n_rows, n_cols)``; documents without cells count."""
    return docs.groupBy("batch_id").agg(F.count("*").alias("n_rows")).withColumn(
        "n_cols", F.lit(n_cols)
    )


def concat_batches(triples: DataFrame, shapes: DataFrame) -> DataFrame:
    """Merge COO batches into one matrix: each batch starts where the rows before it end."""
    offsets = sum_before(shapes.select("batch_id", "n_rows"), "batch_id", "n_rows", "before")
    offsets = offsets.select("batch_id", "before")
    # The table of batches is settled, so counting it is cheap; broadcast it only if small.
    if offsets.count() * _OFFSET_BYTES <= broadcast_limit(triples.sparkSession):
        joined = triples.join(F.broadcast(offsets), "batch_id")
    else:
        joined = salted_join(triples, offsets, ["batch_id"], F.struct("row", "col"))
    return joined.select((F.col("row") + F.col("before")).alias("row"), "col", "data")


def concat_shape(shapes: DataFrame) -> DataFrame:
    """Shape of the merged matrix."""
    return shapes.agg(F.sum("n_rows").alias("n_rows"), F.max("n_cols").alias("n_cols"))
