"""Storing matrices for other tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.matrix import Matrix, coo
from ..plans.sizing import settle
from ..plans.spec import FeatureSpec

TEXT_FORMATS = ("json", "csv")
# Fixed value: the first line of a sparse matrix in the Matrix Market exchange format.
MARKET_BANNER = "%%MatrixMarket matrix coordinate real general"


def write_matrix(
    frame: DataFrame,
    path: str,
    format: str = "parquet",
    partition_by: list[str] | None = None,
    mode: str = "errorifexists",
) -> None:
    """Write a DICT, COO or array form, with one folder level per column of ``partition_by``.

    ``batch_id`` makes one folder per batch.  JSON has string keys only, so a map of columns is
    written as an object; CSV takes the COO form alone.
    """
    maps = [n for n, kind in frame.dtypes if kind.startswith("map<int")]
    if format in TEXT_FORMATS:
        for name in maps:
            frame = frame.withColumn(name, F.col(name).cast("map<string,double>"))
    if partition_by:
        frame = _gathered(frame, partition_by)
    writer = frame.write.format(format).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def _gathered(frame: DataFrame, columns: list[str]) -> DataFrame:
    # Without this every task writes a small file into every folder.  Adaptive execution splits
    # the share of a frequent value again, so none has to pass through one task.
    return frame.hint("rebalance", *[F.col(c) for c in columns])


def write_batches(
    docs: DataFrame,
    spec: FeatureSpec,
    path: str,
    mode: str = "errorifexists",
    scanned: bool = False,
) -> DataFrame:
    """Export batches as cells per document, one folder per batch, and read them back.

    ``scanned`` batches lie in one task already and are written where they are.  The shapes can
    be counted from what was written, which is then the one fixed cut.
    """
    slim = docs.select("batch_id", "row_in_batch", "cells")
    slim = slim if scanned else _gathered(slim, ["batch_id"])
    slim.write.mode(mode).partitionBy("batch_id").parquet(path)
    written = docs.sparkSession.read.parquet(path)
    batch_id = F.col("batch_id").cast("bigint")
    return written.withColumn("batch_id", batch_id).withColumn("n_cols", F.lit(spec.n_cols))


def write_market(matrix: Matrix, path: str, mode: str = "errorifexists") -> None:
    """The whole matrix in the Matrix Market format: a folder of parts, one file when put together by name.

    The first part begins with the banner and the sizes; entries are sorted by row and column, which
    count from 1.  Spark's own text writer commits tasks, so a failed one leaves nothing behind.
    """
    entries = settle(matrix.to_coo())
    totals = matrix.shape().crossJoin(entries.agg(F.count("*").alias("nnz")))
    lines = _market_lines(totals, entries, [])
    ordered = lines.repartitionByRange("at", "col").sortWithinPartitions("at", "col")
    ordered.select("value").write.mode(mode).text(path)


def write_market_batches(matrix: Matrix, path: str, mode: str = "errorifexists") -> None:
    """Each batch of a matrix cut by ``batches`` as a file of its own, in the folder of its ``batch_id``.

    A batch is bounded, so one task writes it.
    """
    docs = matrix.docs.select("batch_id", F.col("row_in_batch").alias("row"), "cells")
    sized = docs.groupBy("batch_id").agg(F.count("*").alias("n_rows"), F.sum(F.size("cells")).alias("nnz"))
    totals = sized.withColumn("n_cols", F.lit(matrix.spec.n_cols))
    lines = _market_lines(totals, coo(docs, ["batch_id", "row"]), ["batch_id"])
    # One task per batch and, within it, one file after the other.
    ordered = lines.repartition("batch_id").sortWithinPartitions("batch_id", "at", "col")
    ordered.select("batch_id", "value").write.mode(mode).partitionBy("batch_id").text(path)


def _market_lines(totals: DataFrame, entries: DataFrame, by: list[str]) -> DataFrame:
    """``at, col, value``: the lines of files with their places; banner and sizes come before row 0."""
    def line(at: int | Column, col: int | Column, *words: Column | str) -> list[Column]:
        value = F.concat_ws(" ", *[F.lit(w) if isinstance(w, str) else w.cast("string") for w in words])
        places = [F.lit(p).cast("bigint") if isinstance(p, int) else p.cast("bigint") for p in (at, col)]
        return [places[0].alias("at"), places[1].alias("col"), value.alias("value")]

    banner = totals.select(*by, *line(-2, 0, MARKET_BANNER))
    sizes = totals.select(*by, *line(-1, 0, F.col("n_rows"), F.col("n_cols"), F.col("nnz")))
    row, col = F.col("row"), F.col("col")
    return banner.unionByName(sizes).unionByName(entries.select(*by, *line(row, col, row + 1, col + 1, F.col("data"))))
