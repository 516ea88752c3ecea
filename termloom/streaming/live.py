"""Vectorizing documents as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import FieldMapping
from ..operators.matrix import Matrix
from ..operators.term_stats import term_stats, term_vectors
from ..plans.cells import with_cells
from ..plans.sizing import settle, vocabulary_bytes
from ..plans.spec import FeatureSpec


def vectorize_stream(
    stream: DataFrame,
    spec: FeatureSpec,
    key: str | list[str] = "doc_id",
    mapping: FieldMapping = FieldMapping(),
    fields: list[str] | None = None,
    **options,
) -> DataFrame:
    """A stream of ``(key, fields..., cells)`` from a stream of documents.

    Columns are fixed and a document fills its own row, so there is no state, no join and no
    watermark: append mode works as it is, and a dictionary of any size that the specification
    can hold on the driver is looked up in the row.  Corpus statistics have no fixed value on a stream;
    use :func:`vectorize_batches` for them.
    """
    if spec.needs_statistics:
        raise ValueError("doc_freq and ttf need a corpus: use vectorize_batches")
    keys = [key] if isinstance(key, str) else list(key)
    largest = max([0, *(vocabulary_bytes(t) for t, _ in spec.term_columns().values())])
    cells = with_cells(stream, spec, key=keys, mapping=mapping, largest_broadcast=largest, **options)
    return cells.select(*dict.fromkeys([*keys, *(fields or [])]), "cells")


def vectorize_batches(
    stream: DataFrame,
    spec: FeatureSpec,
    path: str,
    checkpoint: str,
    corpus: DataFrame | None = None,
    statistics: DataFrame | None = None,
    key: str | list[str] = "doc_id",
    mapping: FieldMapping = FieldMapping(),
    **trigger,
) -> StreamingQuery:
    """Each micro-batch is one COO batch with its own row numbers, in the folder of its epoch.

    An epoch that is run again replaces its folder.  ``doc_freq`` and ``ttf`` describe a stored
    ``corpus``, counted once when the stream is started, or a table of ``statistics``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if corpus is not None and statistics is None and spec.needs_statistics:
        # Counted once, not in each micro-batch.
        fields = [f for f in spec.term_columns() if f in corpus.columns]
        statistics, corpus = settle(term_stats(corpus, fields, mapping)), None
    given = {"corpus": corpus, "statistics": statistics}
    options = {name: frame for name, frame in given.items() if frame is not None}

    def write(batch: DataFrame, epoch: int) -> None:
        # Numbering reads the documents again; the slim rows are kept, so the source is read once.
        cells = with_cells(batch, spec, key=keys, mapping=mapping, **options)
        docs = cells.select(*keys, "cells").persist()
        try:
            triples = Matrix(docs, docs.select(*keys), spec, tuple(keys), tuple(F.col(k) for k in keys)).to_coo()
            triples.write.mode("overwrite").parquet(f"{path}/batch_id={epoch}")
        finally:
            docs.unpersist()

    started = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return started.trigger(**(trigger or {"availableNow": True})).start()


def stream_statistics(
    stream: DataFrame, field: str, mapping: FieldMapping = FieldMapping()
) -> DataFrame:
    """Running ``(field, term, doc_freq, ttf)``: the state is one row per term."""
    vectors = term_vectors(stream, [field], key=[], mapping=mapping)
    return vectors.groupBy("field", "term").agg(
        F.count("*").alias("doc_freq"), F.sum("tf").alias("ttf")
    )


def keep_statistics(stats: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Store the statistics: every epoch adds the terms that changed, in a folder of its own."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    started = stats.writeStream.outputMode("update").foreachBatch(write)
    started = started.option("checkpointLocation", checkpoint)
    return started.trigger(**(trigger or {"availableNow": True})).start()


def stored_statistics(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`keep_statistics` stored.  Counts only grow, so the largest is the latest."""
    return (
        spark.read.parquet(path)
        .groupBy("field", "term")
        .agg(F.max("doc_freq").alias("doc_freq"), F.max("ttf").alias("ttf"))
    )


def merge_statistics(spark: SparkSession, path: str, into: str) -> DataFrame:
    """Write the latest counts of all epochs to ``into`` as one table, and return it.

    Reading the merged table no longer goes through every epoch; it serves as ``statistics`` of
    :func:`vectorize_batches`.
    """
    stored_statistics(spark, path).write.mode("overwrite").parquet(into)
    return spark.read.parquet(into)
