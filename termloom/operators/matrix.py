"""The document-term matrix and the shapes it can be given."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.numbering import row_index
from ..plans.spec import FeatureSpec


@dataclass(frozen=True)
class Matrix:
    """``docs``: one row per document with its key, ``cells`` and the fields asked for.

    ``hits`` holds only the key and the sort columns of the same documents; row numbers are
    worked out on it, so that neither text nor cells are sorted.  Once numbered, ``docs`` has a
    column ``row``.
    """

    docs: DataFrame
    hits: DataFrame
    spec: FeatureSpec
    key: tuple[str, ...]
    order: tuple[Column, ...]

    # -- row numbers ------------------------------------------------------------------------
    def numbered(self) -> "Matrix":
        """Give every document its row number in result order."""
        return self if "row" in self.docs.columns else self._numbered

    @cached_property
    def _numbered(self) -> "Matrix":
        # Numbers are settled once per matrix.  They are the side that is hashed, so the cells
        # meet them without being sorted.
        rows = row_index(self.hits, list(self.order)).select(*self.key, "row")
        return replace(self, docs=self.docs.join(rows.hint("shuffle_hash"), list(self.key)))

    # -- sparse forms -------------------------------------------------------------------------
    def to_dict(self) -> DataFrame:
        """One ``map<col, value>`` per document; a document without cells has an empty map."""
        return self.docs.withColumn("matrix", F.map_from_entries("cells")).drop("cells")

    def to_coo(self) -> DataFrame:
        """``(row, col, data)`` triples."""
        return coo(self.numbered().docs, ["row"])

    def to_vector(self) -> DataFrame:
        """Columns and values of each document as two arrays."""
        return (
            self.docs.withColumn("indices", F.transform("cells", lambda c: c["col"]))
            .withColumn("values", F.transform("cells", lambda c: c["value"]))
            .drop("cells")
        )

    def render(self, sparse_format: str = "dict") -> DataFrame:
        """``dict`` or ``coo``, in any case."""
        forms = {"dict": self.to_dict, "coo": self.to_coo}
        if sparse_format.lower() not in forms:
            raise ValueError(f"sparse format {sparse_format!r} is neither 'dict' nor 'coo'")
        return forms[sparse_format.lower()]()

    def shape(self) -> DataFrame:
        """One row ``(n_rows, n_cols)``; documents without cells count."""
        n_cols = F.lit(self.spec.n_cols).cast("int").alias("n_cols")
        return self.hits.agg(F.count("*").alias("n_rows")).select("n_rows", n_cols)

    def feature_names(self) -> list[str]:
        return self.spec.feature_names()

    # -- reshaping ----------------------------------------------------------------------------
    def features_and_label(self) -> DataFrame:
        """Split off the last column: ``cells`` keeps the others, ``label`` holds its value."""
        last = self.spec.n_cols - 1
        label = F.filter("cells", lambda c: c["col"] == last)
        features = F.filter("cells", lambda c: c["col"] < last)
        return self.docs.withColumn(
            "label", F.coalesce(F.get(label, F.lit(0))["value"], F.lit(0.0))
        ).withColumn("cells", features)

    def batches(self, size: int, cutoff: int = -1) -> "Matrix":
        """Cut the numbered rows into batches of ``size``; ``cutoff`` keeps the first ones only."""
        if size < 1:
            raise ValueError("a batch holds at least one document")
        docs = (
            self.numbered()
            .docs.withColumn("batch_id", F.floor(F.col("row") / F.lit(size)).cast("bigint"))
            .withColumn("row_in_batch", F.pmod(F.col("row"), F.lit(size)).cast("bigint"))
        )
        if cutoff >= 0:
            docs = docs.where(F.col("batch_id") < cutoff)
        return replace(self, docs=docs)


def coo(docs: DataFrame, rows: list[str]) -> DataFrame:
    """Cells of a frame of documents as triples; the row columns are repeated per cell."""
    # The outer form keeps Spark from repeating the whole analysis in a pushed-down size filter.
    return (
        docs.select(*rows, F.explode_outer("cells").alias("c"))
        .select(*rows, F.col("c.col").alias("col"), F.col("c.value").alias("data"))
        .where(F.col("col").isNotNull())
    )


def sum_duplicates(triples: DataFrame) -> DataFrame:
    """Add up entries with the same row and column."""
    return triples.groupBy("row", "col").agg(F.sum("data").alias("data"))


def rows_of(triples: DataFrame) -> DataFrame:
    """Compressed rows of a COO frame: column and value arrays per row, columns ascending.

    Entries of one place are added up first, so a row is never longer than the matrix is wide.
    """
    cell = F.struct(F.col("col"), F.col("data"))
    packed = sum_duplicates(triples).groupBy("row").agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    return packed.select(
        "row",
        F.transform("cells", lambda c: c["col"]).alias("indices"),
        F.transform("cells", lambda c: c["data"]).alias("values"),
    )


def cells_of(dicts: DataFrame, column: str = "matrix") -> DataFrame:
    """Back from ``map<col, value>`` to cells in column order."""
    entries = F.transform(
        F.map_entries(column), lambda e: F.struct(e["key"].alias("col"), e["value"].alias("value"))
    )
    return dicts.withColumn("cells", F.sort_array(entries)).drop(column)
