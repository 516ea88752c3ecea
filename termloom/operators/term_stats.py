"""Term vectors and term statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import FieldMapping, term_counts


def term_vectors(
    df: DataFrame,
    fields: list[str],
    key: list[str] | str = "doc_id",
    mapping: FieldMapping = FieldMapping(),
    keep: list[str] | None = None,
) -> DataFrame:
    """``(key, field, term, tf)`` of every document and field, without a shuffle.

    A document lies in one row, so its terms are counted there.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kept = list(dict.fromkeys([*keys, *(keep or [])]))
    per_field = [_named_counts(mapping.tokens(df, name), name) for name in fields]
    counts = per_field[0] if len(per_field) == 1 else F.concat(*per_field)
    # The outer form keeps Spark from repeating the whole analysis in a pushed-down size filter.
    return (
        df.select(*kept, F.explode_outer(counts).alias("t"))
        .select(*kept, "t.field", "t.term", F.col("t.tf").cast("bigint").alias("tf"))
        .where(F.col("term").isNotNull())
    )


def _named_counts(tokens: Column, name: str) -> Column:
    def one(t: Column) -> Column:
        return F.struct(F.lit(name).alias("field"), t["term"].alias("term"), t["tf"].alias("tf"))

    return F.transform(term_counts(tokens), one)


def term_stats(
    df: DataFrame,
    fields: list[str],
    mapping: FieldMapping = FieldMapping(),
    scope: list[str] | None = None,
) -> DataFrame:
    """``(scope..., field, term, doc_freq, ttf)``; partial counts are formed where text is read.

    Without ``scope`` the statistics are global; with it they are local to each combination of
    the scope columns.
    """
    scope = list(scope or [])
    vectors = term_vectors(df, fields, key=scope, mapping=mapping)
    return vectors.groupBy(*scope, "field", "term").agg(
        F.count("*").alias("doc_freq"), F.sum("tf").alias("ttf")
    )


def doc_freq(df: DataFrame, field: str, mapping: FieldMapping = FieldMapping()) -> DataFrame:
    """``(term, doc_freq)``; distinct tokens per document are enough, no frequencies."""
    distinct = F.array_distinct(mapping.tokens(df, field))
    return (
        df.select(F.explode_outer(distinct).alias("term"))
        .where(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.count("*").alias("doc_freq"))
    )


def total_term_freq(df: DataFrame, field: str, mapping: FieldMapping = FieldMapping()) -> DataFrame:
    """``(term, ttf)``: every occurrence counts."""
    return (
        df.select(F.explode_outer(mapping.tokens(df, field)).alias("term"))
        .where(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.count("*").alias("ttf"))
    )
