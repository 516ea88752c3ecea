"""Significant terms: features that tell one part of a corpus from the whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import resolve
from ..functions.scoring import significance
from ..functions.text import FieldMapping
from ..plans.numbering import first_rows, row_index, top_per_group
from ..plans.sizing import kept_by, salted_join

MIN_DOC_COUNT = 3


def _with_terms(
    df: DataFrame, field: str, mapping: FieldMapping, side: DataFrame | None, key: list[str] | str
) -> DataFrame:
    """Distinct terms of each document; ``side`` is joined to them, not to the text."""
    keys = [key] if isinstance(key, str) else list(key)
    docs = df if side is None else kept_by(df, side, keys)
    docs = docs.withColumn("__terms", F.array_distinct(mapping.tokens(df, field)))
    return docs if side is None else docs.join(side, keys)


def _exploded(docs: DataFrame, *marks) -> DataFrame:
    # The outer form keeps Spark from repeating the whole analysis in a pushed-down size filter.
    terms = docs.select(*marks, F.explode_outer("__terms").alias("key"))
    return terms.where(F.col("key").isNotNull())


def significant_terms(
    df: DataFrame,
    foreground,
    field: str,
    size: int = 10,
    min_doc_count: int = MIN_DOC_COUNT,
    mapping: FieldMapping = FieldMapping(),
    side: DataFrame | None = None,
    key: list[str] | str = "doc_id",
) -> DataFrame:
    """``(key, doc_count, score, bg_count)`` of the terms more usual in the foreground.

    ``foreground`` is a condition on ``df``; the background is all of ``df``.  Both counts come
    from one pass over the text and one shuffle of partial sums.  ``side`` may hold further
    fields of the same documents, found by ``key``.
    """
    docs = _with_terms(df, field, mapping, side, key)
    inside = F.coalesce(resolve(foreground, docs, mapping), F.lit(False))
    one = inside.cast("bigint")
    counts = (
        _exploded(docs, one.alias("inside"))
        .groupBy("key")
        .agg(F.sum("inside").alias("doc_count"), F.count("*").alias("bg_count"))
        .where(F.col("doc_count") >= min_doc_count)
    )
    sizes = docs.agg(F.struct(F.sum(one).alias("fg"), F.count("*").alias("bg"))).scalar()
    scored = counts.withColumn(
        "score", significance(F.col("doc_count"), sizes["fg"], F.col("bg_count"), sizes["bg"])
    )
    best = first_rows(scored.where(F.col("score") > 0), [F.desc("score"), F.col("key")], size)
    return best.select("key", "doc_count", "score", "bg_count")


def significant_terms_by_class(
    df: DataFrame,
    class_field: str,
    field: str,
    size: int = 10,
    min_doc_count: int = MIN_DOC_COUNT,
    mapping: FieldMapping = FieldMapping(),
    side: DataFrame | None = None,
    key: list[str] | str = "doc_id",
) -> DataFrame:
    """The same for each value of ``class_field`` in one pass, with ``rank`` counting from 1.

    Documents without a class belong to the background only.
    """
    label = F.col(class_field).alias("class")
    docs = _with_terms(df, field, mapping, side, key)
    per_class = (
        _exploded(docs, label)
        .groupBy("key", "class")
        .agg(F.count("*").alias("doc_count"))
    )
    totals = per_class.groupBy("key").agg(F.sum("doc_count").alias("bg_count"))
    usual = F.col("class").isNotNull() & (F.col("doc_count") >= min_doc_count)
    counts = per_class.where(usual).join(totals, "key")
    groups = docs.groupBy(label).agg(F.count("*").alias("fg_size"))
    sizes = groups.where(F.col("class").isNotNull())
    # Documents without a class are one of the groups, so the whole is their sum.
    bg_size = groups.agg(F.sum("fg_size")).scalar()
    scored = (
        salted_join(counts, sizes, ["class"], F.col("key"))
        .withColumn(
            "score",
            significance(F.col("doc_count"), F.col("fg_size"), F.col("bg_count"), bg_size),
        )
        .where(F.col("score") > 0)
    )
    order = [F.desc("score"), F.col("key")]
    best = top_per_group(scored, ["class"], order, size, ["key"], "rank")
    return best.select("class", "rank", "key", "doc_count", "score", "bg_count")


def feature_union(ranked: DataFrame, size: int) -> DataFrame:
    """``(term, col)``: class lists one after the other, a repeated term keeps its first place.

    ``ranked`` comes from :func:`significant_terms_by_class` with the same ``size``.  The result
    is a column list of a specification, at most ``size`` terms per class.
    """
    place = F.min(F.struct("class", "rank")).alias("place")
    first = ranked.where(F.col("rank") <= size).groupBy(F.col("key").alias("term")).agg(place)
    placed = row_index(first.select("term", "place.*"), [F.col("class"), F.col("rank")], "col")
    return placed.select("term", F.col("col").cast("int").alias("col"))


def feature_list(features: DataFrame) -> list[str]:
    """The terms of :func:`feature_union` as the span of a specification entry."""
    return [r["term"] for r in features.orderBy("col").collect()]


def group_count(df: DataFrame, field: str) -> DataFrame:
    """``(class, doc_count)``: number of documents per value of a field."""
    return df.groupBy(F.col(field).alias("class")).agg(F.count("*").alias("doc_count"))

