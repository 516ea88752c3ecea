"""Quality rules whose cutoffs come from the corpus, per language and source.

Each rule watches a ratio of two counts.  A group's distribution of a ratio is kept as a sketch:
counts of buckets of equal relative width.  Sketches are merged by adding counts, so they are
built where the texts are read, combined over partitions, batches or whole languages, and give
quantiles to within a bucket.  A document fails a rule if its ratio lies far outside the middle
half of its group.  A group's sketch is read together with that of its language, which counts as a fixed
number of further documents: it decides for small groups and fades as a group grows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.plans.sizing import salted_join

from . import buffers, text_counts
from .storage import settle

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
# Buckets of a sketch: each is wider than the one before by this factor, from 0.001 on.
GROWTH = 1.02
RESOLUTION = 0.001
# A fence lies so many spreads away from the quartiles; a spread is their distance, or the given
# least one, below which differences do not matter.
FENCE = 3.0
# So many documents does the sketch of the language stand for in each of its groups.
LANGUAGE_WEIGHT = 50
# Ratio: numerator, denominator, least spread, whether low values fail as well.
RULES = {
    "symbols": ("n_symbols", "n_words", 0.05, False),
    "word_length": ("word_chars", "n_words", 0.5, True),
    "dup_lines": ("n_dup_lines", "n_lines", 0.15, False),
}
GROUP = ["lang", "source"]
_COUNTS = pa.schema(
    [("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string())]
    + [(name, pa.int64()) for name in text_counts.NAMES]
)


def measure(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """The counts of every whole text with its group, row by row, and whether it fails outright."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.pieces(batches, "text"):
            counts = text_counts.count(batch.column("text"))
            kept = [batch.column(name) for name in ("doc_id", *GROUP)]
            yield buffers.arrow(_COUNTS, *kept, *(counts[name] for name in text_counts.NAMES))

    narrow = docs.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.col(lang).cast("string").alias("lang"),
        F.col(source).cast("string").alias("source"),
        F.col(text).cast("string").alias("text"),
    )
    schema = "doc_id bigint, lang string, source string, " + ", ".join(f"{n} bigint" for n in text_counts.NAMES)
    repeated = F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEATED_PERCENT) * F.col("n_words")
    return narrow.mapInArrow(rows, schema).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | repeated)


def ratio(rule: str) -> Column:
    above, below, _, _ = RULES[rule]
    return F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(F.lit(0.0))


def sketch(measured: DataFrame) -> DataFrame:
    """``lang, source, rule, bucket, n`` over the documents that do not fail outright."""
    bucket = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.ceil(F.log(ratio(rule) / RESOLUTION + 1) / math.log(GROWTH)).cast("int").alias("bucket"),
        )
        for rule in RULES
    ]
    rows = measured.where(~F.col("base_failed")).select(*GROUP, F.explode(F.array(*bucket)).alias("b"))
    return rows.groupBy(*GROUP, "b.rule", "b.bucket").agg(F.count("*").alias("n"))


def merge(*sketches: DataFrame) -> DataFrame:
    """One sketch of all that the given ones describe."""
    whole = sketches[0]
    for other in sketches[1:]:
        whole = whole.unionByName(other)
    return whole.groupBy(*GROUP, "rule", "bucket").agg(F.sum("n").alias("n"))


def blended(sketched: DataFrame) -> DataFrame:
    """The sketch of each group with that of its language, as exact multiples of documents.

    A bucket weighs ``n * size_of_language + LANGUAGE_WEIGHT * n_of_language``, so that the language adds up to
    ``LANGUAGE_WEIGHT`` documents in the same unit.
    """
    exact = "decimal(19,0)"
    of_language = sketched.groupBy("lang", "rule", "bucket").agg(F.sum("n").alias("wide"))
    every = of_language.groupBy("lang", "rule").agg(F.sum("wide").cast(exact).alias("unit"))
    groups = sketched.select(*GROUP).distinct().select(F.col("lang").alias("__lang"), "source")
    shared = of_language.join(groups, F.col("lang").eqNullSafe(F.col("__lang")))
    added = shared.select(*GROUP, "rule", "bucket", F.lit(0).cast("bigint").alias("n"), "wide")
    both = sketched.withColumn("wide", F.lit(0).cast("bigint")).unionByName(added)
    summed = both.groupBy(*GROUP, "rule", "bucket").agg(F.sum("n").cast(exact).alias("n"), F.sum("wide").cast(exact).alias("wide"))
    units = every.select(F.col("lang").alias("__lang"), F.col("rule").alias("__rule"), "unit")
    same = F.col("lang").eqNullSafe(F.col("__lang")) & (F.col("rule") == F.col("__rule"))
    weight = F.col("n") * F.col("unit") + F.lit(LANGUAGE_WEIGHT).cast(exact) * F.col("wide")
    return summed.join(units, same).select(*GROUP, "rule", "bucket", weight.alias("n"))


def quantiles(sketched: DataFrame, group: list[str], quarters: dict[str, int]) -> DataFrame:
    """Per group and rule the named quartiles: the first bucket that so many quarters of the sketch reach."""
    by = [*group, "rule"]
    running = Window.partitionBy(*by).orderBy("bucket")
    ranked = sketched.select(
        *by, "bucket", F.sum("n").over(running).alias("upto"), F.sum("n").over(Window.partitionBy(*by)).alias("size")
    )
    value = (F.pow(F.lit(GROWTH), F.col("bucket")) - 1) * RESOLUTION
    picked = [F.min(F.when(4 * F.col("upto") >= q * F.col("size"), value)).alias(name) for name, q in quarters.items()]
    return ranked.groupBy(*by).agg(*picked)


def fences(sketched: DataFrame) -> DataFrame:
    """``lang, source, <rule>_low, <rule>_high``: the range in which a group's ratios pass."""
    joined = quantiles(blended(sketched), GROUP, {"q1": 1, "q3": 3})
    picked = []
    for rule, (_, _, least, low_fails) in RULES.items():
        here = F.col("rule") == rule
        spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(least)) * FENCE
        low = F.col("q1") - spread if low_fails else F.lit(-1.0)
        picked.append(F.max(F.when(here, low)).alias(f"{rule}_low"))
        picked.append(F.max(F.when(here, F.col("q3") + spread)).alias(f"{rule}_high"))
    return joined.groupBy(*GROUP).agg(*picked)


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``kept``: neither failed outright nor outside a fence of its group."""
    joined = salted_join(measured, limits, GROUP, F.col("doc_id"), "left")
    passes = ~F.col("base_failed")
    for rule in RULES:
        inside = ratio(rule).between(F.col(f"{rule}_low"), F.col(f"{rule}_high"))
        passes = passes & F.coalesce(inside, F.lit(True))
    return joined.withColumn("kept", passes).select(*measured.columns, "kept")


def filter_quality(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every row, by fences drawn over all rows.

    A null language or source is a group like any other.  A null or empty text has no words and
    fails outright; repeated rows are judged alike; null ids stay null; an empty table gives no
    rows.  The texts are read once: what is kept for the second pass are the counts.
    """
    measured = settle(measure(docs, key, text, lang, source))
    return judge(measured, fences(sketch(measured)))
