"""From documents to token digests: five stages, each written as Parquet and read again.

Every stage takes what its predecessor kept and returns the columns of ``documents``, the last one
a row of digests per document.  Rules for odd rows are those of the operators; a null text is
rejected by the first stage, and rows sharing an id stay or go together from the third stage on.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import bpe, decontaminate, language_id, line_dedup, queries, simhash
from termloom.llm.storage import free_prefix, table
from termloom.plans.sizing import scratch_dir

# A text for which the best language needs as much room as its plain bytes is in none of them.
PLAIN_BITS = 8.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn languages from the labelled documents; reject texts without a letter or in no language.

    ``lang`` of what stays is the predicted language.
    """
    model = language_id.train(docs, F.lit(True))
    own = free_prefix(docs)
    named = language_id.annotate(docs, model, prefix=own)
    kept = named.where((F.col(f"{own}lang") != language_id.UNDETERMINED) & (F.col(f"{own}bits") < PLAIN_BITS))
    return kept.withColumn("lang", F.col(f"{own}lang")).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; ``n_chars`` follows."""
    own = free_prefix(docs)
    rows = line_dedup.without_repeats(docs, line_dedup.LineIndex.build(docs), prefix=own)
    rows = rows.withColumn("text", F.col(f"{own}kept"))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast("bigint"))
    return rows.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return simhash.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark``, also in edited form, go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each remaining text as token ids, decoded again; one row of digests per document."""
    return bpe.round_trip(docs, public_tokenizers.path(queries.BPE_RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("language", identify_language),
    ("lines", drop_repeated_lines),
    ("near_copies", drop_near_copies),
    ("leaks", drop_benchmark_leaks),
    ("encode", encode_documents),
]

# Language models, fingerprints, edit distances and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them goes to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{scratch_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
