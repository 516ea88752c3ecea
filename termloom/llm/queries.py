"""One query per operator, over its whole table, under the contract's column names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    decontaminate,
    language_id,
    license_scan,
    line_dedup,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    spelling_variants,
    suffix_dedup,
    token_counts,
    whitening,
)
from .storage import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
N_SHARDS = 40
RECORD_OVERHEAD = 16
BPE_RANKS = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


@query
def op2_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


@query
def op6_rendezvous_shards(spark, sf_dir):
    shards = [(s, 1.0) for s in range(N_SHARDS)]
    docs = table(spark, sf_dir, "documents")
    rows = sharding.assign(docs, shards, overhead=RECORD_OVERHEAD, new_shard=(N_SHARDS, 1.0))
    return rows.withColumn("law", F.lit("key"))


@query
def op10_simhash_components(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def remainder(by: int) -> Column:
    """What the CRC-32 of an id, as text, leaves; a null id is empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % by


@query
def op1_ppm_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs, remainder(3) != 1)
    found = language_id.predict(docs, model)
    return found.withColumn("held_out", remainder(3) == 1)


@query
def op5_adaptive_quality(spark, sf_dir):
    judged = quality_rules.filter_quality(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op9_repeated_strings(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op7_quality_classifier(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = quality_classifier.train(docs, labels, "quality", remainder(5) != 0)
    return quality_classifier.predict(docs, net).withColumn("held_out", remainder(5) == 0)


@query
def op3_benchmark_leaks(spark, sf_dir):
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op11_whitened_embeddings(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_spelling_variants(spark, sf_dir):
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


@query
def op13_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
