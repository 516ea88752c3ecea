"""Queries, pipeline and learned operators; every operator on an empty table."""

import public_tokenizers
import pytest
from conftest_llm import as_docs, odd_rows, rows_of

import __spark_entry__ as contract
import corpus_pipeline
from pyspark.sql import functions as F
from termloom.llm import (
    bpe,
    decontaminate,
    language_id,
    license_scan,
    line_dedup,
    oracle,
    quality_classifier,
    quality_rules,
    queries,
    sharding,
    simhash,
    suffix_dedup,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
COLUMNS = {
    1: ["doc_id", "held_out", "lang_pred", "score"],
    2: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    4: ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    5: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    6: ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    7: ["doc_id", "held_out", "score", "predicted"],
    9: ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    10: ["doc_id", "fingerprint", "component_id"],
    11: ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    12: ["word", "form", "root", "n", "n_near", "form_n"],
    13: ["doc_id", "n_bytes", "n_tokens", "over_limit"],
}


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.REGISTRY)
    assert numbers == list(range(1, 14))
    assert set(queries.REGISTRY) <= set(contract.queries()) and "pipeline" in contract.queries()
    assert set(oracle.ORACLE) <= set(queries.REGISTRY)


@pytest.mark.parametrize("name", sorted(queries.REGISTRY))
def test_columns(spark, small, name):
    frame = queries.REGISTRY[name](spark, small)
    assert set(COLUMNS.get(int(name[2:].split("_")[0]), [])) <= set(frame.columns)


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_and_sql(spark, small, name):
    from compare import duck, duck_rows, spark_rows

    assert spark_rows(queries.REGISTRY[name](spark, small)) == duck_rows(duck(small), oracle.ORACLE[name])


def test_held_out_accuracy(spark, small):
    found = queries.REGISTRY["op1_ppm_language"](spark, small)
    lang = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang")
    held = found.join(lang, "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'")
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97


def test_classifier_tells_held_out_documents_apart(spark):
    larger = "/root/testdata/sf0.01"
    found = queries.REGISTRY["op7_quality_classifier"](spark, larger).toPandas()
    assert found.score.between(0, 1).all() and ((found.score >= 0.3) == (found.predicted == 1)).all()
    labels = spark.read.parquet(f"{larger}/labels.parquet").toPandas()
    held = found.merge(labels, on="doc_id").query("held_out")
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert (good.values[:, None] > bad.values[None]).mean() > 0.9


def test_language_of_odd_rows(odd):
    model = language_id.train(odd, F.lit(True))
    found = {(r["doc_id"], r["lang_pred"]) for r in language_id.predict(odd, model).collect()}
    for doc_id in (3, 4, 5, 9):  # null, empty, blank, no letter
        assert (doc_id, "und") in found
    assert (6, "fr") in found and all(0 <= r["score"] <= 1 for r in language_id.predict(odd, model).collect())


def test_classifier_without_labels(spark, odd):
    labels = spark.createDataFrame([], "doc_id bigint, quality bigint")
    net = quality_classifier.train(odd, labels, "quality", F.lit(True))
    assert {r["score"] for r in quality_classifier.predict(odd, net).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, None), (None, 1), (7, 5), (11, 0)], "doc_id bigint, quality bigint")
    net = quality_classifier.train(odd, labels, "quality", F.lit(True))
    assert quality_classifier.predict(odd, net).count() == len(odd_rows())


def test_quality_of_odd_rows_and_groups(spark, odd):
    judged = {r["doc_id"]: r for r in quality_rules.filter_quality(odd).collect()}
    assert judged[3]["base_failed"] and judged[4]["base_failed"] and not judged[3]["kept"]
    plain = [(i, f"these are words number {i} of some usual length in a text about it", "en", "s") for i in range(80)]
    noisy = [(100 + i, "## $$ words && of ** all %% kinds || here ## and $$ more" + f" {i}", "en", "s") for i in range(6)]
    docs = spark.createDataFrame(plain + noisy, "doc_id bigint, text string, lang string, source string")
    kept = {r["doc_id"] for r in quality_rules.filter_quality(docs).where("kept").collect()}
    assert kept == set(range(80))


def test_sketches_merge(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    whole = quality_rules.sketch(quality_rules.measure(docs))
    halves = [quality_rules.sketch(quality_rules.measure(docs.where(F.col("doc_id") % 2 == k))) for k in (0, 1)]
    assert rows_of(quality_rules.merge(*halves)) == rows_of(whole)
    exact = quality_rules.measure(docs).where("NOT base_failed").select(
        F.percentile(quality_rules.ratio("word_length"), F.lit(0.75)).alias("p")
    )
    near = quality_rules.quantiles(whole.withColumn("all", F.lit(1)), ["all"], {"q3": 3}).where("rule = 'word_length'")
    assert near.first()["q3"] == pytest.approx(exact.first()["p"], rel=0.03)


def test_empty_tables(spark, none, odd):
    items = spark.createDataFrame([], "item_id bigint, text string")
    model = language_id.train(none, F.lit(True))
    net = quality_classifier.train(none, none.selectExpr("doc_id", "n_chars AS quality"), "quality", F.lit(True))
    for frame in (
        language_id.predict(none, model),
        bpe.round_trip(none, RANKS, public_tokenizers.PATTERN),
        decontaminate.matches(none, odd.selectExpr("doc_id AS item_id", "text")),
        decontaminate.matches(odd, items),
        line_dedup.dedup_lines(none),
        quality_rules.filter_quality(none),
        sharding.assign(none, [(0, 1.0)]),
        quality_classifier.predict(none, net),
        license_scan.scan(none),
        suffix_dedup.remove_repeats(none),
        simhash.near_duplicates(none),
    ):
        assert frame.collect() == []
    assert {r["lang_pred"] for r in language_id.predict(odd, model).collect()} == {"und"}


def test_stages_keep_columns_and_stand_odd_rows(spark, small, odd, none):
    for docs in (odd, none):
        kept = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, kept, small)
            assert out.columns == docs.columns
            kept = spark.createDataFrame(out.collect(), out.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, kept, small).count() == kept.count()


def test_pipeline_keeps_clean_documents(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, small).collect()}
    leaking = {d for d, t in docs.items() if any(i in t for i in items)}
    near = simhash.near_duplicates(as_docs(spark, list(docs.items()))).where("doc_id > component_id")
    copies = {r["doc_id"] for r in near.collect()}
    assert len(set(docs) - kept - leaking - copies) <= 0.02 * len(docs)
    assert not (kept & leaking)
