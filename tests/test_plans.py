"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from termloom import Collection, FeatureSpec, term, terms
from termloom.operators import significance, term_stats
from workload.queries import REGISTRY

SPEC = FeatureSpec.from_spec([{"field": "text", "span": ["the", "of"]}, {"field": "n_chars", "span": 1}])


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rows_are_built_without_any_exchange(docs):
    for option in ("binary", "term_freq", "doc_freq", "ttf"):
        text = plan(Collection(docs).vectorize_all(SPEC.set_value("text", option)).to_dict())
        assert "Exchange" not in text and "Join" not in text
        assert text.count("regexp_extract_all") == 1


def test_term_vectors_and_scans_do_not_move_text(docs):
    assert "Exchange" not in plan(term_stats.term_vectors(docs, ["text"]))
    assert "Exchange" not in plan(Collection(docs).scan(SPEC, 10))


def test_statistics_only_on_demand(docs, monkeypatch):
    calls = []
    monkeypatch.setattr(
        "termloom.plans.cells.known_statistics",
        lambda *args, **kwargs: calls.append(args) or [1, 1],
    )
    for option in ("binary", "term_freq"):
        Collection(docs).vectorize_all(SPEC.set_value("text", option))
    assert not calls
    Collection(docs).vectorize_all(SPEC.set_value("text", "ttf"))
    assert len(calls) == 1


def test_only_the_needed_columns_are_read(docs):
    text = plan(Collection(docs).vectorize_all(SPEC).to_dict())
    assert "ReadSchema: struct<doc_id:bigint,text:string,n_chars:bigint>" in text


def test_filters_reach_the_scan(docs):
    one = plan(Collection(docs).vectorize(SPEC, 7))
    assert "EqualTo(doc_id,7)" in one
    from termloom import FieldMapping

    keyed = Collection(docs, mapping=FieldMapping(keywords=frozenset({"lang"})))
    assert "EqualTo(lang,fr)" in plan(keyed.vectorize_all(SPEC, term("lang", "fr")).to_dict())


def test_pages_are_a_top_k_and_a_checked_broadcast(docs):
    text = plan(Collection(docs).search_vectorize(SPEC, sort=["n_chars:desc"], size=5).to_dict())
    assert "TakeOrderedAndProject" in text and "BroadcastHashJoin" in text


def test_no_window_without_partitions_and_no_cross_join(docs):
    frames = [
        Collection(docs).vectorize_all(SPEC).to_coo(),
        Collection(docs).scroll(SPEC, 10).docs,
        significance.significant_terms_by_class(docs, "lang", "text", 5),
        significance.significant_terms(docs, F.col("lang") == "fr", "text", 5),
        Collection(docs).hits(terminate_after=2, shard=["source"])[0],
    ]
    for frame in frames:
        text = plan(frame)
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
        for window in re.findall(r"Window \[.*", text):
            assert "windowspecdefinition(" in window
            assert not re.search(r"windowspecdefinition\([^,]* (ASC|DESC)", window)


def moves_text(frame) -> bool:
    """Whether some exchange has the text itself among its columns."""
    explain = frame.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString
    found = explain(frame._jdf.queryExecution(), "formatted")
    return any(re.search(r"\btext#", columns) for columns in re.findall(r"Exchange\s*\nInput \[\d+\]: \[(.*)\]", found))


def test_moving_text_would_be_noticed(docs):
    assert moves_text(docs.repartition(3, "doc_id"))
    assert not moves_text(docs.select("doc_id").repartition(3, "doc_id"))


@pytest.mark.parametrize(
    "name", [n for n in REGISTRY if n.startswith("vec_")] + ["scan_export", "term_vectors", "side_scope", "side_doc_freq"]
)
def test_registered_queries_do_not_move_text(spark, small, name):
    assert not moves_text(REGISTRY[name](spark, small))


@pytest.mark.parametrize(
    "name",
    ["terminate_all", "terminate_deep", "feature_union", "significant_by_class", "significant_by_language", "relevance_topk",
     "row_numbers", "scroll_batches", "vec_local_doc_freq", "side_tf_idf", "sample_of_several"],
)
def test_nothing_but_totals_and_bounded_pages_meets_in_one_task(spark, small, name):
    lines = plan(REGISTRY[name](spark, small)).splitlines()
    for line, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line:
            assert "partial_" in below or "LocalLimit" in below or "HashAggregate" in below, below


def test_one_analysis_for_query_and_cells(docs):
    found = Collection(docs).vectorize_all(SPEC, terms("text", ["the", "la"])).to_dict()
    assert plan(found).count("regexp_extract_all") == 1


def test_cells_are_not_sorted_for_triples(docs):
    matrix = Collection(docs).vectorize_all(SPEC)
    assert matrix.numbered() is matrix.numbered()
    text = plan(matrix.to_coo())
    assert "SortMergeJoin" not in text and ("ShuffledHashJoin" in text or "BroadcastHashJoin" in text)


def test_large_top_k_is_numbered_not_gathered(docs, monkeypatch):
    monkeypatch.setattr("termloom.plans.numbering.TOP_K_ROWS", 5)
    hits = Collection(docs).hits(terminate_after=50)[0]
    assert "SinglePartition" not in plan(hits) and hits.count() == 50


def test_partial_counts_before_the_shuffle(docs):
    text = plan(term_stats.doc_freq(docs, "text"))
    assert text.index("partial_count") > text.index("Exchange hashpartitioning(term")
