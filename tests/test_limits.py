"""The same answer on both sides of every size limit, and of one table or two."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from termloom import Collection, FeatureSpec
from termloom.operators import learning, significance
from termloom.plans.numbering import top_per_group
from termloom.streaming import live

ROWS = [
    (1, "a b a", "x"), (2, "b", "x"), (3, "a c", "y"), (4, "a", None),
    (None, "a b", "x"), (None, "c", "y"), (5, "b b", "x"), (5, "b b", "x"), (5, "c a", "x"), (6, None, "y"), (7, "", "y"),
]
SPEC = FeatureSpec.from_spec([{"field": "text", "span": ["a", "b", "c", "zz"]}])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, text string, part string")


def cells(frame):
    return sorted((str(r["doc_id"]), str(r["cells"])) for r in frame.docs.collect())


@pytest.mark.parametrize("option", ["binary", "term_freq", "doc_freq", "ttf"])
@pytest.mark.parametrize("scope", [None, ["part"]])
@pytest.mark.parametrize("foreign", [None, "corpus", "statistics"])
def test_both_plans_give_the_same_cells(spark, docs, option, scope, foreign):
    if scope and foreign == "statistics":
        return
    given = {
        None: {},
        "corpus": {"corpus": docs.where("doc_id = 2")},
        "statistics": {
            "statistics": spark.createDataFrame(
                [("text", "b", 5, 7), ("text", "c", 0, 0), ("text", "zz", None, None)],
                "field string, term string, doc_freq bigint, ttf bigint",
            )
        },
    }[foreign]
    spec = SPEC.set_value("text", option)
    small = Collection(docs).vectorize_all(spec, scope=scope, **given)
    large = Collection(docs).vectorize_all(spec, scope=scope, largest_broadcast=0, **given)
    assert cells(small) == cells(large)
    assert len(cells(small)) == len(ROWS)
    for _, found in cells(small):
        assert "value=0.0" not in found and "None" not in found
    small.to_dict().collect(), large.to_dict().collect()  # no key twice in a map


@pytest.fixture
def tiny_limit(spark):
    spark.conf.set("termloom.broadcast.limit", "0")
    yield
    spark.conf.unset("termloom.broadcast.limit")


def test_vectors_and_weights_at_no_limit(spark, docs, request):
    unique = docs.where("doc_id <> 5").where("doc_id IS NOT NULL")
    spec = SPEC.set_value("text", "doc_freq")
    vectors = lambda: sorted(
        str(r) for r in learning.with_ml_vector(unique, spec).select("doc_id", vector_to_array("features")).collect()
    )
    weights = lambda: sorted((r[0], r[1], round(r[2], 9)) for r in Collection(unique).tf_idf(SPEC).collect())
    before = vectors(), weights()
    request.getfixturevalue("tiny_limit")
    assert (vectors(), weights()) == before


def test_a_large_dictionary_is_no_reason_to_refuse_a_stream(spark, docs, tiny_limit, tmp_path):
    docs.where("doc_id < 5").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in"))
    started = live.vectorize_stream(stream, SPEC).writeStream.format("memory").queryName("wide").trigger(availableNow=True)
    started.start().awaitTermination()
    batch = Collection(docs.where("doc_id < 5")).vectorize_all(SPEC).docs.select("doc_id", "cells")
    assert spark.table("wide").exceptAll(batch).count() == 0 and spark.table("wide").count() == 4


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("option", ["binary", "term_freq", "doc_freq", "ttf"])
@pytest.mark.parametrize("scope", [None, ["part"], ["kind"]])
def test_two_tables_are_one_collection(spark, docs, limit, option, scope):
    known = docs.where("doc_id IN (1, 2, 3, 4)")
    side = spark.createDataFrame([(1, "p"), (3, "q"), (4, "p"), (9, "p")], "doc_id bigint, kind string")
    spec = SPEC.set_value("text", option).extend([{"field": "kind", "span": ["p", "q"], "value": option}])
    options = {"scope": scope} | ({} if limit is None else {"largest_broadcast": limit})
    two = Collection(known, side=side).vectorize_all(spec, **options)
    one = Collection(known.join(side, "doc_id")).vectorize_all(spec, **options)
    assert cells(two) == cells(one)


def test_scores_of_two_tables(spark, docs):
    known = docs.where("doc_id IN (1, 2, 3, 4)")
    side = spark.createDataFrame([(1, "p"), (3, "q"), (4, "p"), (9, "p")], "doc_id bigint, kind string")
    two, one = Collection(known, side=side), Collection(known.join(side, "doc_id"))
    rows = lambda frame: sorted(map(str, frame.collect()))
    assert rows(two.tf_idf(SPEC)) == rows(one.tf_idf(SPEC))
    assert rows(two.top_by_relevance("text", ["a", "b"], 2)) == rows(one.top_by_relevance("text", ["a", "b"], 2))
    scored = two.scored("text", ["a"]).select("doc_id", "score")
    assert rows(scored) == rows(one.scored("text", ["a"]).select("doc_id", "score"))
    assert Collection(known).tf_idf(FeatureSpec()).count() == 0


def test_ranks_of_large_groups(spark, monkeypatch):
    rows = spark.range(300).selectExpr("id", "if(id % 7 = 0, null, id % 3) AS g", "(id * 37) % 101 AS v")
    order = [F.desc("v"), F.col("id")]
    ranked = lambda: sorted(map(str, top_per_group(rows, ["g"], order, 20, ["id"], "rank").collect()))
    few = ranked()
    monkeypatch.setattr("termloom.plans.numbering.GROUP_LIMIT_ROWS", 1)
    assert ranked() == few


def test_relevance_ranks_by_the_full_score(spark):
    texts = [(1, "a " + "b " * 3), (2, "a " + "b " * 3 + "c"), (3, "b")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    best = Collection(docs).top_by_relevance("text", ["a", "b", "c"], 3).collect()
    assert [r["doc_id"] for r in best] == [2, 1, 3]
    page = Collection(docs).search_vectorize(SPEC, sort=["_score:desc"], relevance=("text", ["c"]), size=2)
    assert sorted((r["row"], r["doc_id"]) for r in page.docs.collect()) == [(0, 2), (1, 1)]


def test_classes_sum_up_to_the_background(spark):
    docs = spark.createDataFrame(
        [(i, "x y" if i % 2 else "x z", "p" if i < 8 else None) for i in range(12)], "doc_id bigint, text string, c string"
    )
    found = significance.significant_terms_by_class(docs, "c", "text", 5, min_doc_count=1)
    assert {r["key"]: r["bg_count"] for r in found.collect()} == {}  # nothing is more usual in the class
    more = docs.withColumn("text", F.when(F.col("doc_id") < 4, "w").otherwise(F.col("text")))
    found = significance.significant_terms_by_class(more, "c", "text", 5, min_doc_count=1).first()
    assert (found["key"], found["doc_count"], found["bg_count"]) == ("w", 4, 4)
