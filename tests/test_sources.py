"""Corpora with broken lines, bulk files, dates that are none, stored specifications and models."""

import pytest
from pyspark.sql import functions as F

from termloom import Collection, FeatureSpec, all_of, any_of, exists, ids, load_corpus, none_of, parse_date, range_, term
from termloom.operators import learning

DECLARED = {"id": {"type": "long"}, "text": {"type": "string"}, "day": {"type": "date", "format": "yyyy-MM-dd HH:mm:ss"}}
JSON = [
    '{"id": 1, "text": "one", "day": "2020-01-02 03:04:05"}',
    '{"id": 2, "text": "two", "day": "no date"}',
    '{"id": "three", "text": "wrong type"}',
    "{broken",
    "",
    '{"id": 4}',
]
BULK = [
    '{"index": {"_id": "a", "_index": "i"}}',
    '{"id": 1, "text": "one"}',
    '{"delete": {"_id": "z"}}',
    '{"create": {"_id": "b"}}',
    '{"id": 2, "text": "two"}',
    '{"update": {"_id": "c"}}',
    '{"doc": {"text": "part"}}',
    '{"index": {}}',
    '{"index": {"_id": "a document that looks like an action"}}',
    '{"index": {"_id": "d"}}',
    "{broken",
    '{"index": {"_id": "e"}}',
    '{"id": 5}',
]


@pytest.fixture
def written(spark, tmp_path):
    def write(lines):
        (tmp_path / "lines").write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(tmp_path / "lines")

    return write


def test_broken_lines(spark, written):
    path = written(JSON)
    rows = load_corpus(spark, path, DECLARED).collect()
    assert sorted((r["id"], r["text"]) for r in rows if r["text"]) == [(1, "one"), (2, "two")]
    assert {r["id"]: r["day"] is None for r in rows} == {1: False, 2: True, 4: True}
    kept = load_corpus(spark, path, DECLARED, broken="keep")
    broken = [r["_corrupt_record"] for r in kept.where("_corrupt_record IS NOT NULL").collect()]
    assert sorted(broken) == sorted([JSON[2], JSON[3]])
    with pytest.raises(Exception):
        load_corpus(spark, path, DECLARED, broken="fail").collect()
    with pytest.raises(ValueError):
        load_corpus(spark, path, DECLARED, broken="?")


@pytest.mark.parametrize("split", [None, "40b", "64b", "97b"])
def test_bulk_files(spark, written, split):
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        docs = load_corpus(spark, written(BULK), DECLARED, "bulk")
        rows = sorted((str(r["_id"]), r["id"]) for r in docs.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    # a document without any declared field is a row of nulls
    assert rows == [("None", None), ("a", 1), ("b", 2), ("e", 5)]


def test_dates(spark):
    given = spark.createDataFrame([("Mon Mar 02 10:00:00 UTC 2020",), ("nonsense",), (None,)], "d string")
    pattern = "EEE MMM dd HH:mm:ss zzz yyyy"
    assert [r[0] is None for r in given.select(parse_date(F.col("d"), pattern)).collect()] == [False, True, True]
    with pytest.raises(Exception):
        given.select(parse_date(F.col("d"), pattern, strict=True)).collect()


def test_conditions(spark):
    rows = [(1, 5, ["a"], "x"), (2, None, [None], None), (3, 9, None, "y")]
    docs = Collection(spark.createDataFrame(rows, "doc_id bigint, n bigint, many array<string>, part string"))
    found = lambda c: sorted(r["doc_id"] for r in docs.hits(c)[0].collect())
    assert found(range_("n", gte=5, lt=9)) == [1] and found(range_("n", gt=5)) == [3] and found(range_("n")) == [1, 3]
    assert found(exists("n")) == [1, 3] and found(exists("many")) == [1] and found(ids([3, 1])) == [1, 3]
    assert found(none_of(range_("n", lt=6))) == [2, 3]  # a missing value is not below 6
    assert found(all_of()) == [1, 2, 3] and found(any_of()) == [] and found(none_of()) == [1, 2, 3]
    assert found(all_of(None, term("part", "x"))) == [1] and found(any_of(ids([2]), F.col("n") == 9)) == [2, 3]


def test_composite_keys(spark):
    rows = [("p", 1, "a b"), ("q", 1, "a"), ("q", 2, "b b")]
    docs = Collection(spark.createDataFrame(rows, "src string, n bigint, text string"), ("src", "n"))
    spec = FeatureSpec.from_spec([{"field": "text", "span": ["a", "b"]}])
    row = docs.vectorize(spec, ("q", 2)).first()
    assert (row["src"], row["n"], row["found"], row["matrix"]) == ("q", 2, True, {1: 2.0})
    with pytest.raises(ValueError):
        docs.vectorize(spec, 1)
    split = learning.hash_split(docs.df, ["src", "n"])
    assert split.count() == 3 and split.where("is_test IS NULL").count() == 0


def test_names_in_the_vector(spark):
    docs = spark.createDataFrame([(1, "a b", 3)], "doc_id bigint, text string, n bigint")
    spec = FeatureSpec.from_spec([{"field": "text", "span": ["a", True]}, {"field": "n", "span": 1}])
    vectors = learning.with_ml_vector(docs, spec)
    attributes = vectors.schema["features"].metadata["ml_attr"]["attrs"]["numeric"]
    assert [a["name"] for a in attributes] == ["text=a", "text=true", "n[0]"] == spec.feature_names()


def test_a_model_is_stored_with_its_specification(spark, tmp_path):
    docs = spark.createDataFrame([(i, "a" if i % 2 else "b", i % 2) for i in range(40)], "doc_id bigint, text string, y int")
    spec = FeatureSpec.from_spec([{"field": "text", "span": ["a", "b"]}, {"field": "y", "span": 1}])
    frame = learning.training_frame(docs, spec)
    path = f"file://{tmp_path}/model"
    learning.save_model(learning.train_linear_svc(frame), spec, path)
    model, stored = learning.load_model(path)
    assert stored == spec and learning.accuracy(learning.predict(model, frame)).first()["accuracy"] == 1.0
