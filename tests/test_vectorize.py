"""Golden values and brute force for the vectorizer and the matrix forms."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from termloom import Analyzer, Collection, FeatureSpec, FieldMapping
from termloom.operators import batches, matrix
from termloom.operators.learning import with_ml_vector
from termloom.plans.cells import with_cells

# The terms of the published example, in its order.
POSITIVE = ["you", "thanks", "love", "good", "your", "great", "thank", "happy", "awesome", "haha"]
TWEETS = FeatureSpec.from_spec(
    [{"field": "text", "span": POSITIVE, "value": "binary"}, {"field": "polarity", "span": 1}]
)


@pytest.fixture(scope="module")
def tweet(spark):
    text = "i love a great conversation...thank you. your a babe. "
    return spark.createDataFrame(
        [("2012313853", text, 1)], "doc_id string, text string, polarity short"
    )


@pytest.fixture(scope="module")
def smoke(spark):
    rows = [("1", "bar", "y"), ("2", "baz", "y"), ("3", "foo", "n")]
    return spark.createDataFrame(rows, "doc_id string, foo string, label string")


def dicts(found, key="doc_id"):
    return {r[key]: r["matrix"] for r in found.to_dict().collect()}


def triples(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_one_document(tweet):
    answer = Collection(tweet).vectorize(TWEETS, "2012313853").collect()
    assert len(answer) == 1
    (row,) = answer
    assert row["found"] and (row["n_rows"], row["n_cols"]) == (1, 11)
    assert row["matrix"] == {0: 1, 2: 1, 4: 1, 5: 1, 6: 1, 10: 1}


def test_absent_document(tweet):
    (row,) = Collection(tweet).vectorize(TWEETS, "0").collect()
    assert not row["found"] and row["matrix"] is None and row["doc_id"] == "0"


def test_one_document_as_coo(tweet):
    (row,) = Collection(tweet).vectorize(TWEETS, "2012313853", "COO").collect()
    assert row["matrix"].asDict() == {"row": [0] * 6, "col": [0, 2, 4, 5, 6, 10], "data": [1] * 6}
    with pytest.raises(ValueError):
        Collection(tweet).vectorize(TWEETS, "2012313853", "csr")
    found = Collection(tweet).vectorize_all(TWEETS)
    assert triples(found.to_coo()) == [(0, c, 1.0) for c in (0, 2, 4, 5, 6, 10)]


@pytest.mark.parametrize("option", ["doc_freq", "ttf"])
@pytest.mark.parametrize("limit", [None, 0])
def test_smoke_corpus(smoke, option, limit):
    spec = FeatureSpec.from_spec(
        [
            {"field": "foo", "span": ["bar", "baz", "foo"], "value": "binary"},
            {"field": "label", "span": ["y", "n"], "value": option},
        ]
    )
    found = Collection(smoke).vectorize_all(spec, largest_broadcast=limit)
    assert [tuple(r) for r in found.shape().collect()] == [(3, 5)]
    assert dicts(found) == {"1": {0: 1, 3: 2}, "2": {1: 1, 3: 2}, "3": {2: 1, 4: 1}}


def test_coo_and_dict_round_trip(spark):
    rows = [
        (0, [0, 2, 3, 4, 5, 7, 9, 10]),
        (1, [0, 2, 4, 6, 8, 9, 10]),
        (2, [0, 2, 4, 5, 7, 8, 10]),
    ]
    docs = spark.createDataFrame(
        [(row, [(c, 1.0) for c in cols]) for row, cols in rows],
        "row bigint, cells array<struct<col:int,value:double>>",
    )
    found = matrix.Matrix(docs, docs.select("row"), TWEETS, ("row",), (F.col("row"),))
    assert len(triples(found.to_coo())) == 22
    back = matrix.cells_of(found.to_dict())
    assert triples(matrix.coo(back, ["row"])) == triples(found.to_coo())
    packed = {r["row"]: r["indices"] for r in matrix.rows_of(found.to_coo()).collect()}
    assert packed == dict(rows)


def test_mixed_numeric_fields(spark):
    docs = spark.createDataFrame(
        [
            (1, "a b a", 0.55, 1.0, [7, None, 8, 9, 10, 11, 12], 1),
            (2, "", None, 0.0, [0, 5], 0),
            (3, None, float("-2"), 3.0, None, None),
        ],
        "doc_id bigint, text string, n1 double, n2 double, n3 array<int>, label int",
    )
    spec = FeatureSpec.from_spec(
        [
            {"field": "text", "span": ["a", "b"]},
            {"field": "n1", "span": 1},
            {"field": "n2", "span": 1},
            {"field": "n3", "span": 5},
            {"field": "label", "span": 1},
        ]
    )
    found = Collection(docs).vectorize_all(spec)
    expected = {
        1: {0: 2, 1: 1, 2: 0.55, 3: 1, 4: 7, 5: 8, 6: 9, 7: 10, 8: 11, 9: 1},
        2: {5: 5},
        3: {2: -2, 3: 3},
    }
    assert dicts(found) == expected
    assert found.shape().first()["n_rows"] == 3
    compat = dicts(Collection(docs).vectorize_all(spec, numeric_mode="int_compat"))
    assert compat[1][2] == -1 and compat[2] == {3: -1, 5: 5} and compat[3] == {2: -1, 3: -1}


def test_int_compat_wraps_longs(spark):
    docs = spark.createDataFrame(
        [(1, 4294967301, True), (2, 2147483648, False), (3, -1, None), (4, -2147483649, True),
         (5, 9223372036854775807, True), (6, -9223372036854775808, True)],
        "doc_id int, n bigint, flag boolean",
    )
    spec = FeatureSpec.from_spec([{"field": "n", "span": 1}, {"field": "flag", "span": 1}])
    found = dicts(Collection(docs).vectorize_all(spec, numeric_mode="int_compat"))
    assert found == {
        1: {0: 5, 1: 1}, 2: {0: -2147483648}, 3: {0: -1}, 4: {0: 2147483647, 1: 1},
        5: {0: -1, 1: 1}, 6: {1: 1},
    }


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_dates_do_not_depend_on_the_zone_of_the_session(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        docs = spark.sql(
            "SELECT 1 AS doc_id, DATE'1970-01-03' AS d, TIMESTAMP_NTZ'1970-01-02 01:02:03.456789' AS n, "
            "TIMESTAMP'1970-01-01 00:00:01.5Z' AS t UNION ALL "
            "SELECT 2, DATE'1969-12-31', TIMESTAMP_NTZ'1969-12-31 23:59:59.5', NULL"
        )
        spec = FeatureSpec.from_spec([{"field": f, "span": 1} for f in "dnt"])
        assert dicts(Collection(docs).vectorize_all(spec)) == {
            1: {0: 172800000, 1: 90123456, 2: 1500},
            2: {0: -86400000, 1: -500},
        }
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_slots_of_a_field_listed_twice(spark):
    docs = spark.createDataFrame([(1, [5, 6, 7], "a")], "doc_id int, n array<int>, t string")
    spec = FeatureSpec.from_spec(
        [{"field": "n", "span": 2}, {"field": "t", "span": ["a"]}, {"field": "n", "span": 3}]
    )
    assert dicts(Collection(docs).vectorize_all(spec)) == {1: {0: 5, 1: 6, 2: 1, 3: 7}}
    vector = with_ml_vector(docs, spec).first()["features"]
    assert vector.toArray().tolist() == [5, 6, 1, 7]


def test_an_integer_span_needs_numbers(smoke):
    spec = FeatureSpec.from_spec([{"field": "foo", "span": 1}])
    with pytest.raises(ValueError, match="integer span"):
        Collection(smoke).vectorize_all(spec)


def test_a_term_span_needs_strings(tweet):
    spec = FeatureSpec.from_spec([{"field": "polarity", "span": ["1"]}])
    with pytest.raises(ValueError, match="no terms"):
        Collection(tweet).vectorize_all(spec)


def test_missing_fields(smoke):
    spec = FeatureSpec.from_spec(
        [{"field": "nowhere", "span": ["a"]}, {"field": "foo", "span": ["bar"]}]
    )
    assert dicts(Collection(smoke).vectorize_all(spec)) == {"1": {1: 1}, "2": {}, "3": {}}
    with pytest.raises(ValueError, match="nowhere"):
        Collection(smoke).vectorize_all(spec, on_missing="error")


def test_empty_specification_and_no_hits(smoke):
    empty = Collection(smoke).vectorize_all(FeatureSpec())
    assert dicts(empty) == {"1": {}, "2": {}, "3": {}}
    spec = FeatureSpec.from_spec([{"field": "foo", "span": ["bar"]}])
    nothing = Collection(smoke).vectorize_all(spec, F.lit(False))
    assert tuple(nothing.shape().first()) == (0, 1)
    assert triples(nothing.to_coo()) == []


def test_multi_valued_fields(spark):
    docs = spark.createDataFrame(
        [(1, ["A b", "b c"], ["x y", "x y", None]), (2, None, None)],
        "doc_id int, text array<string>, tag array<string>",
    )
    spec = FeatureSpec.from_spec(
        [{"field": "text", "span": ["b", "a"]}, {"field": "tag", "span": ["x y", "x"]}]
    )
    mapping = FieldMapping(keywords=frozenset({"tag"}))
    found = Collection(docs, mapping=mapping).vectorize_all(spec)
    assert dicts(found) == {1: {0: 2, 1: 1, 2: 2}, 2: {}}


def test_stop_words_before_lower_case(spark):
    docs = spark.createDataFrame([(1, "The cat and the Hat")], "doc_id int, text string")
    spec = FeatureSpec.from_spec([{"field": "text", "span": ["the", "cat", "hat", "and"]}])
    early = Analyzer(stop_words=("the", "and"), stop_before_lower=True)
    late = Analyzer(stop_words=("the", "and"))
    for analyzer, expected in ((early, {0: 1, 1: 1, 2: 1}), (late, {1: 1, 2: 1})):
        docs_of = Collection(docs, mapping=FieldMapping(default=analyzer))
        assert dicts(docs_of.vectorize_all(spec)) == {1: expected}


# -- brute force on random documents ----------------------------------------------------------------
WORDS = [f"w{i}" for i in range(30)]


@pytest.fixture(scope="module")
def random_docs(spark):
    rng = random.Random(5)
    rows = []
    for doc_id in range(120):
        length = rng.choice([0, 1, 5, 40, 400])
        # One word makes up a third of everything.
        words = [rng.choice(WORDS) if rng.random() > 0.33 else "w0" for _ in range(length)]
        rows.append((doc_id, " ".join(words), rng.choice(["x", "y", None]), rng.randrange(3)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, part string, n int")
    return rows, frame.repartition(7).cache()


SPAN = ["w3", "w0", "w29", "absent", "w7"]


def expected_cells(rows, option, scope=False):
    counts = {r[0]: Counter(r[1].split()) for r in rows}
    cells = []
    for doc_id, _, part, _ in rows:
        near = [counts[r[0]] for r in rows if not scope or r[2] == part]
        for col, word in enumerate(SPAN):
            tf = counts[doc_id][word]
            if tf:
                cells.append(
                    (doc_id, col, float({
                        "binary": 1,
                        "term_freq": tf,
                        "doc_freq": sum(word in c for c in near),
                        "ttf": sum(c[word] for c in near),
                    }[option]))
                )
    return sorted(cells)


@pytest.mark.parametrize("option", ["binary", "term_freq", "doc_freq", "ttf"])
@pytest.mark.parametrize("scope", [None, ["part"]])
@pytest.mark.parametrize("limit", [None, 0])
def test_against_brute_force(random_docs, option, scope, limit):
    rows, docs = random_docs
    spec = FeatureSpec.from_spec([{"field": "text", "span": SPAN, "value": option}])
    cells = with_cells(docs, spec, key=["doc_id"], scope=scope, largest_broadcast=limit)
    assert cells.columns == [*docs.columns, "cells"] and cells.count() == len(rows)
    got = sorted(tuple(r) for r in matrix.coo(cells, ["doc_id"]).collect())
    assert got == expected_cells(rows, option, bool(scope))


@pytest.mark.parametrize("option", ["binary", "term_freq", "doc_freq", "ttf"])
def test_ml_vector_holds_the_same_values(random_docs, option):
    rows, docs = random_docs
    entries = [{"field": "n", "span": 1}, {"field": "text", "span": SPAN, "value": option}]
    vectors = with_ml_vector(docs, FeatureSpec.from_spec(entries)).collect()
    got = sorted(
        (r["doc_id"], col - 1, v)
        for r in vectors
        for col, v in enumerate(r["features"].toArray().tolist())
        if col and v
    )
    assert got == expected_cells(rows, option)
    assert all(r["features"].toArray()[0] == r["n"] for r in vectors)


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_concatenated_batches_are_the_whole_matrix(random_docs, size):
    _, docs = random_docs
    spec = FeatureSpec.from_spec([{"field": "text", "span": SPAN}])
    docs_of = Collection(docs)
    whole = triples(docs_of.vectorize_all(spec).to_coo())
    scrolled = docs_of.scroll(spec, size).docs
    shapes = batches.batch_shapes(scrolled, spec.n_cols)
    merged = batches.concat_batches(batches.batch_coo(scrolled), shapes)
    assert triples(merged) == whole
    assert tuple(batches.concat_shape(shapes).first()) == (120, spec.n_cols)
    sizes = [r["n_rows"] for r in shapes.orderBy("batch_id").collect()]
    assert sizes[:-1] == [size] * (len(sizes) - 1) and 0 < sizes[-1] <= size


def test_cutoff(random_docs):
    _, docs = random_docs
    spec = FeatureSpec.from_spec([{"field": "text", "span": SPAN}])
    assert Collection(docs).scroll(spec, 50, cutoff=1).docs.count() == 50
    assert Collection(docs).scroll(spec, 50, cutoff=-1).docs.count() == 120


def test_concatenation_fixture(spark):
    cells = [(0, 0, 0, 1.0), (0, 1, 2, 1.0), (1, 0, 1, 5.0)]
    coo = spark.createDataFrame(cells, "batch_id bigint, row bigint, col int, data double")
    shapes = spark.createDataFrame([(0, 2, 3), (1, 2, 3)], "batch_id bigint, n_rows bigint, n_cols int")
    assert triples(batches.concat_batches(coo, shapes)) == [(0, 0, 1.0), (1, 2, 1.0), (2, 1, 5.0)]
    assert tuple(batches.concat_shape(shapes).first()) == (4, 3)


def test_concatenation_beyond_the_broadcast_limit(spark):
    coo = spark.createDataFrame(
        [(b, r, 0, 1.0) for b in range(5) for r in range(3)],
        "batch_id bigint, row bigint, col int, data double",
    )
    shapes = spark.createDataFrame([(b, 3, 1) for b in range(5)], "batch_id bigint, n_rows bigint, n_cols int")
    spark.conf.set("termloom.broadcast.limit", "0")
    try:
        assert triples(batches.concat_batches(coo, shapes)) == [(r, 0, 1.0) for r in range(15)]
    finally:
        spark.conf.unset("termloom.broadcast.limit")


def test_scan_cuts_every_document_into_exactly_one_small_batch(random_docs):
    rows, docs = random_docs
    spec = FeatureSpec.from_spec([{"field": "text", "span": SPAN}])
    scanned = Collection(docs).scan(spec, 10).collect()
    assert sorted(r["doc_id"] for r in scanned) == [r[0] for r in rows]
    places = {(r["batch_id"], r["row_in_batch"]) for r in scanned}
    assert len(places) == len(rows)
    sizes = Counter(r["batch_id"] for r in scanned)
    assert max(sizes.values()) <= 10
    assert all({p[1] for p in places if p[0] == b} == set(range(n)) for b, n in sizes.items())


def test_longer_specifications_keep_the_first_columns(random_docs):
    _, docs = random_docs
    spec = FeatureSpec.from_spec([{"field": "text", "span": SPAN}])
    longer = spec.extend([{"field": "n", "span": 1}]).extend_terms("text", ["w1", "w2"])
    old = triples(Collection(docs).vectorize_all(spec).to_coo())
    new = triples(Collection(docs).vectorize_all(longer).to_coo())
    assert [t for t in new if t[1] < spec.n_cols] == old


def test_features_and_label(random_docs):
    rows, docs = random_docs
    entries = [{"field": "text", "span": SPAN}, {"field": "n", "span": 1}]
    found = Collection(docs).vectorize_all(FeatureSpec.from_spec(entries))
    parts = found.features_and_label().collect()
    assert {r["doc_id"]: r["label"] for r in parts} == {r[0]: float(r[3]) for r in rows}
    cells = sorted((r["doc_id"], c["col"], c["value"]) for r in parts for c in r["cells"])
    assert cells == expected_cells(rows, "term_freq")
