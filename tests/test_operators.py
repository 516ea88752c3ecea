"""Search, statistics, feature selection, numbering, sources and streams on small fixtures."""

import datetime

import pytest
from pyspark.sql import functions as F

from termloom import (
    Collection,
    FeatureSpec,
    FieldMapping,
    field_mapping,
    load_corpus,
    match,
    parse_date,
    prefix,
    random_order,
    scan_indices,
    term,
    terms,
    wildcard,
    write_batches,
    write_matrix,
)
from termloom.functions.scoring import significance
from termloom.functions.text import URL_EMAIL_PATTERN, Analyzer, term_counts
from termloom.operators import batches, learning, significance as chosen, term_stats
from termloom.operators.search import page_of
from termloom.plans.selection import Order
from termloom.plans.numbering import row_index, sum_before, top_per_group
from termloom.streaming import live

# The mapping and the document of the published example.
TWEETS = {
    "polarity": {"type": "short"},
    "tweet_id": {"type": "string", "index": "not_analyzed"},
    "date": {"type": "date", "format": "EEE MMM dd HH:mm:ss zzz yyyy"},
    "query": {"type": "string"},
    "user": {"type": "string", "index": "not_analyzed"},
    "text": {"type": "string", "analyzer": "mine"},
}
LINE = (
    '{"date": "Tue Jun 02 20:26:01 PDT 2009", "polarity": 1, "query": "NO_QUERY", '
    '"text": "i love it", "tweet_id": "2012313853", "user": "alex1234"}'
)


# -- significance -----------------------------------------------------------------------------------
# The ten published terms with their counts and scores.
BUCKETS = [
    ("you", 147254, 226172, 0.05561462321085083),
    ("thanks", 34066, 39809, 0.03029631391819203),
    ("love", 45060, 61299, 0.02648242218479298),
    ("good", 59137, 87394, 0.026119569585454378),
    ("your", 41396, 61109, 0.018360462657628574),
    ("great", 24374, 32349, 0.015445221205247653),
    ("thank", 15378, 17628, 0.014315483861158737),
    ("happy", 19707, 26041, 0.012650349278892475),
    ("awesome", 14199, 17957, 0.01031993171287668),
    ("haha", 20813, 30302, 0.009722417393085084),
]


def test_published_scores(spark):
    rows = spark.createDataFrame(BUCKETS, "key string, doc_count bigint, bg_count bigint, score double")
    score = significance(F.col("doc_count"), F.lit(800000), F.col("bg_count"), F.lit(1600001))
    for row in rows.withColumn("ours", score).collect():
        assert row["ours"] == pytest.approx(row["score"], rel=1e-9)


@pytest.fixture(scope="module")
def classed(spark):
    rows = [(i, "good day" if i % 3 else "bad day bad", "pos" if i % 3 else "neg") for i in range(30)]
    rows.append((30, "good only", None))
    return spark.createDataFrame(rows, "doc_id int, text string, label string")


def test_significant_terms(classed):
    found = chosen.significant_terms(classed, F.col("label") == "neg", "text", 5).collect()
    assert [(r["key"], r["doc_count"], r["bg_count"]) for r in found] == [("bad", 10, 10), ("day", 10, 30)]
    f, b = 10 / 10, 10 / 31
    assert found[0]["score"] == pytest.approx((f - b) * (f / b))
    assert chosen.significant_terms(classed, F.col("label") == "none", "text", 5).count() == 0


@pytest.mark.parametrize("limit", [None, "0"])
def test_classes_in_a_side_table(spark, classed, limit):
    labels = classed.select("doc_id", "label").where("doc_id < 20 or doc_id = 30")
    together = classed.drop("label").join(labels, "doc_id")
    apart = classed.drop("label")
    toxic = F.col("label") == "neg"
    rows = lambda frame: sorted(tuple(r) for r in frame.collect())
    if limit:
        spark.conf.set("termloom.broadcast.limit", limit)
    try:
        one = chosen.significant_terms(apart, toxic, "text", 5, side=labels)
        two = chosen.significant_terms(together, toxic, "text", 5)
        assert rows(one) == rows(two) != []
        one = chosen.significant_terms_by_class(apart, "label", "text", 5, side=labels)
        two = chosen.significant_terms_by_class(together, "label", "text", 5)
        assert rows(one) == rows(two) != []
    finally:
        spark.conf.unset("termloom.broadcast.limit")


def test_rare_terms_can_be_left_out(classed):
    found = chosen.significant_terms(classed, F.col("label") == "neg", "text", 5, min_doc_count=11)
    assert found.count() == 0


def test_by_class_agrees_with_one_class_at_a_time(classed):
    by_class = chosen.significant_terms_by_class(classed, "label", "text", 5)
    for label in ("pos", "neg"):
        one = chosen.significant_terms(classed, F.col("label") == label, "text", 5).collect()
        same = by_class.where(F.col("class") == label).orderBy("rank").collect()
        assert [(r["key"], r["score"]) for r in one] == [(r["key"], r["score"]) for r in same]
    union = chosen.feature_union(by_class, 5)
    assert chosen.feature_list(union) == ["bad", "day", "good"]
    counts = {r["class"]: r["doc_count"] for r in chosen.group_count(classed, "label").collect()}
    assert counts == {"pos": 20, "neg": 10, None: 1}


# -- numbering --------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows share one group and one sort value."""
    return spark.range(0, 3000, 1, 9).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"),
    )


def test_row_index_equals_sorting(spark, hot):
    order = sorted((r["g"], r["k"]) for r in hot.collect())
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    for coalesce in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        rows = row_index(hot, [F.col("g"), F.col("k")]).collect()
        assert [(r["g"], r["k"]) for r in sorted(rows, key=lambda r: r["row"])] == order
        assert sorted(r["row"] for r in rows) == list(range(3000))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_sum_before(spark, hot):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = sum_before(hot, "k", "g", "before").orderBy("k").collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    total = 0
    for row in rows:
        assert row["before"] == total
        total += row["g"]


def test_top_per_group(hot):
    got = top_per_group(hot, ["g"], [F.desc("k")], 4, ["k"], "rank").collect()
    groups = {}
    for row in sorted(hot.collect(), key=lambda r: -r["k"]):
        groups.setdefault(row["g"], []).append(row["k"])
    expected = {(g, k, i + 1) for g, ks in groups.items() for i, k in enumerate(ks[:4])}
    assert {(r["g"], r["k"], r["rank"]) for r in got} == expected and len(got) == len(expected)


def test_small_and_large_pages_agree(hot, monkeypatch):
    order = [Order("g", descending=True), Order("k")]
    near = {(r["k"], r["row"]) for r in page_of(hot, order, 100, 50).collect()}
    monkeypatch.setattr("termloom.operators.search.TOP_K_ROWS", 10)
    far = {(r["k"], r["row"]) for r in page_of(hot, order, 100, 50).collect()}
    assert near == far and {r for _, r in near} == set(range(50))


# -- search -----------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "The cat sat", "en", 3),
        (2, "le chat", "fr", None),
        (3, "cats and 50%_off dogs", "en", 5),
        (4, None, "fr", 1),
        (5, "dog cat cat", "en", 4),
    ]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string, n int")
    return Collection(frame, mapping=FieldMapping(keywords=frozenset({"lang"})))


@pytest.mark.parametrize(
    "query, expected",
    [
        (None, [1, 2, 3, 4, 5]),
        (term("text", "cat"), [1, 5]),
        (term("text", "The"), []),
        (term("lang", "fr"), [2, 4]),
        (term("n", 5), [3]),
        (terms("text", ["chat", "dogs"]), [2, 3]),
        (terms("text", []), []),
        (match("CHAT, sat!", "text"), [1, 2]),
        (match("cat dog", "text", "and"), [5]),
        (match("", "text", "and"), []),
        (prefix("text", "CAT"), [1, 3, 5]),
        (prefix("text", "CAT", lowercase=False), []),
        (wildcard("text", "c?t*"), [1, 3, 5]),
        (wildcard("text", "*at"), [1, 2, 5]),
        (wildcard("text", "_off"), [3]),
        (wildcard("text", "_*%"), []),
        (lambda df, mapping: F.col("n") > 3, [3, 5]),
    ],
)
def test_conditions(docs, query, expected):
    hits, _ = docs.hits(query)
    assert sorted(r["doc_id"] for r in hits.collect()) == expected
    assert docs.count(query).first()["n_docs"] == len(expected)


def test_match_refuses_other_operators():
    with pytest.raises(ValueError):
        match("a", "text", "xor")


def test_sorting_and_paging(docs):
    spec = FeatureSpec.from_spec([{"field": "text", "span": ["cat"]}])
    page = docs.search_vectorize(spec, sort=["n:desc"], from_=1, size=3)
    rows = {r["row"]: r["doc_id"] for r in page.docs.collect()}
    assert rows == {0: 5, 1: 1, 2: 4}
    assert sorted(tuple(r) for r in page.render("COO").collect()) == [(0, 0, 2.0), (1, 0, 1.0)]
    assert tuple(page.shape().first()) == (3, 1)
    assert docs.search_vectorize(spec).docs.count() == 5
    assert docs.search_vectorize(spec, from_=9).shape().first()["n_rows"] == 0
    with pytest.raises(ValueError):
        page.render("csr")
    with pytest.raises(ValueError):
        docs.hits(sort=["n:down"])


def test_limit_per_shard(docs):
    hits, _ = docs.hits(terminate_after=1, shard=["lang"])
    assert sorted(r["doc_id"] for r in hits.collect()) == [1, 2]


def test_random_order_does_not_depend_on_partitions(docs):
    spec = FeatureSpec.from_spec([{"field": "text", "span": ["cat"]}])

    def sample(frame):
        found = Collection(frame).search_vectorize(spec, sort=[random_order("doc_id", 3)], size=3)
        return {(r["row"], r["doc_id"]) for r in found.docs.collect()}

    assert sample(docs.df) == sample(docs.df.repartition(3))


def test_relevance(docs):
    best = docs.top_by_relevance("text", ["cat", "sat", "cat"], 10).collect()
    assert [r["doc_id"] for r in best] == [1, 5]


# -- text, statistics, sources ------------------------------------------------------------------------
def test_term_counts(spark):
    row = spark.range(1).select(term_counts(F.split(F.lit("b a b c b"), " ")).alias("t"))
    assert [tuple(t) for t in row.first()["t"]] == [("a", 1), ("b", 3), ("c", 1)]
    none = spark.range(1).select(term_counts(F.array().cast("array<string>")).alias("t"))
    assert none.first()["t"] == []


def test_url_and_email_tokens(spark):
    text = F.lit("See http://a.b/c?d=1 or mail me@x.org, OK")
    tokens = spark.range(1).select(Analyzer(URL_EMAIL_PATTERN).tokens(text).alias("t")).first()["t"]
    assert tokens == ["see", "http://a.b/c?d=1", "or", "mail", "me@x.org", "ok"]


def test_ttf_is_the_sum_of_term_frequencies(docs):
    vectors = term_stats.term_vectors(docs.df, ["text", "lang"], mapping=docs.mapping)
    stats = term_stats.term_stats(docs.df, ["text", "lang"], docs.mapping)
    sums = vectors.groupBy("field", "term").agg(F.count("*").alias("doc_freq"), F.sum("tf").alias("ttf"))
    assert sums.exceptAll(stats.select(*sums.columns)).count() == 0
    assert stats.where("field = 'lang' and term = 'en'").first()["doc_freq"] == 3


def test_date_pattern(spark):
    value = parse_date(F.lit("Tue Jun 02 20:26:01 PDT 2009"), "EEE MMM dd HH:mm:ss zzz yyyy")
    parsed = spark.range(1).select(F.unix_seconds(value).alias("s")).first()["s"]
    utc = datetime.datetime(2009, 6, 3, 3, 26, 1, tzinfo=datetime.timezone.utc)
    assert parsed == int(utc.timestamp())


@pytest.mark.parametrize("format", ["json", "bulk"])
def test_declared_corpus(spark, tmp_path, format):
    lines = [LINE] if format == "json" else ['{"index": {"_id": "1"}}', LINE]
    (tmp_path / "part.json").write_text("\n".join(lines) + "\n")
    corpus = load_corpus(spark, str(tmp_path), TWEETS, format)
    (row,) = corpus.collect()
    assert (row["polarity"], row["tweet_id"], row["user"]) == (1, "2012313853", "alex1234")
    assert dict(corpus.dtypes)["date"] == "timestamp" and dict(corpus.dtypes)["polarity"] == "smallint"
    mapping = field_mapping(TWEETS, {"mine": Analyzer(lowercase=False)})
    assert mapping.keywords == {"tweet_id", "user"} and not mapping.analyzer("text").lowercase


def test_several_collections(spark, small):
    paths = [f"{small}/documents.parquet", f"{small}/absent.parquet"]
    found = scan_indices(spark, paths, ignore_unavailable=True)
    assert {r["_index"] for r in found.select("_index").distinct().collect()} == {"documents"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_indices(spark, paths)


def test_written_forms(spark, docs, tmp_path):
    spec = FeatureSpec.from_spec([{"field": "text", "span": ["cat", "dog"]}])
    found = docs.vectorize_all(spec)
    for format in ("json", "csv"):
        write_matrix(found.to_coo(), str(tmp_path / format), format)
    write_matrix(found.to_dict(), str(tmp_path / "dict"), "parquet")
    back = spark.read.schema("row bigint, col int, data double").json(str(tmp_path / "json"))
    assert back.exceptAll(found.to_coo()).count() == 0 and back.count() == 3
    assert spark.read.parquet(str(tmp_path / "dict")).count() == 5
    written = write_batches(docs.scan(spec, 2), spec, str(tmp_path / "scan"), scanned=True)
    shapes = batches.batch_shapes(written, spec.n_cols)
    merged = batches.concat_batches(batches.batch_coo(written), shapes)
    assert merged.count() == 3 and batches.concat_shape(shapes).first()["n_rows"] == 5


# -- learning -----------------------------------------------------------------------------------------
def test_split_is_stable_and_near_its_share(spark):
    keys = spark.range(2000).withColumnRenamed("id", "doc_id")
    one = {r["doc_id"] for r in learning.hash_split(keys).where("is_test").collect()}
    two = {r["doc_id"] for r in learning.hash_split(keys.repartition(5)).where("is_test").collect()}
    assert one == two and 0.29 < len(one) / 2000 < 0.37
    train, test = learning.train_test_split(keys)
    assert train.count() + test.count() == 2000


# -- streams ------------------------------------------------------------------------------------------
def test_stream_equals_batch(spark, small, tmp_path):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    source = str(tmp_path / "source")
    documents.repartition(3).write.parquet(source)
    spec = FeatureSpec.from_spec([{"field": "text", "span": ["the", "le"]}, {"field": "n_chars", "span": 1}])
    stream = spark.readStream.schema(documents.schema).option("maxFilesPerTrigger", 1).parquet(source)
    cells = live.vectorize_stream(stream, spec)
    started = cells.writeStream.format("memory").queryName("cells_of_stream").trigger(availableNow=True).start()
    started.awaitTermination()
    assert not started.lastProgress["stateOperators"]
    batch = Collection(documents).vectorize_all(spec).docs
    assert spark.table("cells_of_stream").exceptAll(batch).count() == 0
    assert spark.table("cells_of_stream").count() == batch.count()

    live.keep_statistics(
        live.stream_statistics(stream, "text"), str(tmp_path / "stats"), str(tmp_path / "p1")
    ).awaitTermination()
    stored = live.stored_statistics(spark, str(tmp_path / "stats"))
    expected = term_stats.term_stats(documents, ["text"])
    assert stored.exceptAll(expected).count() == 0 and stored.count() == expected.count()

    counted = FeatureSpec.from_spec([{"field": "text", "span": ["the", "le"], "value": "ttf"}])
    live.vectorize_batches(
        stream, counted, str(tmp_path / "coo"), str(tmp_path / "p2"), statistics=stored
    ).awaitTermination()
    written = spark.read.parquet(str(tmp_path / "coo"))
    whole = Collection(documents).vectorize_all(counted).to_coo()
    assert written.select("batch_id").distinct().count() == 3
    values = lambda frame: sorted((r["col"], r["data"]) for r in frame.collect())
    assert values(written) == values(whole)
    with pytest.raises(ValueError, match="vectorize_batches"):
        live.vectorize_stream(stream, counted)


# -- fields in a table of their own -------------------------------------------------------------------
@pytest.fixture(scope="module")
def sided(spark, docs):
    rows = [(1, 0, "a"), (2, 1, "b"), (3, 1, "a"), (5, 0, None), (9, 1, "a")]
    side = spark.createDataFrame(rows, "doc_id int, label int, tag string")
    joined = Collection(docs.df.join(side, "doc_id"), mapping=docs.mapping)
    return Collection(docs.df, mapping=docs.mapping, side=side), joined


SIDED = FeatureSpec.from_spec(
    [
        {"field": "tag", "span": ["a", "b"]},
        {"field": "text", "span": ["cat", "chat", "dogs"]},
        {"field": "label", "span": 1},
        {"field": "n", "span": 1},
    ]
)


@pytest.mark.parametrize("query", [None, term("label", 1), term("text", "cat"), term("tag", "a")])
def test_side_table_equals_one_joined_frame(sided, query):
    apart, joined = sided
    rows = lambda frame: sorted(tuple(r) for r in frame.collect())
    one = apart.vectorize_all(SIDED, query, fields=["tag", "lang"])
    two = joined.vectorize_all(SIDED, query, fields=["tag", "lang"])
    assert one.docs.columns == two.docs.columns == ["doc_id", "tag", "lang", "cells"]
    assert rows(one.to_coo()) == rows(two.to_coo())
    assert tuple(one.shape().first()) == tuple(two.shape().first())
    options = {"sort": ["label:desc", "n:asc"], "from_": 1, "size": 2, "fields": ["label"]}
    one, two = (c.search_vectorize(SIDED, query, **options).docs for c in sided)
    assert rows(one.drop("cells")) == rows(two.drop("cells"))
    assert apart.count(query).first() == joined.count(query).first()


def test_one_document_with_a_side_table(sided):
    for doc_id in (2, 4, 9):
        one, two = (c.vectorize(SIDED, doc_id).first() for c in sided)
        assert one == two and one["found"] == (doc_id == 2)


def test_fields_of_a_side_table_are_not_missing(sided):
    apart, _ = sided
    assert apart.vectorize_all(SIDED, on_missing="error").docs.count() == 4
    with pytest.raises(ValueError, match="nowhere"):
        apart.vectorize_all(SIDED.extend([{"field": "nowhere", "span": 1}]), on_missing="error")


def test_text_is_not_moved_to_meet_a_side_table(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    spec = FeatureSpec.from_spec([{"field": "text", "span": ["the"]}, {"field": "toxic", "span": 1}])
    found = Collection(documents, side=labels)
    near = found.vectorize_all(spec).to_dict()
    spark.conf.set("termloom.broadcast.limit", "2000")
    try:
        apart = found.vectorize_all(spec).to_dict()
    finally:
        spark.conf.unset("termloom.broadcast.limit")
    plan = apart._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Join", 1)
    assert "regexp_extract_all" not in above and "regexp_extract_all" in below
    assert "LeftSemi" not in plan
    # A small side table leaves documents out before their text is read through.
    assert "LeftSemi" in near._jdf.queryExecution().executedPlan().toString()
    pairs = lambda frame: {r["doc_id"]: r["matrix"] for r in frame.collect()}
    assert pairs(near) == pairs(apart)


def test_labels_may_meet_finished_vectors(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b"), (3, "c")], "doc_id int, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id int, label int")
    spec = FeatureSpec.from_spec([{"field": "text", "span": ["a", "b"]}, {"field": "label", "span": 1}])
    rows = learning.training_frame(docs, spec, labels=labels).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["features"].toArray().tolist(), r["label"]) for r in rows] == [
        (1, [1, 1], 1), (2, [0, 1], 0),
    ]
    whole = learning.training_frame(docs.join(labels, "doc_id"), spec).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [tuple(r) for r in whole]
