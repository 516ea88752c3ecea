"""One Spark query per operator, each over its whole tables."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom import (
    Analyzer,
    Collection,
    FeatureSpec,
    FieldMapping,
    all_of,
    analyze,
    any_of,
    exists,
    fuzzy,
    ids,
    keyword,
    load_corpus,
    match,
    none_of,
    parse_date,
    phrase,
    prefix,
    query_string,
    random_order,
    range_,
    regexp,
    scan_indices,
    scan_matching,
    term,
    terms,
    url_email_analyzer,
    wildcard,
    write_batches,
    write_market,
    write_market_batches,
    write_matrix,
)
from termloom.functions.text import URL_EMAIL_PATTERN
from termloom.operators import batches, learning, matrix, significance, term_stats
from termloom.operators.search import page_of
from termloom.plans.numbering import row_index
from termloom.plans.selection import Order
from termloom.plans.sizing import scratch_dir, settle
from termloom.sources.corpus import mapping_schema
from termloom.streaming import changes, live

from .specs import (
    ASKED,
    BATCH,
    KEYWORDS,
    N_PER_CLASS,
    N_SIGNIFICANT,
    N_SLOTS,
    PAGE_FROM,
    PAGE_SIZE,
    SEED,
    STOP_WORDS,
    WORDS,
    mixed_entries,
    text_spec,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


# -- tables -----------------------------------------------------------------------------------
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")


def collection(spark: SparkSession, sf_dir: str) -> Collection:
    return Collection(documents(spark, sf_dir), mapping=KEYWORDS)


def labelled_collection(spark: SparkSession, sf_dir: str) -> Collection:
    labels = table(spark, sf_dir, "labels")
    return Collection(documents(spark, sf_dir), mapping=KEYWORDS, side=labels)


def mixed() -> FeatureSpec:
    return FeatureSpec.from_spec(mixed_entries())


def by_key(frame: matrix.Matrix) -> DataFrame:
    return matrix.coo(frame.docs, list(frame.key))


def joined_text(column: str):
    return F.array_join(F.col(column).cast("array<string>"), ",")


# -- text analysis and statistics -----------------------------------------------------------------
def _positions(df: DataFrame, analyzer: Analyzer) -> DataFrame:
    tokens = F.posexplode_outer(analyze(F.col("text"), analyzer)).alias("pos", "token")
    return df.select("doc_id", tokens).where(F.col("token").isNotNull())


@query
def analyze_tokens(spark, sf_dir):
    return _positions(documents(spark, sf_dir), Analyzer())


@query
def analyze_stop_list(spark, sf_dir):
    analyzer = Analyzer(stop_words=STOP_WORDS, stop_before_lower=True)
    return _positions(documents(spark, sf_dir), analyzer)


@query
def analyze_url_email(spark, sf_dir):
    return _positions(documents(spark, sf_dir), Analyzer(pattern=URL_EMAIL_PATTERN))


@query
def analyze_word_break(spark, sf_dir):
    """Words by the Unicode rules, URLs and addresses whole, English stop words left out as written."""
    return _positions(documents(spark, sf_dir), url_email_analyzer())


@query
def analyze_word_slots(spark, sf_dir):
    """The same tokens by their position in the text."""
    slots = F.posexplode_outer(url_email_analyzer().slots(F.col("text"))).alias("pos", "token")
    return documents(spark, sf_dir).select("doc_id", slots).where(F.col("token").isNotNull())


@query
def keyword_terms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    pair = F.explode_outer(F.concat(keyword(F.col("lang")), keyword(F.col("source"))))
    return docs.select("doc_id", pair.alias("term")).where(F.col("term").isNotNull())


@query
def term_vectors(spark, sf_dir):
    return term_stats.term_vectors(documents(spark, sf_dir), ["text", "lang"], mapping=KEYWORDS)


@query
def doc_freq(spark, sf_dir):
    return term_stats.doc_freq(documents(spark, sf_dir), "text")


@query
def ttf(spark, sf_dir):
    return term_stats.total_term_freq(documents(spark, sf_dir), "text")


@query
def global_stats(spark, sf_dir):
    return term_stats.term_stats(documents(spark, sf_dir), ["text", "source"], KEYWORDS)


@query
def local_stats(spark, sf_dir):
    return term_stats.term_stats(documents(spark, sf_dir), ["text"], KEYWORDS, ["source"])


@query
def vocabulary_stats(spark, sf_dir):
    """The vocabulary of a specification with the statistics of its terms."""
    docs = documents(spark, sf_dir)
    columns = mixed().vocabulary(spark).where("term is not null").select("col", "field", "term")
    stats = term_stats.term_stats(docs, ["text", "lang"], KEYWORDS)
    known = columns.join(stats, ["field", "term"], "left")
    return known.fillna(0, ["doc_freq", "ttf"])


# -- the vectorizer -----------------------------------------------------------------------------------
def _text_matrix(spark, sf_dir, option, **options):
    return by_key(collection(spark, sf_dir).vectorize_all(text_spec(option), **options))


@query
def vec_binary(spark, sf_dir):
    return _text_matrix(spark, sf_dir, "binary")


@query
def vec_term_freq(spark, sf_dir):
    return _text_matrix(spark, sf_dir, "term_freq")


@query
def vec_doc_freq(spark, sf_dir):
    return _text_matrix(spark, sf_dir, "doc_freq")


@query
def vec_ttf(spark, sf_dir):
    return _text_matrix(spark, sf_dir, "ttf")


@query
def vec_local_doc_freq(spark, sf_dir):
    return _text_matrix(spark, sf_dir, "doc_freq", scope=["source"])


@query
def vec_filtered_ttf(spark, sf_dir):
    """Statistics describe the whole collection although a query chooses the documents."""
    return _text_matrix(spark, sf_dir, "ttf", query=term("lang", "fr"))


@query
def vec_numeric_span(spark, sf_dir):
    spec = FeatureSpec.from_spec([{"field": "embedding", "span": N_SLOTS}])
    vectors = Collection(table(spark, sf_dir, "embeddings"), ("vec_id",))
    return by_key(vectors.vectorize_all(spec))


@query
def vec_array_span(spark, sf_dir):
    """The first three quantities of every order: arrays shorter and longer than the span."""
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity")))
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(lines.alias("lines"))
    orders = orders.select("l_orderkey", F.col("lines.l_quantity").alias("quantity"))
    spec = FeatureSpec.from_spec([{"field": "quantity", "span": 3}])
    return by_key(Collection(orders, ("l_orderkey",)).vectorize_all(spec))


def _events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return Collection(events.withColumn("high", F.col("value") > 50), ("event_id",), KEYWORDS)


def _event_spec():
    fields = ("high", "user_id", "value", "ts")
    return FeatureSpec.from_spec([{"field": f, "span": 1} for f in fields])


@query
def vec_cast(spark, sf_dir):
    return by_key(_events(spark, sf_dir).vectorize_all(_event_spec()))


@query
def vec_int_compat(spark, sf_dir):
    shifted = _events(spark, sf_dir)
    wide = shifted.df.withColumn("user_id", F.col("user_id") + F.lit(4294967290))
    events = Collection(wide, ("event_id",), KEYWORDS)
    return by_key(events.vectorize_all(_event_spec(), numeric_mode="int_compat"))


@query
def vec_multi_field(spark, sf_dir):
    return by_key(labelled_collection(spark, sf_dir).vectorize_all(mixed()))


@query
def vec_interleaved(spark, sf_dir):
    """A field listed twice, around another one: its columns are not side by side."""
    entries = [
        {"field": "text", "span": WORDS[:4]},
        {"field": "n_chars", "span": 1},
        {"field": "text", "span": WORDS[2:]},
    ]
    return by_key(collection(spark, sf_dir).vectorize_all(FeatureSpec.from_spec(entries)))


@query
def vec_all_binary(spark, sf_dir):
    entries = [{**e, "value": "binary"} for e in mixed_entries()[:2]]
    return by_key(collection(spark, sf_dir).vectorize_all(FeatureSpec.from_spec(entries)))


@query
def vec_row(spark, sf_dir):
    docs = collection(spark, sf_dir).vectorize_all(text_spec("term_freq")).docs
    pair = F.transform("cells", lambda c: F.concat_ws(":", c["col"], c["value"]))
    return docs.select("doc_id", F.size("cells").alias("n_cells"), F.array_join(pair, " ").alias("cells"))


@query
def vec_set_value(spark, sf_dir):
    spec = mixed().set_value("text", "binary").set_value("lang", "doc_freq")
    # The frequencies are those of the labelled documents.
    return by_key(labelled_collection(spark, sf_dir).vectorize_all(spec))


@query
def vec_foreign_statistics(spark, sf_dir):
    """Statistics of another collection: a term that it does not have gives no cell."""
    return _text_matrix(spark, sf_dir, "doc_freq", corpus=table(spark, sf_dir, "conversations").select("text"))


@query
def vec_foreign_joined(spark, sf_dir):
    """The same by the plan for dictionaries beyond the broadcast limit."""
    turns = table(spark, sf_dir, "conversations").select("text")
    return _text_matrix(spark, sf_dir, "doc_freq", corpus=turns, largest_broadcast=0)


def _judged(spark, sf_dir):
    return labelled(spark, sf_dir).select("source", "text")


@query
def vec_foreign_scope(spark, sf_dir):
    return _text_matrix(spark, sf_dir, "ttf", corpus=_judged(spark, sf_dir), scope=["source"])


@query
def vec_foreign_scope_joined(spark, sf_dir):
    corpus = _judged(spark, sf_dir)
    return _text_matrix(spark, sf_dir, "ttf", corpus=corpus, scope=["source"], largest_broadcast=0)


@query
def side_doc_freq(spark, sf_dir):
    """Only documents that are in both tables count, for rows and statistics alike."""
    return by_key(labelled_collection(spark, sf_dir).vectorize_all(text_spec("doc_freq")))


@query
def side_scope(spark, sf_dir):
    """Statistics by a column of the side table."""
    return by_key(labelled_collection(spark, sf_dir).vectorize_all(text_spec("doc_freq"), scope=["quality"]))


@query
def side_tf_idf(spark, sf_dir):
    cells = labelled_collection(spark, sf_dir).tf_idf(text_spec("term_freq"))
    return cells.withColumn("data", F.round("data", 6))


@query
def side_relevance(spark, sf_dir):
    best = labelled_collection(spark, sf_dir).top_by_relevance("text", ASKED, 50)
    return best.withColumn("score", F.round("score", 6))


@query
def vec_extend(spark, sf_dir):
    spec = text_spec("term_freq").extend([{"field": "lang", "span": ["fr"], "value": "binary"}])
    spec = spec.extend_terms("text", ["to", "the", "in"])
    return by_key(collection(spark, sf_dir).vectorize_all(spec))


@query
def tf_idf(spark, sf_dir):
    cells = collection(spark, sf_dir).tf_idf(text_spec("term_freq"))
    return cells.withColumn("data", F.round("data", 6))


# -- retrieval ------------------------------------------------------------------------------------------
@query
def toxic_matrix(spark, sf_dir):
    """A query on the side table, a page, and a field of each table."""
    found = labelled_collection(spark, sf_dir).search_vectorize(
        mixed(), term("toxic", 1), sort=["quality:desc", "n_chars:asc"], size=20,
        fields=["lang", "quality"],
    )
    return found.to_dict().withColumn("matrix", F.to_json("matrix"))


@query
def toxic_rows(spark, sf_dir):
    return by_key(labelled_collection(spark, sf_dir).vectorize_all(mixed(), term("toxic", 1)))


@query
def one_document(spark, sf_dir):
    found = Collection(table(spark, sf_dir, "documents"), mapping=KEYWORDS).vectorize(
        text_spec("term_freq").extend([{"field": "n_chars", "span": 1}]), 7
    )
    return found.withColumn("matrix", F.to_json("matrix"))


@query
def one_document_coo(spark, sf_dir):
    docs = Collection(table(spark, sf_dir, "documents"), mapping=KEYWORDS)
    found = docs.vectorize(text_spec("term_freq"), 7, sparse_format="coo")
    parts = [joined_text(f"matrix.{name}").alias(name) for name in ("row", "col", "data")]
    return found.select("doc_id", *parts)


@query
def missing_document(spark, sf_dir):
    docs = Collection(table(spark, sf_dir, "documents"), mapping=KEYWORDS)
    return docs.vectorize(text_spec("binary"), -1).withColumn("matrix", F.to_json("matrix"))


@query
def search_page(spark, sf_dir):
    spec = text_spec("binary").extend([{"field": "n_chars", "span": 1}])
    return collection(spark, sf_dir).search_vectorize(
        spec, terms("text", WORDS), size=3
    ).to_coo()


def _found(spark, sf_dir, condition):
    return collection(spark, sf_dir).hits(condition)[0]


@query
def match_all_documents(spark, sf_dir):
    return _found(spark, sf_dir, None)


@query
def term_query(spark, sf_dir):
    return _found(spark, sf_dir, term("text", "the"))


@query
def keyword_query(spark, sf_dir):
    return _found(spark, sf_dir, term("lang", "fr"))


@query
def number_query(spark, sf_dir):
    return labelled_collection(spark, sf_dir).hits(term("toxic", 1))[0]


@query
def terms_query(spark, sf_dir):
    return _found(spark, sf_dir, terms("text", ["idiot", "clown", "le"]))


@query
def match_query(spark, sf_dir):
    return _found(spark, sf_dir, match("Les, MORON!", "text"))


@query
def match_all_terms(spark, sf_dir):
    return _found(spark, sf_dir, match("the of THAT", "text", operator="and"))


@query
def prefix_query(spark, sf_dir):
    return _found(spark, sf_dir, prefix("text", "Wor"))


@query
def wildcard_query(spark, sf_dir):
    return _found(spark, sf_dir, wildcard("text", "w?r*s"))


def _dictionary(spark, sf_dir):
    """The terms of the texts, as a table of stored statistics would give them."""
    return settle(term_stats.term_stats(documents(spark, sf_dir), ["text"], KEYWORDS))


@query
def prefix_expanded(spark, sf_dir):
    return _found(spark, sf_dir, prefix("text", "Wor", dictionary=_dictionary(spark, sf_dir)))


@query
def wildcard_expanded(spark, sf_dir):
    return _found(spark, sf_dir, wildcard("text", "w?r*s", dictionary=_dictionary(spark, sf_dir)))


@query
def fuzzy_query(spark, sf_dir):
    return _found(spark, sf_dir, fuzzy("text", "Morno", 1, dictionary=_dictionary(spark, sf_dir)))


@query
def fuzzy_in_rows(spark, sf_dir):
    """Two edits, tested on the tokens of each text."""
    return _found(spark, sf_dir, fuzzy("text", "idoit", 2, transpositions=False))


@query
def regexp_query(spark, sf_dir):
    return _found(spark, sf_dir, regexp("text", "(mor|id).*t?n?s?"))


@query
def phrase_query(spark, sf_dir):
    return _found(spark, sf_dir, phrase("text", "Was the"))


@query
def phrase_over_stop_words(spark, sf_dir):
    """The place of a dropped stop word is any word."""
    analyzers = FieldMapping(analyzers={"text": url_email_analyzer()})
    docs = Collection(documents(spark, sf_dir), mapping=analyzers)
    return docs.hits(phrase("text", "que the de"))[0]


@query
def slop_query(spark, sf_dir):
    return _found(spark, sf_dir, phrase("text", "that was", slop=4))


@query
def slop_of_equal_terms(spark, sf_dir):
    return _found(spark, sf_dir, phrase("text", "was was", slop=2))


@query
def query_string_any(spark, sf_dir):
    return _found(spark, sf_dir, query_string('les OR Moron "was the"~1', "text"))


@query
def query_string_mixed(spark, sf_dir):
    q = '+the -lang:(de OR fr) +(wor* n_chars:[100 TO 900} "of the") NOT source:web1'
    return _found(spark, sf_dir, query_string(q, "text"))


@query
def query_string_all(spark, sf_dir):
    """All words are required unless joined by OR; patterns go through the dictionary."""
    known = _dictionary(spark, sf_dir)
    q = "of that is || was !idi?t doc_id:>=100"
    return _found(spark, sf_dir, query_string(q, "text", default_operator="and", dictionary=known))


@query
def query_string_page(spark, sf_dir):
    """A query string chooses the documents of a page."""
    docs = collection(spark, sf_dir)
    asked = query_string("_exists_:lang AND (idiot~1 OR text:{wora TO worz])", "text")
    return docs.search_vectorize(text_spec("term_freq"), asked, sort=["n_chars:desc"], size=40).to_coo()


@query
def random_sample(spark, sf_dir):
    docs = collection(spark, sf_dir)
    order = [random_order("doc_id", SEED)]
    return docs.search_vectorize(text_spec("term_freq"), sort=order, size=100).to_coo()


@query
def sorted_page(spark, sf_dir):
    docs = collection(spark, sf_dir)
    page = docs.search_vectorize(
        text_spec("term_freq"),
        sort=["lang:asc", "n_chars:desc"],
        from_=PAGE_FROM,
        size=PAGE_SIZE,
        fields=["lang", "n_chars"],
    )
    return page.to_dict().withColumn("matrix", F.to_json("matrix"))


@query
def deep_page(spark, sf_dir):
    """A page beyond the top-k bound: only the part of the order that holds it is sorted."""
    lines = table(spark, sf_dir, "lineitem")
    order = [Order("l_shipdate", descending=True), Order("l_orderkey"), Order("l_linenumber")]
    keys = lines.select("l_shipdate", "l_orderkey", "l_linenumber")
    return page_of(keys, order, 20_000, 500).select("l_orderkey", "l_linenumber", "row")


@query
def large_sample(spark, sf_dir):
    """A repeatable sample beyond the top-k bound: rows are cut by their digests, not all sorted."""
    orders = Collection(table(spark, sf_dir, "orders"), ("o_orderkey",))
    spec = FeatureSpec.from_spec([{"field": "o_custkey", "span": 1}])
    return orders.search_vectorize(spec, sort=[random_order("o_orderkey", SEED)], size=11_000).to_coo()


@query
def per_shard_limit(spark, sf_dir):
    hits, _ = collection(spark, sf_dir).hits(
        term("lang", "en"), terminate_after=7, shard=["source"]
    )
    return hits


@query
def field_projection(spark, sf_dir):
    found = collection(spark, sf_dir).vectorize_all(
        text_spec("binary"), term("lang", "es"), fields=["source", "n_chars"]
    )
    return found.to_dict().withColumn("matrix", F.to_json("matrix"))


@query
def relevance_topk(spark, sf_dir):
    best = collection(spark, sf_dir).top_by_relevance("text", ASKED, 50)
    return best.withColumn("score", F.round("score", 6))


@query
def relevance_page(spark, sf_dir):
    """A page of a matrix in the order of relevance."""
    page = collection(spark, sf_dir).search_vectorize(
        text_spec("term_freq"), terms("text", ASKED), sort=["_score:desc"], relevance=("text", ASKED), size=25
    )
    return page.to_coo()


@query
def all_conditions(spark, sf_dir):
    wanted = all_of(term("text", "the"), range_("n_chars", gte=200, lt=3000), exists("lang"))
    return _found(spark, sf_dir, wanted)


@query
def any_condition(spark, sf_dir):
    return _found(spark, sf_dir, any_of(term("lang", "es"), prefix("text", "wor"), range_("n_chars", gt=5000)))


@query
def no_condition(spark, sf_dir):
    return _found(spark, sf_dir, none_of(term("text", "the"), term("lang", "de"), range_("doc_id", lte=100)))


@query
def ids_query(spark, sf_dir):
    return _found(spark, sf_dir, ids([3, 7, 7, 11, -4]))


@query
def terminate_all(spark, sf_dir):
    """Collecting ends after so many documents of the whole collection."""
    return collection(spark, sf_dir).hits(term("lang", "en"), terminate_after=60)[0]


@query
def terminate_deep(spark, sf_dir):
    """The same beyond the top-k bound: rows are numbered."""
    lines = Collection(table(spark, sf_dir, "lineitem"), ("l_orderkey", "l_linenumber"))
    return lines.hits(range_("l_quantity", lt=40), terminate_after=12_000)[0]


@query
def count_only(spark, sf_dir):
    return collection(spark, sf_dir).count(terms("text", ["idiot", "trash"]))


# -- rows and batches -----------------------------------------------------------------------------------
@query
def row_numbers(spark, sf_dir):
    keys = table(spark, sf_dir, "documents").select("n_chars", "doc_id")
    return row_index(keys, [F.desc("n_chars"), F.col("doc_id")]).select("doc_id", "row")


def _scrolled(spark, sf_dir, cutoff=-1):
    docs = collection(spark, sf_dir)
    return docs.scroll(text_spec("term_freq"), BATCH, sort=["n_chars:desc"], cutoff=cutoff)


@query
def scroll_batches(spark, sf_dir):
    return batches.batch_coo(_scrolled(spark, sf_dir).docs)


@query
def scroll_cutoff(spark, sf_dir):
    return batches.batch_coo(_scrolled(spark, sf_dir, cutoff=2).docs)


@query
def batch_shapes(spark, sf_dir):
    scrolled = _scrolled(spark, sf_dir)
    return batches.batch_shapes(scrolled.docs, scrolled.spec.n_cols)


@query
def scan_export(spark, sf_dir):
    """Every document once, in batches cut where the documents lie."""
    scanned = collection(spark, sf_dir).scan(text_spec("term_freq"), BATCH, fields=["lang"])
    return matrix.coo(scanned, ["doc_id", "lang"])


@query
def scan_cutoff(spark, sf_dir):
    """The first batches of an export: their number and whether none is larger than asked for."""
    scanned = collection(spark, sf_dir).scan(text_spec("binary"), BATCH, cutoff=2)
    sizes = scanned.groupBy("batch_id").agg(F.count("*").alias("n"))
    return sizes.agg(
        F.count("*").alias("n_batches"), (F.max("n") <= BATCH).alias("within"), F.min(F.col("n") > 0).alias("filled")
    )


@query
def concat_batches(spark, sf_dir):
    docs = settle(_scrolled(spark, sf_dir).docs.select("batch_id", "row_in_batch", "cells"))
    return batches.concat_batches(
        batches.batch_coo(docs), batches.batch_shapes(docs, len(WORDS))
    )


@query
def concat_scan(spark, sf_dir):
    """An unordered export put together again has the shape of the whole collection."""
    scanned = collection(spark, sf_dir).scan(text_spec("binary"), BATCH)
    path = f"{scratch_dir(spark)}/scan-{uuid.uuid4().hex}"
    written = write_batches(scanned, text_spec("binary"), path, scanned=True)
    shapes = batches.batch_shapes(written, len(WORDS))
    whole = batches.concat_batches(batches.batch_coo(written), shapes)
    cells = whole.agg(
        F.countDistinct("row").alias("rows_with_cells"),
        F.count("*").alias("n_cells"),
        F.sum("data").alias("total"),
    ).select(F.struct("*").alias("c"))
    shape = batches.concat_shape(shapes)
    return shape.select("n_rows", "n_cols", cells.scalar().alias("c")).select(
        "n_rows", "n_cols", "c.*"
    )


# -- matrix forms ---------------------------------------------------------------------------------------
@query
def dict_matrix(spark, sf_dir):
    found = labelled_collection(spark, sf_dir).vectorize_all(mixed())
    return found.to_dict().withColumn("matrix", F.to_json("matrix"))


@query
def coo_matrix(spark, sf_dir):
    return labelled_collection(spark, sf_dir).vectorize_all(mixed()).to_coo()


@query
def shape(spark, sf_dir):
    return collection(spark, sf_dir).vectorize_all(mixed()).shape()


@query
def index_value_arrays(spark, sf_dir):
    found = labelled_collection(spark, sf_dir).vectorize_all(mixed()).to_vector()
    return found.select("doc_id", joined_text("indices").alias("indices"), joined_text("values").alias("values"))


@query
def ml_vectors(spark, sf_dir):
    vectors = learning.with_ml_vector(labelled(spark, sf_dir), mixed(), KEYWORDS)
    dense = vectors.withColumn("features", vector_to_array("features"))
    return dense.select("doc_id", joined_text("features").alias("features"))


@query
def features_and_label(spark, sf_dir):
    parts = labelled_collection(spark, sf_dir).vectorize_all(mixed()).features_and_label()
    entry = F.map_from_entries("cells")
    return parts.select("doc_id", "label", F.to_json(entry).alias("features"))


@query
def duplicate_sum(spark, sf_dir):
    """Every turn is a document, every conversation a row: equal (row, col) entries add up."""
    turns = table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "row")
    cells = Collection(turns, ("row", "turn")).vectorize_all(text_spec("term_freq"))
    return matrix.sum_duplicates(matrix.coo(cells.docs, ["row"]))


@query
def csr_rows(spark, sf_dir):
    triples = collection(spark, sf_dir).vectorize_all(text_spec("term_freq")).to_coo()
    packed = matrix.rows_of(triples)
    return packed.select("row", joined_text("indices").alias("indices"), joined_text("values").alias("values"))


@query
def written_matrix(spark, sf_dir):
    """A COO export, one folder per batch, read back."""
    path = f"{scratch_dir(spark)}/coo-{uuid.uuid4().hex}"
    write_matrix(batches.batch_coo(_scrolled(spark, sf_dir).docs), path, partition_by=["batch_id"])
    read = spark.read.parquet(path)
    return read.withColumn("batch_id", F.col("batch_id").cast("bigint"))


@query
def written_batches(spark, sf_dir):
    """An export of cells per document, one folder per batch, read back."""
    path = f"{scratch_dir(spark)}/batches-{uuid.uuid4().hex}"
    scrolled = _scrolled(spark, sf_dir)
    return batches.batch_coo(write_batches(scrolled.docs, scrolled.spec, path))


@query
def market_lines(spark, sf_dir):
    """The whole matrix as one file in the exchange format of sparse matrices, in parts that follow each other."""
    path = f"{scratch_dir(spark)}/market-{uuid.uuid4().hex}"
    write_market(collection(spark, sf_dir).vectorize_all(text_spec("term_freq")), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query
def market_batches(spark, sf_dir):
    """One file of its own per batch."""
    path = f"{scratch_dir(spark)}/market-{uuid.uuid4().hex}"
    write_market_batches(collection(spark, sf_dir).vectorize_all(text_spec("term_freq")).batches(BATCH), path)
    return spark.read.text(path).select(F.col("batch_id").cast("bigint").alias("batch_id"), F.col("value").alias("line"))


@query
def written_json(spark, sf_dir):
    """A DICT export as JSON lines, read back."""
    path = f"{scratch_dir(spark)}/dict-{uuid.uuid4().hex}"
    found = collection(spark, sf_dir).vectorize_all(text_spec("term_freq"))
    write_matrix(found.to_dict(), path, "json")
    read = spark.read.schema("doc_id bigint, matrix map<string,double>").json(path)
    return read.withColumn("matrix", F.to_json("matrix"))


# -- feature selection --------------------------------------------------------------------------------------
@query
def significant_terms(spark, sf_dir):
    return _toxic_terms(spark, sf_dir)


def _toxic_terms(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    toxic = F.col("toxic") == 1
    return significance.significant_terms(docs, toxic, "text", N_SIGNIFICANT, side=labels)


def _by_class(spark, sf_dir, size=N_SIGNIFICANT):
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    return significance.significant_terms_by_class(docs, "toxic", "text", size, side=labels)


@query
def significant_by_class(spark, sf_dir):
    return _by_class(spark, sf_dir)


@query
def significant_by_language(spark, sf_dir):
    return significance.significant_terms_by_class(
        documents(spark, sf_dir), "lang", "text", 300, mapping=KEYWORDS
    )


@query
def feature_union(spark, sf_dir):
    return significance.feature_union(_by_class(spark, sf_dir), N_SIGNIFICANT)


@query
def group_count(spark, sf_dir):
    return significance.group_count(labelled(spark, sf_dir), "toxic")


@query
def labelled_matrix(spark, sf_dir):
    """From the corpus to a labelled matrix: significant terms, specification, COO."""
    span = [r["key"] for r in _toxic_terms(spark, sf_dir).collect()]
    spec = FeatureSpec.from_spec(
        [
            {"field": "text", "span": span, "value": "binary"},
            {"field": "n_chars", "span": 1},
            {"field": "toxic", "span": 1},
        ]
    )
    return labelled_collection(spark, sf_dir).vectorize_all(spec).to_coo()


# -- learning -------------------------------------------------------------------------------------------
@query
def hash_split(spark, sf_dir):
    keys = table(spark, sf_dir, "documents").select("doc_id")
    return learning.hash_split(keys, seed=SEED)


def _training_spec(spark, sf_dir, size):
    ranked = _by_class(spark, sf_dir, size)
    span = significance.feature_list(significance.feature_union(ranked, size))
    return FeatureSpec.from_spec(
        [{"field": "text", "span": span, "value": "binary"}, {"field": "toxic", "span": 1}]
    )


def _predictions(spark, sf_dir):
    spec = _training_spec(spark, sf_dir, N_PER_CLASS)
    # Training reads its rows several times and the test set once more: settle them.
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    frame = settle(learning.training_frame(docs, spec, mapping=KEYWORDS, labels=labels))
    train, test = learning.train_test_split(frame, seed=SEED)
    model = learning.train_linear_svc(train)
    return learning.predict(model, test)


@query
def svc_rows(spark, sf_dir):
    """The test documents with their labels, and whether each got a class."""
    answered = F.col("prediction").isin(0.0, 1.0)
    return _predictions(spark, sf_dir).select("doc_id", "label", answered.alias("answered"))


@query
def svc_check(spark, sf_dir):
    """Stored beside its specification and loaded again, the model does not fall below the majority share."""
    path = f"{scratch_dir(spark)}/model-{uuid.uuid4().hex}"
    spec = _training_spec(spark, sf_dir, N_PER_CLASS)
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    frame = settle(learning.training_frame(docs, spec, mapping=KEYWORDS, labels=labels))
    train, test = learning.train_test_split(frame, seed=SEED)
    learning.save_model(learning.train_linear_svc(train), spec, path)
    model, stored = learning.load_model(path)
    seen = learning.predict(model, test)
    right = F.sum((F.col("prediction") == F.col("label")).cast("int"))
    usual = F.greatest(F.sum(F.col("label")), F.count("*") - F.sum(F.col("label")))
    same = F.lit(stored == spec)
    return seen.agg(F.count("*").alias("n_rows"), (right >= usual).alias("holds"), F.first(same).alias("stored"))


@query
def svc_predictions(spark, sf_dir):
    return _predictions(spark, sf_dir).select("doc_id", "label", "prediction")


@query
def svc_accuracy(spark, sf_dir):
    return learning.accuracy(_predictions(spark, sf_dir))


@query
def accuracy(spark, sf_dir):
    """Share of right labels of given predictions: low quality predicts toxic."""
    given = table(spark, sf_dir, "labels").withColumn("prediction", 1 - F.col("quality"))
    return learning.accuracy(given, "toxic", "prediction")


@query
def rescore_conversations(spark, sf_dir):
    """A stored specification fills the same columns from another collection."""
    stored = FeatureSpec.from_json(text_spec("term_freq").to_json())
    turns = Collection(table(spark, sf_dir, "conversations"), ("conv_id", "turn"))
    return by_key(turns.vectorize_all(stored))


# -- sources -------------------------------------------------------------------------------------------
_DECLARED = {
    "doc_id": {"type": "long"},
    "text": {"type": "string"},
    "lang": {"type": "string", "index": "not_analyzed"},
    "n_chars": {"type": "long"},
}


@query
def json_corpus(spark, sf_dir):
    """Documents as JSON lines under a declared mapping."""
    path = f"{scratch_dir(spark)}/corpus-{uuid.uuid4().hex}"
    names = mapping_schema(_DECLARED).fieldNames()
    table(spark, sf_dir, "documents").select(*names).write.json(path)
    loaded = load_corpus(spark, path, _DECLARED)
    return loaded.select("doc_id", "lang", "n_chars", F.md5("text").alias("text_md5"))


@query
def bulk_corpus(spark, sf_dir):
    """A bulk file written from documents, with deletions, updates and broken lines in between."""
    path = f"{scratch_dir(spark)}/bulk-{uuid.uuid4().hex}"
    names = mapping_schema(_DECLARED).fieldNames()
    action = F.format_string('{"index": {"_id": "d%d"}}', "doc_id")
    more = F.when(
        F.col("doc_id") % 3 == 0,
        F.format_string('\n{"delete": {"_id": "x%d"}}\n{"update": {"_id": "y"}}\n{"doc": {"lang": "xx"}}', "doc_id"),
    ).when(F.col("doc_id") % 3 == 1, F.lit('\n{"create": {}}\n{broken'))
    lines = F.concat(action, F.lit("\n"), F.to_json(F.struct(*names)), F.coalesce(more, F.lit("")))
    table(spark, sf_dir, "documents").select(lines.alias("value")).write.text(path)
    loaded = load_corpus(spark, path, _DECLARED, "bulk")
    return loaded.select("_id", "doc_id", "lang", "n_chars", F.md5("text").alias("text_md5"))


@query
def parsed_dates(spark, sf_dir):
    pattern = "EEE MMM dd HH:mm:ss zzz yyyy"
    day = F.date_format("ts", "EEE MMM dd HH:mm:ss")
    written = F.concat(day, F.lit(" UTC "), F.date_format("ts", "yyyy"))
    seconds = F.unix_seconds(parse_date(written, pattern)).alias("seconds")
    return table(spark, sf_dir, "events").select("event_id", seconds)


@query
def multi_table_scan(spark, sf_dir):
    both = scan_indices(
        spark,
        [f"{sf_dir}/documents.parquet", f"{sf_dir}/conversations.parquet", f"{sf_dir}/absent.parquet"],
        ignore_unavailable=True,
        columns={"conversations": {"conv_id": "doc_id"}},
    )
    cells = Collection(both, ("_index", "doc_id", "turn")).vectorize_all(text_spec("term_freq"))
    return by_key(cells)


@query
def wildcard_scan(spark, sf_dir):
    both = scan_matching(
        spark,
        sf_dir,
        "benchmark,doc*,c*,-customer,pag*,absent",
        closed=["pages"],
        ignore_unavailable=True,
        columns={"conversations": {"conv_id": "doc_id"}, "benchmark": {"item_id": "doc_id"}},
    )
    cells = Collection(both, ("_index", "doc_id", "turn")).vectorize_all(text_spec("term_freq"))
    return by_key(cells)


def _several(spark, sf_dir):
    both = scan_indices(
        spark,
        {"documents": f"{sf_dir}/documents.parquet", "items": f"{sf_dir}/benchmark.parquet"},
        columns={"items": {"item_id": "doc_id"}},
    )
    return Collection(both, ("_index", "doc_id"))


@query
def one_of_several(spark, sf_dir):
    """A document of several collections, named by collection and id."""
    found = _several(spark, sf_dir).vectorize(text_spec("term_freq"), ("items", 7))
    return found.withColumn("matrix", F.to_json("matrix"))


@query
def sample_of_several(spark, sf_dir):
    keys = ["_index", "doc_id"]
    page = _several(spark, sf_dir).search_vectorize(text_spec("term_freq"), sort=[random_order(keys, SEED)], size=60)
    return page.docs.select(*keys, "row", F.size("cells").alias("n_cells"))


@query
def split_of_several(spark, sf_dir):
    return learning.hash_split(_several(spark, sf_dir).df.select("_index", "doc_id"), ["_index", "doc_id"], seed=SEED)


# -- streams -------------------------------------------------------------------------------------------
def _stream(spark, sf_dir):
    schema = table(spark, sf_dir, "documents").schema
    # A pattern, since a stream's path must be a folder otherwise: the table may be one file or a folder of files.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")


@query
def stream_vectorize(spark, sf_dir):
    out = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"
    cells = live.vectorize_stream(_stream(spark, sf_dir), text_spec("term_freq"))
    started = cells.writeStream.format("parquet").option("checkpointLocation", f"{out}/progress")
    started.trigger(availableNow=True).start(f"{out}/docs").awaitTermination()
    return matrix.coo(spark.read.parquet(f"{out}/docs"), ["doc_id"])


@query
def stream_batches(spark, sf_dir):
    out = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"
    spec = text_spec("doc_freq")
    live.vectorize_batches(
        _stream(spark, sf_dir),
        spec,
        f"{out}/coo",
        f"{out}/progress",
        corpus=documents(spark, sf_dir),
    ).awaitTermination()
    read = spark.read.parquet(f"{out}/coo")
    return read.withColumn("batch_id", F.col("batch_id").cast("bigint"))


@query
def stream_statistics(spark, sf_dir):
    out = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"
    stats = live.stream_statistics(_stream(spark, sf_dir), "text")
    live.keep_statistics(stats, f"{out}/stats", f"{out}/progress").awaitTermination()
    return live.stored_statistics(spark, f"{out}/stats").select("term", "doc_freq", "ttf")


@query
def stored_statistics_matrix(spark, sf_dir):
    """Columns of corpus statistics from a stored table instead of a pass over the corpus."""
    docs = collection(spark, sf_dir)
    stored = settle(term_stats.term_stats(docs.df, ["text"], KEYWORDS))
    return by_key(docs.vectorize_all(text_spec("ttf"), statistics=stored))


@query
def joined_dictionary(spark, sf_dir):
    """A dictionary beyond the broadcast limit: every term of the corpus is a column.

    The columns follow the terms in order; each of them holds the document frequency.
    """
    docs = documents(spark, sf_dir)
    # Terms and their frequencies come from one pass over the texts.
    stats = settle(term_stats.doc_freq(docs, "text").withColumn("field", F.lit("text")))
    words = row_index(stats.select("term"), ["term"], "col")
    cells = Collection(docs, mapping=KEYWORDS).from_dictionary("text", words, "doc_freq", statistics=stats)
    return matrix.coo(cells, ["doc_id"])


@query
def merged_statistics_batches(spark, sf_dir):
    """Running statistics, merged over their epochs, as the only source of a stream's columns."""
    out = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"
    stats = live.stream_statistics(_stream(spark, sf_dir), "text")
    live.keep_statistics(stats, f"{out}/stats", f"{out}/one").awaitTermination()
    merged = live.merge_statistics(spark, f"{out}/stats", f"{out}/merged")
    live.vectorize_batches(
        _stream(spark, sf_dir), text_spec("ttf"), f"{out}/coo", f"{out}/two", statistics=merged
    ).awaitTermination()
    return spark.read.parquet(f"{out}/coo").withColumn("batch_id", F.col("batch_id").cast("bigint"))


N_CHANGES = 5


def _changes(spark, sf_dir):
    """Documents, then new versions, deletions and late old versions, one file after the other."""
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    longer = F.concat(F.substring("text", 1, 200), F.lit(" sent again"))
    steps = [
        docs.select("doc_id", F.lit(1).alias("version"), F.lit(False).alias("deleted"), "text"),
        docs.where("lang = 'en'").select("doc_id", F.lit(3).alias("version"), F.lit(False).alias("deleted"), longer.alias("text")),
        docs.where("lang = 'fr'").select("doc_id", F.lit(2).alias("version"), F.lit(True).alias("deleted"), F.lit(None).cast("string").alias("text")),
        docs.where("lang <> 'es'").select("doc_id", F.lit(0).alias("version"), F.lit(False).alias("deleted"), F.lit("too late").alias("text")),
        docs.where("lang = 'de'").select("doc_id", F.lit(1).alias("version"), F.lit(False).alias("deleted"), "text"),
    ]
    path = f"{scratch_dir(spark)}/changes-{uuid.uuid4().hex}"
    for step in steps:
        step.write.mode("append").parquet(path)
    return path


def _changed_statistics(spark, sf_dir):
    path = _changes(spark, sf_dir)
    schema = "doc_id bigint, version int, deleted boolean, text string"
    # Two of the changes at a time: more epochs with every further file would outgrow the input.
    a_change = math.ceil(len(spark.read.schema(schema).parquet(path).inputFiles()) / N_CHANGES)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2 * a_change).parquet(path)
    signed = changes.signed_statistics(stream, "text")
    out = f"{path}-out"
    changes.keep_changes(signed, f"{out}/signed", f"{out}/progress").awaitTermination()
    return changes.current_statistics(spark, f"{out}/signed")


@query
def changed_statistics(spark, sf_dir):
    """Statistics over documents that are sent again, deleted, or late."""
    return _changed_statistics(spark, sf_dir)


@query
def changed_matrix(spark, sf_dir):
    """Columns of the changed statistics fill the matrix of the documents."""
    stats = settle(_changed_statistics(spark, sf_dir))
    return _text_matrix(spark, sf_dir, "doc_freq", statistics=stats)


@query
def latest_documents(spark, sf_dir):
    """The same changes as a table: the last version of every document that is not deleted."""
    table = spark.read.parquet(_changes(spark, sf_dir))
    return changes.latest_versions(table).select("doc_id", "version", F.length("text").cast("bigint").alias("n_chars"))
