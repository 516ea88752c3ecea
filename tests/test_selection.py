"""Pages far down an order against sorting everything, and matrices written for other tools."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from termloom import Collection, FeatureSpec, random_order, terms, write_market, write_market_batches
from termloom.operators.search import page_of
from termloom.plans import numbering, selection
from termloom.plans.selection import Order


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(6)
    day = datetime.date(2020, 1, 1)
    return [
        (
            i,
            draw.choice(["a", "b", None, "c"]),
            draw.choice([None, 0.5, float("nan"), -3.0, draw.random()]),
            day + datetime.timedelta(days=draw.randrange(9)) if i % 7 else None,
            7 if i % 3 else draw.randrange(10**6),
        )
        for i in range(4_000)
    ]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, g string, x double, d date, hot int").repartition(7).cache()


@pytest.mark.parametrize(
    "order",
    [
        [Order("k")],
        [Order("k", descending=True)],
        [Order("g", nulls_last=True), Order("k")],
        [Order("g", descending=True), Order("x", nulls_last=True), Order("k")],
        [Order("x"), Order("k")],
        [Order("x", descending=True, nulls_last=True), Order("d"), Order("k", descending=True)],
        [Order("d", nulls_last=True), Order("hot", descending=True), Order("k")],
        [Order("hot"), Order("k")],
    ],
)
@pytest.mark.parametrize("from_, size", [(0, 300), (1_733, 50), (3_950, 500), (5_000, 10)])
def test_pages_equal_sorting(frame, monkeypatch, order, from_, size):
    monkeypatch.setattr(numbering, "TOP_K_ROWS", 40)
    monkeypatch.setattr(selection, "INTERVALS", 8)
    whole = [r["k"] for r in frame.orderBy(*[by.column() for by in order]).collect()]
    got = sorted((r["row"], r["k"]) for r in selection.page(frame, order, from_, size).collect())
    assert [k for _, k in got] == whole[from_ : from_ + size] and [n for n, _ in got] == list(range(len(got)))


def test_pages_of_nothing(frame, monkeypatch):
    monkeypatch.setattr(numbering, "TOP_K_ROWS", 5)
    assert selection.page(frame.limit(0), [Order("k")], 10, 20).count() == 0
    assert selection.page(frame, [Order("k")], 10, 0).count() == 0


def test_little_is_sorted(spark, monkeypatch):
    """Of 60,000 rows only the interval around the page goes into a sort."""
    sorted_rows = []
    usual = numbering.row_index
    monkeypatch.setattr(numbering, "row_index", lambda df, order, name="row": sorted_rows.append(df.count()) or usual(df, order, name))
    frame = spark.range(60_000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("m"))
    order = [Order("m"), Order("k")]
    got = page_of(frame, order, 30_000, 500)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and sorted_rows == []
    expected = [r["k"] for r in frame.orderBy("m", "k").offset(30_000).limit(500).collect()]
    assert [r["k"] for r in sorted(got.collect(), key=lambda r: r["row"])] == expected
    page_of(frame, order, 0, 20_000).count()
    assert sorted_rows and max(sorted_rows) <= 40_000


def test_a_large_sample_equals_the_full_sort(spark, monkeypatch):
    monkeypatch.setattr("termloom.operators.search.TOP_K_ROWS", 50)
    monkeypatch.setattr(numbering, "TOP_K_ROWS", 50)
    frame = spark.range(5_000).select(F.col("id").alias("doc_id"), (F.col("id") % 9).cast("int").alias("n"))
    docs = Collection(frame)
    spec = FeatureSpec.from_spec([{"field": "n", "span": 1}])
    sample = docs.search_vectorize(spec, sort=[random_order("doc_id", 3)], size=700).docs.collect()
    digests = frame.select("doc_id", random_order("doc_id", 3).alias("m")).orderBy("m", "doc_id").limit(700).collect()
    assert [r["doc_id"] for r in sorted(sample, key=lambda r: r["row"])] == [r["doc_id"] for r in digests]


# -- one analysis for condition and relevance -------------------------------------------------------
def test_condition_and_score_share_their_tokens(spark, small):
    docs = Collection(spark.read.parquet(f"{small}/documents.parquet"))
    hits, _ = docs.hits(terms("text", ["the", "la"]), sort=["_score:desc"], relevance=("text", ["the", "la"]))
    assert hits._jdf.queryExecution().executedPlan().toString().count("regexp_extract_all") == 1


# -- matrices for other tools ----------------------------------------------------------------------------
def read_market(lines):
    """Plain reading of the exchange format: sizes and entries."""
    assert lines[0] == "%%MatrixMarket matrix coordinate real general"
    sizes = tuple(map(int, lines[1].split()))
    entries = [(int(r) - 1, int(c) - 1, float(v)) for r, c, v in (line.split() for line in lines[2:])]
    assert len(entries) == sizes[2] and entries == sorted(entries)
    assert all(0 <= r < sizes[0] and 0 <= c < sizes[1] for r, c, _ in entries)
    return sizes, entries


def file_lines(folder):
    return [line for part in sorted(folder.glob("part-*")) for line in part.read_text().splitlines()]


@pytest.fixture(scope="module")
def matrix(spark, small):
    docs = Collection(spark.read.parquet(f"{small}/documents.parquet").repartition(5))
    spec = FeatureSpec.from_spec([{"field": "text", "span": ["the", "de", "of"]}, {"field": "n_chars", "span": 1}])
    return docs.vectorize_all(spec, sort=["n_chars:desc"])


def test_a_whole_matrix_in_parts(matrix, tmp_path, spark):
    write_market(matrix, str(tmp_path / "whole"))
    sizes, entries = read_market(file_lines(tmp_path / "whole"))
    coo = sorted((r["row"], r["col"], r["data"]) for r in matrix.to_coo().collect())
    assert entries == coo and sizes == (matrix.hits.count(), 4, len(coo))


def test_a_file_per_batch(matrix, tmp_path):
    cut = matrix.batches(30)
    write_market_batches(cut, str(tmp_path / "cut"))
    folders = sorted((tmp_path / "cut").glob("batch_id=*"), key=lambda f: int(f.name.split("=")[1]))
    entries, before = [], 0
    for folder in folders:
        assert len(list(folder.glob("part-*"))) == 1
        sizes, own = read_market(file_lines(folder))
        entries += [(r + before, c, v) for r, c, v in own]
        before += sizes[0]
    coo = sorted((r["row"], r["col"], r["data"]) for r in matrix.to_coo().collect())
    assert entries == coo and before == matrix.hits.count()


def test_a_matrix_without_entries(spark, tmp_path):
    docs = Collection(spark.createDataFrame([(1, "x"), (2, None)], "doc_id int, text string"))
    spec = FeatureSpec.from_spec([{"field": "text", "span": ["a", "b"]}])
    write_market(docs.vectorize_all(spec), str(tmp_path / "empty"))
    assert read_market(file_lines(tmp_path / "empty")) == ((2, 2, 0), [])


def test_a_failed_write_leaves_nothing(matrix, tmp_path, spark):
    """A row that cannot be written ends the job; no part of the file is left to be taken for the whole."""
    broken = matrix.docs.withColumn("cells", F.when(F.col("doc_id") < 1e9, F.raise_error(F.lit("broken"))).otherwise(F.col("cells")))
    from dataclasses import replace

    with pytest.raises(Exception, match="broken"):
        write_market_batches(replace(matrix.batches(30), docs=broken.withColumn("batch_id", F.lit(0)).withColumn("row_in_batch", F.lit(0))), str(tmp_path / "bad"))
    assert not list((tmp_path / "bad").rglob("part-*")) and not (tmp_path / "bad" / "_SUCCESS").exists()
