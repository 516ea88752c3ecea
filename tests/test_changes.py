"""Statistics of documents that change while a stream runs."""

import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from termloom import FeatureSpec, FieldMapping, url_email_analyzer
from termloom.operators.term_stats import term_stats
from termloom.streaming import changes, live

SCHEMA = "doc_id bigint, version int, deleted boolean, text string"


def run(spark, tmp_path, files, stop_after=None, **options):
    """Each file is one epoch; with ``stop_after`` the stream is started again after so many files."""
    source, out = tmp_path / uuid.uuid4().hex, tmp_path / uuid.uuid4().hex
    source.mkdir()
    parts = [files] if stop_after is None else [files[:stop_after], files[stop_after:]]
    schema = options.pop("schema", SCHEMA)
    for part in parts:
        for rows in part:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        signed = changes.signed_statistics(stream, "text", **options)
        changes.keep_changes(signed, str(out / "signed"), str(out / "progress")).awaitTermination()
    return changes.current_statistics(spark, str(out / "signed"))


def plain(files):
    """The last version of every document, and the statistics of its terms."""
    last = {}
    for rows in files:
        for key, version, deleted, text in sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], bool(r[2]), r[3] or "")):
            rank = -1 if version is None else version
            if key not in last or rank > last[key][0]:
                last[key] = (rank, None if deleted else text or "")
    doc_freq, ttf = Counter(), Counter()
    for _, text in last.values():
        words = Counter((text or "").lower().split())
        doc_freq.update(words.keys())
        ttf.update(words)
    return sorted((t, doc_freq[t], ttf[t]) for t in doc_freq)


def rows_of(stats):
    return sorted((r["term"], r["doc_freq"], r["ttf"]) for r in stats.collect())


FILES = [
    [(1, 1, False, "a b b"), (2, 1, False, "b c"), (3, 1, None, "x x x")],
    [(1, 1, False, "a b b"), (2, 2, False, "b d"), (4, 1, False, None)],
    [(3, 2, True, None), (1, 3, False, "a"), (1, 2, False, "never seen"), (None, 1, False, "b")],
    [(3, 1, False, "late"), (1, 4, True, "gone too"), (5, None, False, "e e"), (5, None, False, "e e")],
    [(1, 5, False, "back b"), (5, 0, False, "f"), (None, 2, False, "b g")],
]


@pytest.mark.parametrize("stop_after", [None, 2])
def test_last_versions_count(spark, tmp_path, stop_after):
    assert rows_of(run(spark, tmp_path, FILES, stop_after)) == plain(FILES)


def test_all_changes_in_one_epoch(spark, tmp_path):
    whole = [[row for rows in FILES for row in rows]]
    assert rows_of(run(spark, tmp_path, whole)) == plain(whole)


def test_random_changes(spark, tmp_path):
    draw = random.Random(8)
    words = list("abcdefgh")
    files = [
        [(draw.randrange(12), v * 100 + i, draw.random() < 0.2, " ".join(draw.choices(words, k=draw.randrange(5)))) for i in range(15)]
        for v in draw.sample(range(4), 4)
    ]
    found = run(spark, tmp_path, files)
    assert rows_of(found) == plain(files)
    # The same as a table of changes, and by the statistics of a corpus.
    table = spark.createDataFrame([r for f in files for r in f], SCHEMA)
    now = changes.latest_versions(table)
    assert rows_of(term_stats(now, ["text"])) == rows_of(found)


def test_several_keys_and_an_analyzer(spark, tmp_path):
    files = [
        [("x", 1, 1, False, "The sun is up"), ("y", 1, 1, False, "sun")],
        [("x", 1, 2, False, "no moon"), ("y", 1, 2, True, "sun")],
    ]
    found = run(
        spark, tmp_path, files, key=["site", "doc_id"], mapping=FieldMapping(default=url_email_analyzer()),
        schema="site string, " + SCHEMA,
    )
    assert rows_of(found) == [("moon", 1, 1)]


def test_a_repeated_epoch_replaces_its_counts(spark, tmp_path):
    signed = spark.createDataFrame([("text", "a", 1, 2), ("text", "a", -1, -1), ("text", "b", 0, 0)], "field string, term string, doc_freq bigint, ttf bigint")
    for _ in range(2):
        changes._summed(signed).write.mode("overwrite").parquet(str(tmp_path / "epoch=0"))
    assert rows_of(changes.current_statistics(spark, str(tmp_path))) == []


def test_they_serve_as_statistics_of_a_stream(spark, tmp_path):
    stats = run(spark, tmp_path, FILES)
    source = tmp_path / "docs"
    spark.createDataFrame([(7, "b b d")], "doc_id bigint, text string").write.parquet(str(source))
    stream = spark.readStream.schema("doc_id bigint, text string").parquet(str(source))
    spec = FeatureSpec.from_spec([{"field": "text", "span": ["b", "d", "nope"], "value": "ttf"}])
    live.vectorize_batches(stream, spec, str(tmp_path / "coo"), str(tmp_path / "p"), statistics=stats).awaitTermination()
    cells = spark.read.parquet(str(tmp_path / "coo")).select("col", F.col("data").cast("int")).collect()
    known = {t: n for t, _, n in plain(FILES)}
    assert sorted(map(tuple, cells)) == [(0, known["b"]), (1, known["d"])]
