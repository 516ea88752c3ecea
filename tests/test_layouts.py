"""Queries over tables that are one file, and over the same tables as a folder of files."""

import random
from pathlib import Path

import pandas as pd
import pytest

from termloom.plans.sizing import scratch_dir
from workload.queries import REGISTRY


@pytest.fixture(scope="module")
def layouts(tmp_path_factory):
    draw = random.Random(5)
    words = "the of and le la was cat dog sun moon tree".split()
    docs = pd.DataFrame(
        [(i, " ".join(draw.choices(words, k=draw.randrange(0, 12))), draw.choice(["en", "fr", "de", "es"])) for i in range(90)],
        columns=["doc_id", "text", "lang"],
    )
    one, many = tmp_path_factory.mktemp("one"), tmp_path_factory.mktemp("many")
    docs.to_parquet(one / "documents.parquet")
    (many / "documents.parquet").mkdir()
    for part in range(6):
        docs[part::6].to_parquet(many / "documents.parquet" / f"part-{part:04d}.parquet")
    return str(one), str(many)


@pytest.mark.parametrize("name", ["stream_vectorize", "stream_batches", "stream_statistics", "merged_statistics_batches"])
def test_a_stream_reads_a_file_and_a_folder_alike(spark, layouts, name):
    one, many = (sorted(map(tuple, REGISTRY[name](spark, sf_dir).collect())) for sf_dir in layouts)
    assert one == many and one


def test_changes_in_many_files_take_no_more_epochs(spark, layouts):
    def epochs():
        return set(Path(scratch_dir(spark).removeprefix("file:")).glob("changes-*-out/signed/epoch=*"))

    rows, taken = [], []
    for sf_dir in layouts:
        before = epochs()
        rows.append(sorted(map(tuple, REGISTRY["changed_statistics"](spark, sf_dir).collect())))
        taken.append(len(epochs() - before))
    assert rows[0] == rows[1] and rows[0]
    assert taken[0] == 3 and taken[1] <= 3


def test_a_joined_dictionary_reads_the_texts_once_more_only(spark, layouts):
    plan = REGISTRY["joined_dictionary"](spark, layouts[0])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
