"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``value`` is the sum of the warm times.  ``cold`` is the first run of each query, ``rates`` the
throughput of the warm one.  The test table of documents is a single row group, which one task
reads; it is laid out in as many files as there are cores before anything is timed.  ``as_given``
are warm times over the table as it is, one task reading all texts, so that what the layout gains
is told apart from what the code gains.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from termloom import Collection, FeatureSpec  # noqa: E402
from termloom.operators import significance, term_stats  # noqa: E402
from termloom.session import local_session  # noqa: E402
from workload.queries import KEYWORDS, REGISTRY, documents, labelled, table  # noqa: E402

GIVEN_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
WIDTHS = (10, 600, 6000)
PER_CLASS = 3000
SCAN_SIZE = 1000
REGISTERED = (
    "term_vectors",
    "global_stats",
    "vec_term_freq",
    "vec_doc_freq",
    "significant_terms",
    "labelled_matrix",
    "dict_matrix",
    "relevance_topk",
    "sorted_page",
    "search_page",
    "one_document",
    "scroll_batches",
    "concat_batches",
)
# Queries whose time is mostly that of reading and analyzing the texts.
AS_GIVEN = ("coo_600", "dict_600", "term_vectors", "global_stats", "vec_term_freq", "relevance_topk", "dict_matrix")


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def laid_out(spark, given: str) -> str:
    """The same tables, with documents in several files."""
    folder = tempfile.mkdtemp(prefix="bench-")
    for path in Path(given).iterdir():
        if path.name != "documents.parquet":
            (Path(folder) / path.name).symlink_to(path)
    docs = spark.read.parquet(f"{given}/documents.parquet")
    docs.repartition(int(CPUS), "doc_id").write.parquet(f"{folder}/documents.parquet")
    return folder


def named_actions(spark, sf_dir: str, terms: list[str]) -> dict:
    """What is timed over the tables of a folder, but for the classifier."""
    docs = documents(spark, sf_dir)
    actions = {}
    for width in WIDTHS:
        spec = FeatureSpec.from_spec([{"field": "text", "span": terms[:width], "value": "term_freq"}])
        matrix = Collection(docs, mapping=KEYWORDS).vectorize_all
        actions[f"coo_{width}"] = lambda spec=spec, matrix=matrix: run(matrix(spec).to_coo())
        actions[f"dict_{width}"] = lambda spec=spec, matrix=matrix: run(matrix(spec).to_dict())
    spec = FeatureSpec.from_spec([{"field": "text", "span": terms[:600]}])
    actions["scan_600"] = lambda: run(Collection(docs, mapping=KEYWORDS).scan(spec, SCAN_SIZE))
    actions[f"significant_by_class_{PER_CLASS}"] = lambda: run(
        significance.significant_terms_by_class(
            docs, "toxic", "text", PER_CLASS, side=table(spark, sf_dir, "labels")
        )
    )
    for name in REGISTERED:
        actions[name] = lambda name=name: run(REGISTRY[name](spark, sf_dir))
    return actions


def main() -> None:
    spark = local_session(CPUS, "bench")
    spark.sparkContext.setLogLevel("OFF")
    sf_dir = laid_out(spark, GIVEN_DIR)
    docs = documents(spark, sf_dir)
    ranked = term_stats.doc_freq(docs, "text").orderBy(F.desc("doc_freq"), "term")
    terms = [r["term"] for r in ranked.limit(max(WIDTHS)).collect()]
    learned = []
    actions = named_actions(spark, sf_dir, terms)
    actions["svc_accuracy"] = lambda: learned.append(REGISTRY["svc_accuracy"](spark, sf_dir).first()["accuracy"])
    cold = {name: timed(action) for name, action in actions.items()}
    warm = {name: timed(action) for name, action in actions.items()}
    given = named_actions(spark, GIVEN_DIR, terms)
    for name in AS_GIVEN:
        given[name]()
    as_given = {name: timed(given[name]) for name in AS_GIVEN}

    n_docs = docs.count()
    rates = {}
    for width in WIDTHS:
        spec = FeatureSpec.from_spec([{"field": "text", "span": terms[:width]}])
        cells = Collection(docs, mapping=KEYWORDS).vectorize_all(spec).docs
        n_cells = cells.agg(F.sum(F.size("cells"))).first()[0]
        took = warm[f"coo_{width}"]
        rates[f"coo_{width}"] = {
            "docs_per_sec": round(n_docs / took),
            "cells_per_sec": round(n_cells / took),
        }
    rates["scan_seconds_per_batch"] = round(warm["scan_600"] / max(1, -(-n_docs // SCAN_SIZE)), 4)
    share = labelled(spark, sf_dir).agg(F.avg((F.col("toxic") == 0).cast("double"))).first()[0]
    report = {
        "metric": "warm_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "as_given": as_given,
        "rates": rates,
        "accuracy": round(learned[-1], 4),
        "majority_share": round(share, 4),
        "sf": Path(GIVEN_DIR).name.removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
