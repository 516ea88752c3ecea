"""Every registered query beside its SQL twin, on the smallest tables."""

import pytest
from compare import duck, duck_rows, kinds, spark_rows

import __spark_entry__ as contract
from workload import oracle
from workload.queries import REGISTRY

# Empty on the smallest tables: it asks for a page further back than they reach.
EMPTY = {"deep_page"}


@pytest.fixture(scope="module")
def db(small):
    return duck(small)


def test_every_query_but_the_learned_ones_has_a_twin():
    missing = set(REGISTRY) - set(oracle.oracle_sql())
    assert missing == {"svc_predictions", "svc_accuracy"}
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query(spark, small, db, name):
    frame = contract.queries()[name](spark, small)
    sql = contract.oracle_sql()[name]
    columns, rows = spark_rows(frame)
    assert (columns, rows) == duck_rows(db, sql)
    assert rows or name in EMPTY
    ours, theirs = kinds(frame, db, sql)
    assert ours == theirs


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["row", "col", "data"] and frame.count() > 0


def test_learning_beats_the_majority(spark, small):
    row = contract.queries()["svc_accuracy"](spark, small).first()
    labels = spark.read.parquet(f"{small}/labels.parquet")
    majority = labels.where("toxic = 0").count() / labels.count()
    assert row["n_rows"] > 0 and row["accuracy"] >= majority
