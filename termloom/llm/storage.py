"""Where intermediate results go, and how frames reach tasks."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.plans.sizing import scratch_dir

# A null id counts as the last document.
LAST_ID = (1 << 63) - 1


def visible(spark: SparkSession) -> None:
    """Let Python workers find this package where it is not installed, as in a working copy."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    visible(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Only the two columns an operator reads, as ``doc_id`` and ``text``, without nulls."""
    return docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(LAST_ID)).alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def free_prefix(docs: DataFrame) -> str:
    """A beginning for working columns that no column of the frame has, in any case."""
    prefix = "__"
    while any(name.lower().startswith(prefix) for name in docs.columns):
        prefix += "_"
    return prefix


def id_out(column: str = "doc_id") -> Column:
    return F.when(F.col(column) != LAST_ID, F.col(column)).alias(column)


def settle(frame: DataFrame) -> DataFrame:
    """Write a frame to ``spark.checkpoint.dir`` and go on from there."""
    scratch_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)
