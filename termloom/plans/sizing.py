"""Decisions that depend on size: what may be broadcast, how hot keys are split, where to settle."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound of anything this library broadcasts on its own; beyond it a salted join is used.
BROADCAST_LIMIT_BYTES = 64 << 20


def salts(spark: SparkSession) -> int:
    """How many tasks the rows of one key are split into: the root of the number of shuffle tasks.

    Splitting costs a copy of the small side per part, so parts grow with the cluster but slower;
    adaptive execution splits what is still too large.
    """
    return max(2, math.isqrt(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) - 1)) + 1)


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get("termloom.broadcast.limit", str(BROADCAST_LIMIT_BYTES)))


def vocabulary_bytes(terms: list[str]) -> int:
    """Generous size of a term dictionary on an executor: characters plus object overhead."""
    return sum(2 * len(t) + 120 for t in terms)


def plan_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a frame, or None where the session does not tell."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def fits_broadcast(df: DataFrame) -> bool:
    """Whether a frame is surely below the broadcast limit, by Catalyst's estimate.

    Stored columns are compressed, hence the margin.
    """
    size = plan_bytes(df)
    return size is not None and size * 8 <= broadcast_limit(df.sparkSession)


def kept_by(df: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """Leave out rows without a partner in a small ``side``, before any costly work on them.

    A large ``side`` changes nothing here: the join that follows drops those rows.
    """
    if not fits_broadcast(side):
        return df
    return df.join(F.broadcast(side.select(*keys)), keys, "left_semi")


def settle(df: DataFrame) -> DataFrame:
    """Write a frame to the cluster's checkpoint folder and go on from there.

    Needed where two passes must see the very same partitions, also after an executor is lost.
    """
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="termloom-"))
    return context.getCheckpointDir()


def salted_join(
    big: DataFrame, small: DataFrame, keys: list[str], spread_by: Column, how: str = "inner"
) -> DataFrame:
    """Equi-join in which no key value lands in one task; null keys meet each other.

    Rows of ``big`` with the same key are divided over ``salts`` tasks by ``spread_by``;
    ``small`` holds each key once and is replicated to each of them.
    """
    parts = salts(big.sparkSession)
    theirs = {k: f"__their_{k}" for k in keys}
    copies = F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<bigint>")
    replicated = small.withColumnsRenamed(theirs).withColumn("__copy", F.explode(copies))
    salted = big.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(parts)))
    same = F.col("__salt") == F.col("__copy")
    for ours, their in theirs.items():
        same = same & F.col(ours).eqNullSafe(F.col(their))
    return salted.join(replicated, same, how).drop("__salt", "__copy", *theirs.values())
