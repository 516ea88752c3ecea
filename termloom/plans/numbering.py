"""Consecutive numbers and ranks over a whole distributed frame, without a one-task window."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sizing import salted_join, salts, settle

_IN_PARTITION = (1 << 33) - 1
# Up to this many leading rows are a top-k in the tasks; beyond it rows are numbered.
TOP_K_ROWS = 10_000
# Up to this many rows per group Spark cuts a group before it is shuffled.
GROUP_LIMIT_ROWS = 1_000


def row_index(df: DataFrame, order: list[Column | str], name: str = "row") -> DataFrame:
    """Number the rows 0, 1, 2, ... in the order of ``order``, which must end in a unique key.

    One range exchange, a sort inside each partition, and one offset per partition.  Call it
    with key columns only: everything in ``df`` is moved and written once.
    """
    at = F.monotonically_increasing_id()  # partition number in the upper bits, position below
    placed = settle(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", at)
    )
    part = F.shiftrightunsigned("__at", 33)
    offsets = _offsets(placed, part, F.count("*"))
    number = F.col("__before") + F.col("__at").bitwiseAND(F.lit(_IN_PARTITION))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, number)
        .drop("__part", "__before", "__at")
    )


def sum_before(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Add to each row the sum of ``value`` over all rows with a smaller unique ``key``."""
    placed = settle(df.repartitionByRange(key).withColumn("__part", F.spark_partition_id()))
    offsets = _offsets(placed, F.col("__part"), F.sum(value))
    inside = Window.partitionBy("__part").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, (F.col(name) + F.col("__before")).cast("bigint"))
        .drop("__part", "__before")
    )


def _offsets(placed: DataFrame, part: Column, total: Column) -> DataFrame:
    # One row per partition of a settled frame: its number is bounded by the partition count.
    sums = placed.groupBy(part.cast("bigint").alias("p")).agg(total.alias("t")).collect()
    sums.sort(key=lambda r: r["p"])
    before = accumulate([0] + [r["t"] for r in sums[:-1]]) if sums else []
    rows = [(r["p"], b) for r, b in zip(sums, before)]
    return placed.sparkSession.createDataFrame(rows, "__part bigint, __before bigint")


def first_rows(df: DataFrame, order: list[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows: a top-k in the tasks if they are few, else by their row numbers."""
    if k <= TOP_K_ROWS:
        return df.orderBy(*order).limit(k)
    return row_index(df, order, "__number").where(F.col("__number") < k).drop("__number")


def top_per_group(
    df: DataFrame, group: list[str], order: list[Column], k: int, spread_by: list[str], name: str
) -> DataFrame:
    """The first ``k`` rows of each group with their rank from 1, none of which lands in one task.

    For a small ``k`` salted parts of a group are cut to ``k`` rows first, and only those meet.
    For a large one all rows are numbered in the order of group and rank; a rank is then the
    distance from the group's first number.
    """
    if k > GROUP_LIMIT_ROWS:
        numbered = row_index(df, [*(F.col(g) for g in group), *order], "__number")
        starts = numbered.groupBy(*group).agg(F.min("__number").alias("__start"))
        ranked = salted_join(numbered, starts, group, F.col("__number"))
        ranked = ranked.withColumn(name, (F.col("__number") - F.col("__start") + 1).cast("int"))
        return ranked.where(F.col(name) <= k).drop("__number", "__start")
    parts_of = F.pmod(F.xxhash64(*spread_by), F.lit(salts(df.sparkSession)))
    salted = df.withColumn("__salt", parts_of)
    parts = Window.partitionBy(*group, "__salt").orderBy(*order)
    whole = Window.partitionBy(*group).orderBy(*order)
    cut = salted.withColumn(name, F.row_number().over(parts)).where(F.col(name) <= k)
    ranked = cut.withColumn(name, F.row_number().over(whole)).where(F.col(name) <= k)
    return ranked.drop("__salt")
