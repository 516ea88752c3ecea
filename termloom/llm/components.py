"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import settle


def _large_star(links: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node around."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _digest(links: DataFrame) -> tuple:
    sums = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), sums).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; the root is the component's least node.

    Links are turned into stars around ever smaller nodes until nothing changes, which takes a
    number of rounds logarithmic in the longest path.  Each round is settled in shared storage.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    links = settle(ordered)
    before = _digest(links)
    while before[0]:
        links = settle(_small_star(_large_star(links)))
        after = _digest(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
