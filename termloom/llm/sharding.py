"""Shards by rendezvous hashing: each shard draws a number for a key, and the lowest draw wins.

A draw is an exponential variate with the shard's weight as its rate, made from a hash of key and
shard, so a shard gets keys in proportion to its weight.  Adding a shard changes no other draw:
only the keys that the new shard wins move.  Built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import settle

# Hex digits of a key's hash that name its piece of a shard; slots are numbered piece by piece.
PIECE_DIGITS = 3
# Equal rows are told apart in blocks of so many.
EQUAL_BLOCK = 1 << 16
# 13 hex digits: a whole number that a double holds exactly.
_DRAW_DIGITS = 13


def _hashed(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def draw(key: Column, shard: Column, weight: Column) -> Column:
    """The shard's exponential variate for a key."""
    number = _hashed(F.concat(key, F.lit(":"), shard.cast("string")), _DRAW_DIGITS)
    return -F.log((number + F.lit(0.5)) / F.lit(float(16**_DRAW_DIGITS))) / weight


def choose(key: Column, shards: Sequence[tuple[int, float]]) -> Column:
    """Struct (drawn, shard) of the winning shard; equal draws go to the lower shard number."""
    offered = F.array(*[F.struct(F.lit(int(s)).alias("shard"), F.lit(float(w)).alias("weight")) for s, w in shards])
    drawn = F.transform(
        offered, lambda o: F.struct(draw(key, o["shard"], o["weight"]).alias("drawn"), o["shard"].alias("shard"))
    )
    return F.array_min(drawn)


def numbered(rows: DataFrame, shard: str, key: str, order: Sequence[str], name: str) -> DataFrame:
    """Gapless numbers from 0 inside each shard, without a whole shard in one task.

    A shard is cut into pieces by a hash of key and order, so rows that share a key are divided as
    well.  Equal rows are counted before they are shuffled and share one range of numbers.  Ranges
    are numbered inside their piece; the pieces before it add their counts, of which there are at
    most ``16 ** PIECE_DIGITS`` a shard.  The counted rows are settled, so texts are read once.
    """
    counted = settle(rows.groupBy(*rows.columns).agg(F.count("*").alias("__n")))
    placed = counted.withColumn("__piece", _hashed(F.concat_ws(":", key, *order), PIECE_DIGITS))
    sizes = placed.groupBy(shard, "__piece").agg(F.sum("__n").alias("__n"))
    earlier = Window.partitionBy(shard).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(shard, "__piece", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(shard, "__piece").orderBy(key, *order).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("__before") + F.coalesce(F.sum("__n").over(inside), F.lit(0))
    ranges = placed.join(offsets, [shard, "__piece"]).withColumn("__first", first)
    last_block = F.expr(f"(__n - 1) div {EQUAL_BLOCK}")
    blocks = ranges.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    begin = F.col("__block") * EQUAL_BLOCK
    end = F.least(F.col("__n"), begin + EQUAL_BLOCK) - 1
    each = blocks.withColumn("__at", F.explode(F.sequence(begin, end)))
    return each.withColumn(name, (F.col("__first") + F.col("__at")).cast("bigint")).drop(
        "__piece", "__n", "__before", "__first", "__block", "__at"
    )


def assign(
    docs: DataFrame,
    shards: Sequence[tuple[int, float]],
    key: str = "doc_id",
    text: str = "text",
    overhead: int = 0,
    new_shard: tuple[int, float] | None = None,
) -> DataFrame:
    """Put every row into one of ``shards``, pairs of number and weight above 0.

    Returns ``doc_id, size, text_crc32, shard, slot, grown_shard``: the text's UTF-8 bytes plus
    ``overhead``, its CRC-32, the row's place in the shard, and the shard it would have with
    ``new_shard`` added (null without one).  A null or empty text has no bytes and CRC 0; rows
    with a null key all go to one shard, as do rows that share a key.  Equal rows get different
    slots.  An empty table gives no rows.
    """
    if not shards or any(w <= 0 for _, w in shards) or len({s for s, _ in shards}) < len(shards):
        raise ValueError("shards need distinct numbers and weights above 0")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__key"),
        (F.octet_length(body).cast("bigint") + F.lit(overhead)).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    ).withColumn("__won", choose(F.col("__key"), shards))
    grown = F.lit(None).cast("int")
    if new_shard is not None:
        rival = draw(F.col("__key"), F.lit(int(new_shard[0])), F.lit(float(new_shard[1])))
        grown = F.when(rival < F.col("__won.drawn"), F.lit(int(new_shard[0]))).otherwise(F.col("__won.shard"))
    rows = rows.withColumn("grown_shard", grown.cast("int")).withColumn("shard", F.col("__won.shard").cast("int"))
    placed = numbered(rows.drop("__won"), "shard", "__key", ["size", "text_crc32"], "slot")
    return placed.select("doc_id", "size", "text_crc32", "shard", "slot", "grown_shard")
