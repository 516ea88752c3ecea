"""Incremental removal of lines that an earlier document holds too.

Two things are kept.  An exact table has every reference of a document to a line key, from which
come the number of documents holding a key and the first of them; sharded cuckoo filters hold the
keys that at least two documents hold.  A line that its shard's filter does not know stays, which
settles most lines; the others are looked up in the exact table.  Filters forget as well as learn,
so deleting documents restores the lines that were dropped because of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cuckoo import CuckooFilter
from .storage import LAST_ID, id_out, id_text, settle

MIN_KEY_CHARS = 10
# Bounds of what one task holds: keys of a filter, and lines looked up in it.
KEYS_PER_SHARD = 1 << 18
LINES_PER_GROUP = 1 << 16
_BLANKS = " \t\n\x0b\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_KEY = ["hi", "lo"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _UPPER, _UPPER.lower())


def references(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """``doc_id, row, pos, hi, lo``: every line with a long enough key, as 128 bits of hashes.

    ``row`` tells rows with the same id and different texts apart.
    """
    rows = id_text(docs, key, text).withColumn("row", F.xxhash64("text"))
    lines = rows.select("doc_id", "row", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc_id", "row", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select(
        "doc_id", "row", "pos", F.xxhash64("key").alias("hi"), F.xxhash64(F.lit("low"), "key").alias("lo")
    )


def repeated_keys(refs: DataFrame) -> DataFrame:
    """``hi, lo, first_doc``: keys of at least two documents.  Counted where the lines are read."""
    counted = refs.groupBy(*_KEY).agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    return counted.where("first_doc < last_doc").drop("last_doc")


def _in_shard(shards: int) -> Column:
    return F.pmod("lo", F.lit(shards)).cast("int")


def _build(keys: pa.Table) -> pa.Table:
    values = keys.column("hi").to_numpy()
    found = CuckooFilter(len(values))
    found.add(values)
    return pa.table({"shard": pa.array([keys.column("shard")[0].as_py()], pa.int32()), "filter": [found.to_bytes()]})


def build_filters(repeated: DataFrame, shards: int) -> DataFrame:
    """``shard, filter``: one cuckoo filter for each shard that has keys."""
    placed = repeated.select("hi", _in_shard(shards).alias("shard"))
    return placed.groupBy("shard").applyInArrow(_build, "shard int, filter binary")


def _change(filters: pa.Table, changes: pa.Table) -> pa.Table:
    found = CuckooFilter.from_bytes(filters.column("filter")[0].as_py()) if filters.num_rows else None
    shard = (filters if filters.num_rows else changes).column("shard")[0].as_py()
    values, added = changes.column("hi").to_numpy(), changes.column("added").to_numpy(zero_copy_only=False)
    found = found or CuckooFilter(len(values))
    found.remove(values[~added])
    found.add(values[added])
    return pa.table({"shard": pa.array([shard], pa.int32()), "filter": [found.to_bytes()]})


def _probe(lines: pa.Table, filters: pa.Table) -> pa.Table:
    lines = lines.select(["doc_id", "row", "pos", "hi", "lo"])
    if not filters.num_rows or not lines.num_rows:
        return lines.slice(0, 0)
    known = CuckooFilter.from_bytes(filters.column("filter")[0].as_py()).contains(lines.column("hi").to_numpy())
    return lines.filter(pa.array(known))


def probe(refs: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """The lines whose shard's filter knows their key.

    Lines meet their filter in groups of about ``LINES_PER_GROUP``: a shard with a very frequent
    line has many groups, each with a copy of the filter.
    """
    placed = refs.withColumn("shard", _in_shard(shards))
    groups = placed.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(LINES_PER_GROUP)).cast("int").alias("groups"))
    # one row per shard, each standing for KEYS_PER_SHARD repeated keys
    groups = settle(groups)
    salt = F.pmod(F.xxhash64("doc_id", "pos"), F.col("groups")).cast("int")
    lines = placed.join(F.broadcast(groups), "shard").withColumn("salt", salt).drop("groups")
    copies = filters.join(groups, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt"), "filter"
    )
    joined = lines.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt"))
    return joined.applyInArrow(_probe, "doc_id bigint, row bigint, pos int, hi bigint, lo bigint")


@dataclass(frozen=True)
class LineIndex:
    """What is known of a corpus: all references, the repeated keys, and filters of those."""

    refs: DataFrame
    repeated: DataFrame
    filters: DataFrame
    shards: int

    @classmethod
    def build(cls, docs: DataFrame, key: str = "doc_id", text: str = "text") -> LineIndex:
        refs = settle(references(docs, key, text))
        repeated = settle(repeated_keys(refs))
        shards = max(1, -(-repeated.count() // KEYS_PER_SHARD))
        return cls(refs, repeated, settle(build_filters(repeated, shards)), shards)

    def insert(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> LineIndex:
        """The index with further documents."""
        more = settle(references(docs, key, text))
        # Both parts are written; those known are not written again.
        return self._changed(self.refs.unionAll(more), more)

    def delete(self, ids: DataFrame, key: str = "doc_id") -> LineIndex:
        """The index without the documents of ``ids``."""
        gone = ids.select(F.coalesce(F.col(key).cast("bigint"), F.lit(LAST_ID)).alias("doc_id")).distinct()
        rest = settle(self.refs.join(gone, "doc_id", "left_anti"))
        return self._changed(rest, self.refs.join(gone, "doc_id", "left_semi"))

    def _changed(self, refs: DataFrame, touched: DataFrame) -> LineIndex:
        keys = settle(touched.select(*_KEY).distinct())
        counted = settle(repeated_keys(refs.join(keys, _KEY, "left_semi")))
        before = self.repeated.join(keys, _KEY, "left_semi")
        added = counted.join(before, _KEY, "left_anti").withColumn("added", F.lit(True))
        removed = before.join(counted, _KEY, "left_anti").withColumn("added", F.lit(False))
        changes = added.unionByName(removed).select("hi", "added", _in_shard(self.shards).alias("shard"))
        repeated = settle(self.repeated.join(keys, _KEY, "left_anti").unionByName(counted))
        needed = -(-repeated.count() // KEYS_PER_SHARD)
        if needed > self.shards:
            # The keys have outgrown their filters: more of them, with room to grow.
            return LineIndex(refs, repeated, settle(build_filters(repeated, 2 * needed)), 2 * needed)
        filters = self.filters.groupBy("shard").cogroup(changes.groupBy("shard"))
        filters = settle(filters.applyInArrow(_change, "shard int, filter binary"))
        return LineIndex(refs, repeated, filters, self.shards)

    def dropped(self, refs: DataFrame | None = None) -> DataFrame:
        """``doc_id, row, dropped``: per row the numbers of the lines that an earlier document holds.

        Equal rows give each number once, however many they are.
        """
        likely = probe(self.refs if refs is None else refs, self.filters, self.shards)
        late = likely.join(self.repeated, _KEY).where("doc_id > first_doc")
        return late.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("dropped"))


def without_repeats(
    docs: DataFrame, index: LineIndex, key: str = "doc_id", text: str = "text", prefix: str = "__"
) -> DataFrame:
    """Every row with its remaining text: ``id, row, n_lines, n_dropped, kept``, named with the prefix, beside its columns."""
    id_, row, gone_, lines = (f"{prefix}{name}" for name in ("id", "row", "gone", "lines"))
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select("*", F.coalesce(F.col(key).cast("bigint"), F.lit(LAST_ID)).alias(id_), F.xxhash64(whole).alias(row))
    gone = index.dropped().select(F.col("doc_id").alias(id_), F.col("row").alias(row), F.col("dropped").alias(gone_))
    joined = rows.join(gone, [id_, row], "left").withColumn(lines, F.split(whole, "\n", -1))
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    rest = F.when(F.col(gone_).isNull(), numbers).otherwise(F.array_except(numbers, F.col(gone_)))
    kept = F.transform(rest, lambda i: F.get(F.col(lines), i))
    return joined.withColumns({
        f"{prefix}n_lines": F.size(lines).cast("bigint"),
        f"{prefix}n_dropped": (F.size(lines) - F.size(rest)).cast("bigint"),
        f"{prefix}kept": F.when(F.col(gone_).isNull(), whole).otherwise(F.array_join(kept, "\n")),
    }).drop(gone_, lines)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` for every row.

    A line's key is the line without ASCII blanks at its ends, A-Z lower-cased.  Of a key of at
    least ``MIN_KEY_CHARS`` characters that two documents hold, only the document with the
    smallest id keeps its lines, all of them.  A null or empty text is one empty line, a null id
    comes last, rows with the same id are one document, and an empty table gives no rows.
    """
    rows = without_repeats(docs.select(F.col(key), F.col(text)), LineIndex.build(docs, key, text), key, text)
    return rows.select(
        F.col("__id").alias("doc_id"),
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.col("__kept"), 256).alias("kept_sha256"),
    ).withColumn("doc_id", id_out())
