"""Statistics of documents that change while the stream runs: new versions, re-sent ones and deletions.

The state holds, for each document, its version and its terms.  A later version gives signed counts, what it
adds less what the one before held; a deletion takes all of them back and leaves the version alone, so that
what arrives late stays without effect.  A call of the state function costs far more than the counting of a
document, so documents share it by the hash of their key, and their states lie packed in one value.  Texts are
analyzed before the state, in the JVM; each epoch's counts are summed up and written to a folder of their own,
and the sum over all folders is the present state.
"""

from __future__ import annotations

import json
import pickle
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.text import FieldMapping, term_counts

_STATE = "documents binary"
_SIGNED = "moves string"
# Groups of documents that share a state.  The packed states of one group are in memory at a time, and an epoch
# writes those groups anew that it touches.
GROUPS = 512
# Moved terms in one row that leaves the state function: rows cost it far more than text does.
_MOVES = 10_000


def latest_versions(
    changes: DataFrame, key: str | list[str] = "doc_id", version: str = "version", deleted: str = "deleted"
) -> DataFrame:
    """Of a table of changes, the last version of every document that is not deleted."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in changes.columns if c not in keys]
    fields = [F.col(version), F.coalesce(deleted, F.lit(False)).alias("__gone"), F.struct(*rest).alias("__row")]
    last = changes.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("__last"))
    return last.where(~F.col("__last.__gone")).select(*keys, "__last.__row.*")


def signed_statistics(
    changes: DataFrame,
    field: str,
    key: str | list[str] = "doc_id",
    version: str = "version",
    deleted: str = "deleted",
    mapping: FieldMapping = FieldMapping(),
    groups: int = GROUPS,
) -> DataFrame:
    """A stream of ``(field, term, doc_freq, ttf)``: how the changes move the counts of their terms.

    ``version`` orders the changes of one document, in whatever order they arrive; a version that
    is not above the known one changes nothing.  Of two rows with one version a deletion counts, else the
    greater list of terms.  Key columns may be null; a null version is below all others.  ``groups`` must stay
    the same for one checkpoint.
    """
    keys = [key] if isinstance(key, str) else list(key)
    gone = F.coalesce(F.col(deleted), F.lit(False))
    counted = F.map_from_entries(term_counts(mapping.tokens(changes, field)))
    # Strings, since Arrow converts the lists of a whole batch again for every group of it.
    name = F.to_json(F.array(*[_name(changes, k) for k in keys]))
    slim = changes.select(
        F.pmod(F.xxhash64(name), F.lit(groups)).alias("group"),
        name.alias("key"),
        F.coalesce(F.col(version).cast("bigint"), F.lit(-(1 << 63))).alias("version"),
        gone.alias("gone"),
        F.when(~gone, F.to_json(counted)).alias("counts"),
    )

    def change(_: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last: dict[str, tuple] = {}
        for part in rows:
            for key, number, off, counts in zip(*(part[c].tolist() for c in ("key", "version", "gone", "counts"))):
                row = number, off, {} if off else json.loads(counts)
                had = last.get(key)
                if had is None or (row[:2], list(row[2])) > (had[:2], list(had[2])):
                    last[key] = row
        known = pickle.loads(zlib.decompress(state.get[0])) if state.exists else {}
        moved: dict[str, list[int]] = {}
        later = False
        for key, (number, _, has) in last.items():
            before, had = known.get(key, (None, {}))
            if before is not None and number <= before:
                continue
            known[key], later = (number, has), True
            for sign, side, other in ((1, has, had), (-1, had, has)):
                for term, n in side.items():
                    if other.get(term) != n:
                        move = moved.setdefault(term, [0, 0])
                        move[0] += sign
                        move[1] += sign * n
        if later:
            state.update((zlib.compress(pickle.dumps(known), 1),))
        if moved:
            listed = list(moved.items())
            parts = [json.dumps(dict(listed[at : at + _MOVES])) for at in range(0, len(listed), _MOVES)]
            yield pd.DataFrame({"moves": parts})

    moves = slim.groupBy("group").applyInPandasWithState(change, _SIGNED, _STATE, "append", GroupStateTimeout.NoTimeout)
    signed = moves.select(F.explode(F.from_json("moves", "map<string, array<bigint>>")).alias("term", "n"))
    return signed.select(F.lit(field).alias("field"), "term", F.get("n", F.lit(0)).alias("doc_freq"), F.get("n", F.lit(1)).alias("ttf"))


def _name(df: DataFrame, key: str) -> Column:
    """A key column as text, equal only for equal keys; null stays null."""
    kind, value = df.schema[key].dataType, F.col(key)
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (value + F.lit(0.0)).cast("string")
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.to_json(F.struct(value))
    return value.cast("string")


def keep_changes(signed: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Store the signed counts: every epoch adds what it changed, in a folder that a repeated epoch replaces."""

    def write(batch: DataFrame, epoch: int) -> None:
        _summed(batch).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    started = signed.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return started.trigger(**(trigger or {"availableNow": True})).start()


def _summed(signed: DataFrame) -> DataFrame:
    return signed.groupBy("field", "term").agg(F.sum("doc_freq").alias("doc_freq"), F.sum("ttf").alias("ttf"))


def current_statistics(spark: SparkSession, path: str) -> DataFrame:
    """``(field, term, doc_freq, ttf)`` of the last versions of all documents, from what is stored.

    It serves as ``statistics`` of :func:`.live.vectorize_batches` and of ``Collection.vectorize_all``.
    """
    return _summed(spark.read.parquet(path)).where(F.col("doc_freq") > 0)
