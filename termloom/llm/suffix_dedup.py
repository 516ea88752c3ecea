"""Removal of every byte covered by a string of ``LENGTH`` bytes that also starts earlier.

No single machine can sort all suffixes, so they are dealt out first.  Every window of ``LENGTH``
bytes is filed under its anchor, the first of the grams in it with the least hash: equal
windows have equal anchors and meet, wherever they lie.  Consecutive windows with one anchor in
one place form a run, whose windows all differ.  Equal runs
are settled by comparing hashes: the first stays and all later ones are covered.  What is left are
different runs under one anchor, which may share some windows; their bytes are fetched, put into
blocks of whole anchors, and the equal windows found on the block's Burrows-Wheeler transform.

An anchor with very many different runs (a frequent line between ever different neighbours) is
dissolved: each of its windows is filed under its own hash, so no task gets them all.  The runs of every
anchor are counted for that, over all documents.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.plans.sizing import scratch_dir

from . import buffers, suffixes
from .storage import id_out, id_text

LENGTH = 100
GRAM = 24
# Bytes sorted at once; one anchor has at most some HOT_RUNS runs.
BLOCK_BYTES = 1 << 20
HOT_RUNS = 1 << 15
_OUTSIDE = 0xFF  # occurs in no UTF-8 text
# A row is told apart by its id and ``tag``, the hash of its text; ``at`` is a byte of it.
_RUN = "anchor bigint, run bigint, doc_id bigint, tag bigint, at bigint, size int"
_RUNS = pa.schema(
    [("anchor", pa.int64()), ("run", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int64()), ("at", pa.int64()),
     ("size", pa.int32())]
)
_PLACED = "doc_id bigint, tag bigint, at bigint, size int"
_COVER = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("at", pa.int64()), ("size", pa.int32())])
_FOUND = _COVER.append(pa.field("anchor", pa.int64()))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every ``width`` consecutive ones, from those of 1, 2, 4, ... values."""
    n, reach = len(values) - width + 1, 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[:n], values[width - reach : width - reach + n])


def _anchored(data: np.ndarray, at: np.ndarray, length: int, gram: int):
    """The bytes of some texts, where each begins, all gram hashes, and each window's place and anchor's place."""
    buffer, begins = buffers.separated(data, at, 1, _OUTSIDE)
    none = np.zeros(0, np.int64)
    if len(buffer) < length + 2:
        return buffer, begins, none.astype(np.uint64), none, none
    grams = buffers.gram_hashes(buffer, gram)
    # half of the hash decides, then the place: of equal grams in a window the first is the anchor
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    place = (_least(ranked, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.zeros(len(buffer) + 1, np.int8)
    long = np.flatnonzero(np.diff(at) >= length)
    # Texts are parted, so no two of these edges fall on one byte.
    edge[begins[long]] += 1
    edge[begins[long] + np.diff(at)[long] - length + 1] -= 1
    windows = np.flatnonzero(np.cumsum(edge, dtype=np.int8)[: len(place)])
    return buffer, begins, grams, windows, place[windows]


def _first_windows(windows: np.ndarray, place: np.ndarray) -> np.ndarray:
    new = np.ones(len(windows), bool)
    new[1:] = (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)
    return new


def _runs(data: np.ndarray, at: np.ndarray, length: int, gram: int, hot: np.ndarray):
    """Row, start, size, anchor and hash of the runs of some texts."""
    buffer, begins, grams, windows, place = _anchored(data, at, length, gram)
    if not len(windows):
        return windows, windows, windows, grams[:0], grams[:0]
    hashes = buffers.RangeHash(buffer)
    anchors = grams[place]
    new = _first_windows(windows, place)
    if len(hot):
        new |= np.isin(_slots(anchors), hot)
    first = np.flatnonzero(new)
    start, size = windows[first], np.diff(np.append(first, len(windows))) + length - 1
    anchor, run = anchors[first], hashes.of(start, start + size)
    if len(hot):
        alone = np.flatnonzero(np.isin(_slots(anchor), hot))
        anchor[alone] = run[alone]
        run[alone] = buffers.RangeHash(buffer, 2).of(start[alone], start[alone] + length)
    row = buffers.owner(begins, start)
    return row, start - begins[row], size, anchor, run


def _sorted_groups(anchor, run, doc_id, tag, at):
    """Order by anchor, run and place; where anchors and runs begin; rows equal to their run's first."""
    order = np.lexsort((at, tag, doc_id, run, anchor))
    anchor, run, doc_id, tag, at = anchor[order], run[order], doc_id[order], tag[order], at[order]
    new_anchor = np.ones(len(order), bool)
    new_anchor[1:] = anchor[1:] != anchor[:-1]
    new_run = new_anchor.copy()
    new_run[1:] |= run[1:] != run[:-1]
    lead = np.flatnonzero(new_run)[np.cumsum(new_run) - 1] if len(order) else order
    later = (doc_id != doc_id[lead]) | (tag != tag[lead]) | (at != at[lead])
    return order, new_anchor, new_run, later


def find_runs(hot, length: int, gram: int):
    """For tasks over ``doc_id, tag, text``: runs, and covered stretches with a negative size."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hot.value
        for batch in buffers.pieces(batches, "text"):
            data, offsets = buffers.utf8(batch.column("text"))
            row, at, size, anchor, run = _runs(data, offsets, length, gram, known)
            doc_id, tag = (batch.column(c).to_numpy()[row] for c in ("doc_id", "tag"))
            # copies within the batch: the later ones are covered and need not travel as runs
            order, _, new_run, later = _sorted_groups(anchor, run, doc_id, tag, at)
            # equal rows of one document are one
            again, ahead = ~new_run, order[:-1]
            again[1:] &= (doc_id[order[1:]] == doc_id[ahead]) & (tag[order[1:]] == tag[ahead]) & (at[order[1:]] == at[ahead])
            order, later = order[~again], later[~again]
            size, anchor, run = size[order].astype(np.int64), anchor[order], run[order]
            doc_id, tag, at = doc_id[order], tag[order], at[order]
            # covered stretches meet nobody, so they are dealt out evenly
            anchor[later] = buffers.mix((doc_id[later] ^ tag[later]).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + at[later].view(np.uint64))
            size = np.where(later, -size, size).astype(np.int32)
            yield buffers.arrow(_RUNS, anchor.view(np.int64), run.view(np.int64), doc_id, tag, at, size)

    return rows


def by_anchor(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], least: int) -> Iterator[tuple]:
    """Columns of a task sorted by anchor, in chunks of whole anchors with at least ``least`` rows."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        held += batch.num_rows
        last = batch.column("anchor")[-1].as_py()
        if held < least or waiting[0].column("anchor")[0].as_py() == last:
            continue
        whole = pa.Table.from_batches(waiting)
        cut = int(np.searchsorted(whole.column("anchor").to_numpy(), last))
        if cut:
            yield tuple(whole.column(n).slice(0, cut) for n in names)
        rest = whole.slice(cut).combine_chunks().to_batches()
        waiting, held = rest, sum(b.num_rows for b in rest)
    if waiting:
        whole = pa.Table.from_batches(waiting)
        yield tuple(whole.column(n) for n in names)


def compare_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered stretches (``anchor`` null), and first runs of anchors that have several different ones."""
    for columns in by_anchor(batches, ("anchor", "run", "doc_id", "tag", "at", "size"), 1 << 16):
        whole = [c.to_numpy() for c in columns]
        done = whole[-1] < 0
        none = pa.nulls(int(done.sum()), pa.int64())
        yield buffers.arrow(_FOUND, *(c[done] for c in whole[2:5]), -whole[-1][done], none)
        anchor, run, doc_id, tag, at, size = (c[~done] for c in whole)
        order, new_anchor, new_run, later = _sorted_groups(anchor, run, doc_id, tag, at)
        anchor, doc_id, tag, at, size = anchor[order], doc_id[order], tag[order], at[order], size[order]
        none = pa.nulls(int(later.sum()), pa.int64())
        yield buffers.arrow(_FOUND, doc_id[later], tag[later], at[later], size[later], none)
        kinds = np.bincount(np.cumsum(new_anchor) - 1, new_run) if len(anchor) else np.zeros(0)
        open_ = new_run & (kinds[np.cumsum(new_anchor) - 1] > 1) if len(anchor) else new_run
        yield buffers.arrow(_FOUND, doc_id[open_], tag[open_], at[open_], size[open_], anchor[open_])


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From texts with their lists of open runs: one row with the bytes of each run."""
    schema = pa.schema(
        [("anchor", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int64()), ("at", pa.int64()), ("content", pa.binary())]
    )
    for batch in buffers.pieces(batches, "text"):
        data, offsets = buffers.utf8(batch.column("text"))
        content = data.tobytes()
        wanted = batch.column("wanted")
        each = np.diff(wanted.offsets.to_numpy())
        row = np.repeat(np.arange(batch.num_rows), each)
        runs = wanted.flatten()
        at, size = runs.field("at").to_numpy(), runs.field("size").to_numpy()
        begin = offsets[row] + at
        cut = [content[b : b + s] for b, s in zip(begin.tolist(), size.tolist())]
        place = (batch.column(c).to_numpy()[row] for c in ("doc_id", "tag"))
        yield buffers.arrow(schema, runs.field("anchor"), *place, at, cut)


def sort_blocks(length: int, block_bytes: int):
    """For tasks over ``anchor, doc_id, tag, at, content`` sorted by anchor: the covered stretches."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *places, contents in by_anchor(batches, ("anchor", "doc_id", "tag", "at", "content"), 1):
            anchor, *place = (c.to_numpy() for c in places)
            data, offsets = buffers.utf8_binary(contents)
            new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            stops = np.append(new[1:], len(anchor))
            begin = 0
            for k, stop in enumerate(stops):
                full = offsets[stop] - offsets[begin] >= block_bytes or k == len(stops) - 1
                if full:
                    yield _covered(data, offsets, place, begin, int(stop), length)
                    begin = int(stop)

    return rows


def _covered(data, offsets, place, begin: int, stop: int, length: int) -> pa.RecordBatch:
    doc_id, tag, at = place
    inner = offsets[begin : stop + 1] - offsets[begin]
    block, begins = buffers.separated(data[offsets[begin] : offsets[stop]], inner, 1, _OUTSIDE)
    order, group = suffixes.classes(block, length)
    row = np.maximum(buffers.owner(begins, order), 0)
    inside = order - begins[row]
    valid = (inside >= 0) & (inside + length <= np.diff(inner)[row])  # whole windows only
    row, inside, group = row[valid], inside[valid], group[valid]
    where, owner, text = at[begin + row] + inside, doc_id[begin + row], tag[begin + row]
    ranked = np.lexsort((where, text, owner, group))
    where, owner, text, group = where[ranked], owner[ranked], text[ranked], group[ranked]
    later = np.zeros(len(group), bool)
    later[1:] = group[1:] == group[:-1]
    owner, text, where = owner[later], text[later], where[later]
    # consecutive windows become one stretch
    ranked = np.lexsort((where, text, owner))
    owner, text, where = owner[ranked], text[ranked], where[ranked]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (text[1:] != text[:-1]) | (where[1:] > where[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(owner))[: len(first)] - 1
    size = (where[last] - where[first] + length).astype(np.int32)
    return buffers.arrow(_COVER, owner[first], text[first], where[first], size)


def covered(
    texts: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_runs: int = HOT_RUNS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, tag, at, size``: stretches covered by earlier strings, over ``doc_id, tag, text``."""
    context = texts.sparkSession.sparkContext
    hot = context.broadcast(_hot_slots(texts, length, gram, hot_runs))
    runs = texts.mapInArrow(find_runs(hot, length, gram), _RUN)
    compared = runs.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(compare_runs, f"{_PLACED}, anchor bigint")
    folder = f"{scratch_dir(texts.sparkSession).rstrip('/')}/runs-{uuid.uuid4().hex}"
    compared.write.parquet(folder)
    found = texts.sparkSession.read.schema(f"{_PLACED}, anchor bigint").parquet(folder)
    wanted = found.where("anchor IS NOT NULL").groupBy("doc_id", "tag")
    lists = wanted.agg(F.collect_set(F.struct("at", "size", "anchor")).alias("wanted"))
    contents = texts.join(lists, ["doc_id", "tag"]).mapInArrow(
        cut_out, "anchor bigint, doc_id bigint, tag bigint, at bigint, content binary"
    )
    shared = contents.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(sort_blocks(length, block_bytes), _PLACED)
    return found.where("anchor IS NULL").select("doc_id", "tag", "at", "size").unionByName(shared)


def _slots(anchors: np.ndarray) -> np.ndarray:
    """Anchors are counted by the upper half of their hash: a few share one, none is split."""
    return (anchors >> np.uint64(32)).astype(np.uint32)


def _count_slots(length: int, gram: int):
    """For tasks over texts: how many runs of a piece each slot has; those alike at both ends count once."""
    schema = pa.schema([("slot", pa.int32()), ("n", pa.int32())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.pieces(batches, "text"):
            data, offsets = buffers.utf8(batch.column("text"))
            _, _, grams, windows, place = _anchored(data, offsets, length, gram)
            first = np.flatnonzero(_first_windows(windows, place))
            last = np.append(first[1:], len(windows))[: len(first)] - 1
            start, end = windows[first], windows[last] + length - gram
            ends = grams[start] * np.uint64(0x9E3779B97F4A7C15) + grams[end] + (end - start).astype(np.uint64)
            kinds = np.unique(ends ^ buffers.mix(grams[place[first]]), return_index=True)[1]
            slots, n = np.unique(_slots(grams[place[first[kinds]]]), return_counts=True)
            yield buffers.arrow(schema, slots.view(np.int32), n.astype(np.int32))

    return rows


def _hot_slots(texts: DataFrame, length: int, gram: int, hot_runs: int) -> np.ndarray:
    """Slots with more than ``hot_runs`` runs, counted over all documents; at most one for so many runs."""
    counted = texts.select("text").mapInArrow(_count_slots(length, gram), "slot int, n int")
    many = counted.groupBy("slot").agg(F.sum("n").alias("n")).where(F.col("n") > hot_runs).select("slot")
    return many.toArrow().column("slot").to_numpy().view(np.uint32)


def _finish(schema: pa.Schema):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.pieces(batches, "text"):
            data, offsets = buffers.utf8(batch.column("text"))
            n = batch.num_rows
            gone = batch.column("gone")
            each = np.where(gone.is_valid().to_numpy(zero_copy_only=False), np.diff(gone.offsets.to_numpy()), 0)
            row = np.repeat(np.arange(n), each)
            spans = gone.flatten()
            start = offsets[row] + spans.field("at").to_numpy()
            edge = np.zeros(len(data) + 1, np.int64)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + spans.field("size").to_numpy(), -1)
            removed = np.cumsum(edge[:-1]) > 0
            sums = np.concatenate([[0], np.cumsum(removed)])
            begins = removed.copy()
            begins[1:] &= ~removed[:-1]
            heads = offsets[:-1][np.diff(offsets) > 0]
            begins[heads] = removed[heads]
            heads_sum = np.concatenate([[0], np.cumsum(begins)])
            kept = data[~removed].tobytes()
            size = np.diff(offsets)
            n_removed = sums[offsets[1:]] - sums[offsets[:-1]]
            ends = np.cumsum(size - n_removed)
            digests = [hashlib.sha256(kept[b:e]).hexdigest() for b, e in zip((ends - (size - n_removed)).tolist(), ends.tolist())]
            n_spans = heads_sum[offsets[1:]] - heads_sum[offsets[:-1]]
            yield buffers.arrow(schema, batch.column("doc_id"), size, n_removed, n_spans, digests)

    return rows


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, **sizes
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row.

    A byte goes if it lies in a string of ``length`` bytes that also starts in a document with a
    smaller id, or earlier in its own; the input alone decides.  A null text has no bytes; a null
    id comes last; rows with one id and different texts are taken in an order of their texts'
    hashes, and equal rows fare alike.  An empty table gives no rows.
    """
    texts = id_text(docs, key, text).withColumn("tag", F.xxhash64("text"))
    spans = covered(texts, length, **sizes)
    gone = spans.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("at", "size")).alias("gone"))  # equal rows give the same stretches
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_bytes", pa.int64()),
            ("n_removed", pa.int64()),
            ("n_spans", pa.int64()),
            ("kept_sha256", pa.string()),
        ]
    )
    joined = texts.join(gone, ["doc_id", "tag"], "left").select("doc_id", "text", "gone")
    result = joined.mapInArrow(
        _finish(schema), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )
    return result.withColumn("doc_id", id_out())
