"""Documents to matrix cells: the plan behind every vectorizing operator.

Each document is turned into ``array<struct<col, value>>`` inside its own row.  Terms are looked
up in a dictionary that every executor holds once, so the text itself is never shuffled, grouped
or exploded.  Two things may change that plan: statistics are computed only if an option asks
for them, and a dictionary beyond the broadcast limit is joined instead.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from typing import NamedTuple

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import FieldMapping, term_counts
from ..functions.values import cell_value, is_numeric
from .sizing import broadcast_limit, salted_join, vocabulary_bytes
from .spec import FeatureSpec

CELL = T.StructType([T.StructField("col", T.IntegerType()), T.StructField("value", T.DoubleType())])
CELLS = T.ArrayType(CELL)
_TOKENS, _VECTOR = "__tokens", "__vector"


class Source(NamedTuple):
    """Where terms and their statistics come from.

    ``members`` holds the keys of the documents of the corpus that count (null: all), with those
    scope columns that the corpus itself does not have.
    """

    corpus: DataFrame
    statistics: DataFrame | None
    mapping: FieldMapping
    scope: list[str]
    members: DataFrame | None = None
    key: list[str] = []

    def own(self, df: DataFrame) -> list[str]:
        """What must be kept of a frame so that the members can be joined to it."""
        scope = [c for c in self.scope if c in df.columns]
        return list(dict.fromkeys([*(self.key if self.members is not None else []), *scope]))

    def counting(self, df: DataFrame) -> DataFrame:
        """Only the members, with their scope; ``df`` is slim by now."""
        return df if self.members is None else df.join(self.members, self.key)


def with_cells(
    df: DataFrame,
    spec: FeatureSpec,
    *,
    key: list[str],
    mapping: FieldMapping = FieldMapping(),
    corpus: DataFrame | None = None,
    statistics: DataFrame | None = None,
    scope: list[str] | None = None,
    numeric_mode: str = "keep",
    on_missing: str = "ignore",
    largest_broadcast: int | None = None,
    members: DataFrame | None = None,
    out: str = "cells",
) -> DataFrame:
    """Add the cells of every document, in ascending column order, zeros left out.

    ``corpus`` is what ``doc_freq`` and ``ttf`` describe (default: ``df``); with ``scope`` they
    describe only the part of the corpus that agrees on these columns.  A stored table
    ``statistics (field, term, doc_freq, ttf)`` replaces the pass over the corpus.  A term
    without statistics, or with a statistic of 0, gives no cell.  ``key`` is used only when a
    dictionary is too large to broadcast, or with ``scope``; rows with equal or null keys keep
    their own cells.  ``members``: see :class:`Source`.
    """
    given = df.columns
    if scope and statistics is not None:
        raise ValueError("stored statistics are global: give a corpus for a scope")
    corpus = df if corpus is None else corpus
    source = Source(corpus, statistics, mapping, list(scope or []), members, list(key))
    limit = broadcast_limit(df.sparkSession) if largest_broadcast is None else largest_broadcast
    blocks: list[tuple[list[int], Column]] = []
    for number, (field, (terms, cols)) in enumerate(spec.term_columns().items()):
        if not _present(df, field, on_missing):
            continue
        block = f"__block{number}"
        option = spec.option(field)
        small = vocabulary_bytes(terms) <= limit
        build = _looked_up if small else _joined
        df = build(df, source, field, terms, cols, option, key, block)
        blocks.append((cols, F.col(block)))
    for field, cols in spec.slot_columns().items():
        if _present(df, field, on_missing):
            blocks.append((cols, _slots(df, field, cols, numeric_mode)))
    return df.select(*given, _side_by_side(blocks).alias(out))


def _present(df: DataFrame, field: str, on_missing: str) -> bool:
    if field in df.columns:
        return True
    if on_missing == "error":
        raise ValueError(f"the documents have no field {field!r}")
    return False  # its columns stay reserved and empty


# -- text fields ------------------------------------------------------------------------------
def _looked_up(df, source, field, terms, cols, option, key, block) -> DataFrame:
    mapping, stats = source.mapping, None
    counted = count_terms(df, field, terms, mapping, binary=option != "term_freq", out=block)
    if option in ("doc_freq", "ttf") and source.scope:
        # Joined after counting: the slim vectors move, the text does not.
        shares = _scope_statistics(source, field, terms, option, f"{block}_stats")
        absent = [c for c in source.scope if c not in counted.columns]
        if absent:
            counted = counted.join(source.members.select(*key, *absent), key, "left")
        counted = salted_join(counted, shares, source.scope, F.struct(*key), "left").drop(*absent)
        stats = F.col(f"{block}_stats")
    elif option in ("doc_freq", "ttf"):
        known = known_statistics(source, field, terms, option)
        stats = constant_array(known, "double")
    col = _column_of(cols)
    value = F.col(block)
    if option == "term_freq":
        cells = F.zip_with(value["indices"], value["values"], lambda i, v: _cell(col(i), v))
    elif option == "binary":
        cells = F.transform(value["indices"], lambda i: _cell(col(i), F.lit(1.0)))
    else:
        cells = F.transform(value["indices"], lambda i: _cell(col(i), F.get(stats, i)))
        cells = F.filter(cells, lambda c: F.coalesce(c["value"], F.lit(0.0)) != 0)
    return counted.withColumn(block, cells).drop(f"{block}_stats")


def count_terms(
    df: DataFrame, field: str, terms: list[str], mapping: FieldMapping, binary: bool, out: str
) -> DataFrame:
    """Add ``struct<type, size, indices, values>``: counts of the dictionary terms per document."""
    counted = dictionary_vectors(df, field, terms, mapping, binary, _VECTOR)
    return counted.withColumn(out, F.unwrap_udt(_VECTOR)).drop(_VECTOR)


def dictionary_vectors(
    df: DataFrame, field: str, terms: list[str], mapping: FieldMapping, binary: bool, out: str
) -> DataFrame:
    """Add the same counts as a sparse ML vector."""
    app = df.sparkSession.sparkContext.applicationId
    tokens = df.withColumn(_TOKENS, mapping.tokens(df, field))
    model = _dictionary(app, tuple(terms), binary)
    return model.transform(tokens).withColumnRenamed(_VECTOR, out).drop(_TOKENS)


def pieces(terms: list[str], limit: int) -> list[list[str]]:
    """Consecutive parts of a dictionary, each within ``limit`` bytes (or a single term)."""
    parts: list[list[str]] = [[]]
    held = 0
    for term in terms:
        size = vocabulary_bytes([term])
        if parts[-1] and held + size > limit:
            parts.append([])
            held = 0
        parts[-1].append(term)
        held += size
    return parts


@lru_cache(maxsize=4)  # each within the broadcast limit
def _dictionary(app: str, terms: tuple[str, ...], binary: bool) -> CountVectorizerModel:
    # One dictionary per Spark application and word list, shared by all plans that use it.
    return CountVectorizerModel.from_vocabulary(
        list(terms), inputCol=_TOKENS, outputCol=_VECTOR, binary=binary
    )


def vocabulary_statistics(source: Source, field: str, terms: list[str]) -> DataFrame:
    """``(scope..., slot, doc_freq, ttf)`` of the dictionary terms, ``slot`` counting from 0.

    Partial sums are formed where the text is read; one row per term leaves each task.
    """
    corpus, scope = source.corpus, source.scope
    slim = corpus.select(*dict.fromkeys([*source.own(corpus), field]))
    counted = count_terms(slim, field, terms, source.mapping, binary=False, out="__c")
    counted = source.counting(counted.select(*source.own(corpus), "__c"))
    pairs = F.arrays_zip(F.col("__c")["indices"].alias("i"), F.col("__c")["values"].alias("v"))
    # The outer form keeps Spark from repeating the whole analysis in a pushed-down size filter.
    return (
        counted.select(*scope, F.explode_outer(pairs).alias("p"))
        .select(*scope, F.col("p.i").alias("slot"), F.col("p.v").alias("tf"))
        .where(F.col("slot").isNotNull())
        .groupBy(*scope, "slot")
        .agg(F.count("*").alias("doc_freq"), F.sum("tf").cast("bigint").alias("ttf"))
    )


def known_statistics(source: Source, field: str, terms: list[str], option: str) -> list[int]:
    """``doc_freq`` or ``ttf`` of each dictionary term: as many numbers as the dictionary has.

    For dictionaries that may be broadcast; the numbers take less room than the terms.
    """
    if source.statistics is None:
        stats = vocabulary_statistics(source._replace(scope=[]), field, terms)
    else:
        words = source.corpus.sparkSession.createDataFrame(list(enumerate(terms)), "slot int, term string")
        stats = source.statistics.where(F.col("field") == field).join(F.broadcast(words), "term")
    found = {r["slot"]: r[option] for r in stats.select("slot", option).collect()}
    return [found.get(slot) or 0 for slot in range(len(terms))]


def constant_array(numbers: list, kind: str) -> Column:
    """A literal array in one expression, which Catalyst folds once."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast(f"array<{kind}>")


def _scope_statistics(source, field, terms, option, name) -> DataFrame:
    # One row per scope value, holding one number per dictionary term.
    scope = source.scope
    stats = vocabulary_statistics(source, field, terms)
    pairs = F.array_sort(F.collect_list(F.struct("slot", F.col(option).cast("double").alias("v"))))
    found = stats.groupBy(*scope).agg(pairs.alias("found"))

    def padded(pair: Column, i: Column) -> Column:
        last = F.coalesce(F.get(F.col("found"), i - 1)["slot"], F.lit(-1))
        gap = F.array_repeat(F.lit(0.0), pair["slot"] - last - 1)
        return F.concat(gap, F.array(pair["v"]))

    return found.select(*scope, F.flatten(F.transform("found", padded)).alias(name))


def _joined(df, source, field, terms, cols, option, key, block) -> DataFrame:
    words = df.sparkSession.createDataFrame(list(zip(terms, cols)), "term string, col int")
    # Rows are told apart by key, scope and content, so equal and null keys keep their own cells.
    marked = df.withColumn("__row", F.xxhash64(field))
    keys = list(dict.fromkeys([*key, *(c for c in source.scope if c in df.columns), "__row"]))
    rows = joined_cells(marked, field, words, option, source, keys, block)
    theirs = {k: f"__their_{n}" for n, k in enumerate(keys)}
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(t)) for k, t in theirs.items()])
    joined = marked.join(rows.withColumnsRenamed(theirs), same, "left").drop("__row", *theirs.values())
    return joined.withColumn(block, F.coalesce(block, F.array().cast(CELLS)))


def joined_cells(
    df: DataFrame,
    field: str,
    words: DataFrame,
    option: str,
    source: Source,
    key: list[str],
    out: str = "cells",
) -> DataFrame:
    """``(key, cells)`` for a dictionary of any size, given as a frame ``(term, col)``.

    The terms of a document are counted in its row; the counts meet the dictionary in a salted
    join, since a frequent term occurs in a large part of all documents.
    """
    scope, mapping = source.scope, source.mapping
    exploded = _exploded(df, list(dict.fromkeys([*key, *(c for c in scope if c in df.columns)])), field, mapping)
    absent = [c for c in scope if c not in df.columns]
    if absent:
        exploded = exploded.join(source.members.select(*source.key, *absent), source.key)
    if option in ("doc_freq", "ttf"):
        if source.statistics is None:
            seen = _exploded(source.corpus, scope, field, mapping, source)
            seen = seen.groupBy(*scope, "term").agg(
                F.count("*").alias("doc_freq"), F.sum("tf").alias("ttf")
            )
        else:
            seen = source.statistics.where(F.col("field") == field)
        # Statistics hold a term once per scope value, the dictionary once.
        words = words.join(seen.select(*scope, "term", F.col(option).alias("v")), "term")
    keys = ["term", *scope] if "v" in words.columns else ["term"]
    hits = salted_join(exploded, words, keys, F.struct(*key))
    value = {"binary": F.lit(1.0), "term_freq": F.col("tf")}.get(option)
    value = F.col("v") if value is None else value
    hits = hits.where(F.coalesce(value, F.lit(0)) != 0)
    # A set by hashing: array_distinct compares each cell of a document with all others.
    cells = F.sort_array(F.collect_set(_cell(F.col("col"), value)))
    return hits.groupBy(*key).agg(cells.alias(out))


def joined_weights(
    df: DataFrame, field: str, words: DataFrame, weight: Column, source: Source, key: list[str]
) -> DataFrame:
    """``(key, col, data)``: term frequency times ``weight``, an expression of ``doc_freq``.

    For a dictionary of any size, given as a frame ``(term, col)``.
    """
    seen = _exploded(source.corpus, [], field, source.mapping, source)
    freqs = seen.groupBy("term").agg(F.count("*").alias("doc_freq"))
    weights = words.join(freqs, "term").select("term", "col", weight.alias("__w"))
    hits = salted_join(_exploded(df, key, field, source.mapping), weights, ["term"], F.struct(*key))
    return hits.select(*key, F.col("col").cast("int").alias("col"), (F.col("tf") * F.col("__w")).alias("data"))


def _exploded(
    df: DataFrame, keep: list[str], field: str, mapping: FieldMapping, source: Source | None = None
) -> DataFrame:
    """``(keep, term, tf)``; with a ``source``, of its members only."""
    counted = df
    if source is not None and source.members is not None:
        slim = df.select(*source.own(df), term_counts(mapping.tokens(df, field)).alias("__counts"))
        counted, counts = source.counting(slim), F.col("__counts")
    else:
        counts = term_counts(mapping.tokens(df, field))
    return (
        counted.select(*keep, F.explode_outer(counts).alias("__t"))
        .select(*keep, F.col("__t.term").alias("term"), F.col("__t.tf").alias("tf"))
        .where(F.col("term").isNotNull())
    )


# -- numeric fields -----------------------------------------------------------------------------
def _slots(df: DataFrame, field: str, cols: list[int], mode: str) -> Column:
    kind, value = df.schema[field].dataType, F.col(field)
    many = isinstance(kind, T.ArrayType)
    inner = kind.elementType if many else kind
    if not is_numeric(inner):
        raise ValueError(
            f"field {field!r} of type {kind.simpleString()} cannot fill an integer span"
        )
    if many:
        # Missing values are not stored, so they use up no slot.
        first = F.slice(F.array_compact(value), 1, len(cols))
    else:
        first = F.array_compact(F.array(value))
    col = _column_of(cols)
    cells = F.transform(first, lambda v, i: _cell(col(i), cell_value(v, inner, mode)))
    kept = F.filter(cells, lambda c: c["value"] != 0)
    return F.coalesce(kept, F.array().cast(CELLS))


# -- putting blocks together -----------------------------------------------------------------------
def _cell(col: Column, value: Column) -> Column:
    return F.struct(col.cast("int").alias("col"), value.cast("double").alias("value"))


def _column_of(cols: list[int]):
    """Position inside a block to column of the matrix."""
    if cols == list(range(cols[0], cols[0] + len(cols))):
        return lambda i: i + F.lit(cols[0])
    table = constant_array(cols, "int")
    return lambda i: F.get(table, i)


def _side_by_side(blocks: list[tuple[list[int], Column]]) -> Column:
    if not blocks:
        return F.array().cast(CELLS)
    blocks = sorted(blocks, key=lambda b: b[0][0])
    joined = blocks[0][1] if len(blocks) == 1 else F.concat(*[c for _, c in blocks])
    apart = all(a[0][-1] < b[0][0] for a, b in zip(blocks, blocks[1:]))
    return (joined if apart else F.sort_array(joined)).cast(CELLS)
