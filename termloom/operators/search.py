"""Choose, order and page documents, and vectorize them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import analyzed_fields, matching
from ..functions.scoring import inverse_doc_freq
from ..functions.text import FieldMapping, once, with_ready_tokens
from ..functions.values import seeded_digest
from ..plans.cells import Source, constant_array, count_terms, joined_cells, joined_weights, known_statistics, with_cells
from ..plans.numbering import TOP_K_ROWS, first_rows, top_per_group
from ..plans.selection import Order, page
from ..plans.sizing import broadcast_limit, kept_by, vocabulary_bytes
from ..plans.spec import FeatureSpec
from .matrix import Matrix

# A page of keys is broadcast if it also keeps this many bytes per row within the limit.
KEY_BYTES = 256
SCORE = "_score"


@dataclass(frozen=True)
class Collection:
    """A frame of documents with its key columns and the way its string fields become terms.

    ``side`` may hold further fields of the same documents, such as labels; a document counts if
    it is in both, for statistics, scores and results alike.  Its text is reduced to cells before
    the two are joined, so that only slim rows move.
    """

    df: DataFrame
    key: tuple[str, ...] = ("doc_id",)
    mapping: FieldMapping = field(default_factory=FieldMapping)
    side: DataFrame | None = None

    @property
    def whole(self) -> DataFrame:
        """All fields in one frame; columns that are not asked for are not read."""
        return self.df if self.side is None else self.df.join(self.side, list(self.key))

    def hits(
        self,
        query=None,
        sort: list[str | Column] | None = None,
        terminate_after: int | None = None,
        shard: list[str] | None = None,
        relevance: tuple[str, list[str]] | None = None,
    ) -> tuple[DataFrame, list[Column]]:
        """Key and sort columns of the documents that match, and their order.

        Entries of ``sort`` are ``"field:asc"``, ``"field:desc"`` or a column (ascending); the
        key always comes last, so that the order is total.  With ``relevance``, a field and the
        terms looked for in it, ``"_score:desc"`` sorts by relevance, documents without any of
        the terms last.
        """
        whole = self.whole
        if relevance is not None:
            scores = self._score(*relevance)
            # Condition and score look at the same tokens.
            if relevance[0] in analyzed_fields(query, whole, self.mapping) and relevance[0] not in self.mapping.keywords:
                whole = with_ready_tokens(whole, [relevance[0]], self.mapping)
            whole = scores(whole).withColumnRenamed("score", SCORE)
        found = matching(whole, query, self.mapping)
        extra, order = [], []
        for number, entry in enumerate(sort or []):
            name = f"__sort{number}"
            value, down = _sort_entry(entry)
            extra.append(value.alias(name))
            order.append(F.col(name).desc_nulls_last() if down else F.col(name).asc_nulls_last())
        order += [F.col(k) for k in self.key]
        keys = list(self.key)
        if terminate_after is None:
            return found.select(*keys, *extra), order
        # Each shard stops collecting after so many documents, taken in key order.
        shard = list(shard or [])
        narrow = found.select(*keys, *extra, *[s for s in shard if s not in keys])
        by_key = [F.col(k) for k in keys]
        if not shard:
            return first_rows(narrow, by_key, terminate_after), order
        first = top_per_group(narrow, shard, by_key, terminate_after, keys, "__rank")
        return first.drop("__rank", *[s for s in shard if s not in keys]), order

    # -- matrices -----------------------------------------------------------------------------
    def vectorize(
        self, spec: FeatureSpec, doc_id, sparse_format: str = "dict", **options
    ) -> DataFrame:
        """The vector of one document: ``(key, found, n_rows, n_cols, matrix)``, always one row.

        ``doc_id`` is a value, or with several key columns a tuple of their values.  ``matrix`` is a map, or with ``coo`` a struct of the arrays ``row``, ``col``, ``data``;
        it is null where the document is absent.
        """
        values = doc_id if isinstance(doc_id, (tuple, list)) else (doc_id,)
        if len(values) != len(self.key):
            raise ValueError(f"a document is named by {', '.join(self.key)}")
        wanted = dict(zip(self.key, values))
        forms = {"dict": F.map_from_entries("cells"), "coo": _coo_arrays(F.col("cells"))}
        if sparse_format.lower() not in forms:
            raise ValueError(f"sparse format {sparse_format!r} is neither 'dict' nor 'coo'")
        same = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in wanted.items()])
        cells = self._vectors(spec, [], options, lambda table: table.where(same))
        named = [F.lit(v).cast(self.df.schema[k].dataType).alias(k) for k, v in wanted.items()]
        matrix = F.first(forms[sparse_format.lower()]).alias("matrix")
        return cells.agg(matrix, F.count("*").alias("n")).select(
            *named,
            (F.col("n") > 0).alias("found"),
            F.lit(1).alias("n_rows"),
            F.lit(spec.n_cols).alias("n_cols"),
            "matrix",
        )

    def search_vectorize(
        self,
        spec: FeatureSpec,
        query=None,
        *,
        sort: list[str | Column] | None = None,
        from_: int = 0,
        size: int = 10,
        fields: list[str] | None = None,
        terminate_after: int | None = None,
        shard: list[str] | None = None,
        relevance: tuple[str, list[str]] | None = None,
        **options,
    ) -> Matrix:
        """Filter, order, cut one page, vectorize.  Rows count from 0 within the page."""
        hits, order = self.hits(query, sort, terminate_after, shard, relevance)
        downs = [_sort_entry(entry)[1] for entry in sort or []]
        known = [Order(f"__sort{i}", down, nulls_last=True) for i, down in enumerate(downs)]
        chosen = page_of(hits, [*known, *map(Order, self.key)], from_, size).select(*self.key, "row")
        # A page of few rows is small by construction; a larger one is an ordinary join.
        few = from_ + size <= TOP_K_ROWS and size * KEY_BYTES * len(self.key) <= broadcast_limit(self.df.sparkSession)
        near = F.broadcast(chosen) if few else chosen
        docs = self._vectors(
            spec, ["row", *(fields or [])], options, lambda table: table.join(near, list(self.key))
        )
        return Matrix(docs, chosen, spec, self.key, (F.col("row"),))

    def vectorize_all(
        self,
        spec: FeatureSpec,
        query=None,
        *,
        sort: list[str | Column] | None = None,
        fields: list[str] | None = None,
        **options,
    ) -> Matrix:
        """The matrix of every document that matches."""
        hits, order = self.hits(query, sort)
        docs = self._vectors(spec, fields or [], options, self._matching(query, spec))
        return Matrix(docs, hits, spec, self.key, tuple(order))

    def scroll(self, spec: FeatureSpec, size: int, query=None, **options) -> Matrix:
        """The whole result in result order, cut into batches of ``size`` documents."""
        cutoff = options.pop("cutoff", -1)
        return self.vectorize_all(spec, query, **options).batches(size, cutoff)

    def scan(self, spec: FeatureSpec, size: int, query=None, **options) -> DataFrame:
        """Full export in no particular order, without moving anything (but to meet ``side``).

        Every task cuts its own documents into batches of at most ``size``; ``cutoff`` keeps the
        first so many batches only.  Result: the kept
        fields with ``batch_id`` (unique, not consecutive), ``row_in_batch`` and ``cells``.
        """
        fields, cutoff = options.pop("fields", None) or [], options.pop("cutoff", -1)
        docs = self._vectors(spec, fields, options, self._matching(query, spec))
        at = F.monotonically_increasing_id()
        inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
        row = F.pmod(inside, F.lit(size))
        cut = (
            docs.withColumn("__at", at)
            .withColumn("batch_id", F.col("__at") - row)
            .withColumn("row_in_batch", row)
            .drop("__at")
        )
        if cutoff < 0:
            return cut
        # The first batches by number; only their numbers are sent, at most ``cutoff`` of them.
        chosen = first_rows(cut.select("batch_id").distinct(), ["batch_id"], cutoff)
        return cut.join(F.broadcast(chosen) if cutoff <= TOP_K_ROWS else chosen, "batch_id", "left_semi")

    def _matching(self, query, spec: FeatureSpec) -> Callable[[DataFrame], DataFrame]:
        if query is None:
            return lambda table: table
        if self.side is None:
            asked = analyzed_fields(query, self.df, self.mapping)
            shared = [f for f in asked if f in spec.term_columns() and f not in self.mapping.keywords]
            return lambda table: matching(with_ready_tokens(table, shared, self.mapping), query, self.mapping)
        # The query may ask for fields of both tables: its answer chooses among the documents.
        keys = list(self.key)
        chosen = matching(self.whole, query, self.mapping).select(*keys)
        return lambda table: table.join(chosen, keys, "left_semi") if table is self.df else table

    def _vectors(
        self,
        spec: FeatureSpec,
        fields: list[str],
        options: dict,
        choose: Callable[[DataFrame], DataFrame],
    ) -> DataFrame:
        """Key, ``fields`` and ``cells`` of the chosen documents."""
        options, keys = dict(options), list(self.key)
        strict = options.pop("on_missing", "ignore") == "error"
        missing = [f.field for f in spec.features if f.field not in self.whole.columns]
        if missing and strict:
            raise ValueError(f"the documents have no field {missing[0]!r}")
        # Statistics describe the whole collection, not the hits of a query.
        corpus = options.pop("corpus", None)
        parts, blocks, taken = [], [], set(keys)
        for number, table in enumerate(t for t in (self.df, self.side) if t is not None):
            source = table if corpus is None else corpus
            members = self._members(table, options.get("scope") or []) if corpus is None else None
            chosen = choose(table)
            if table is self.df and self.side is not None:
                chosen = kept_by(chosen, self.side, keys)
            own = [f for f in dict.fromkeys(fields) if f in chosen.columns and f not in taken]
            taken.update(own)
            block = f"__cells{number}"
            vectors = with_cells(
                chosen, spec, key=keys, mapping=self.mapping, corpus=source, members=members, out=block, **options
            )
            parts.append(vectors.select(*keys, *own, block))
            blocks.append(F.col(block))
        if len(parts) == 1:
            docs, cells = parts[0], blocks[0]
        else:
            docs, cells = parts[0].join(parts[1], keys), F.sort_array(F.concat(*blocks))
        return docs.select(*dict.fromkeys([*keys, *fields]), cells.alias("cells"))

    def _members(self, table: DataFrame, scope: list[str]) -> DataFrame | None:
        """For statistics of one table: the keys of the other, with the scope columns it adds."""
        if self.side is None:
            return None
        other = self.side if table is self.df else self.df
        added = [c for c in scope if c not in table.columns and c in other.columns]
        return other.select(*dict.fromkeys([*self.key, *added]))

    def _source(self, field: str) -> Source:
        table = self.df if field in self.df.columns or self.side is None else self.side
        return Source(table, None, self.mapping, [], self._members(table, []), list(self.key))

    # -- other answers -------------------------------------------------------------------------
    def count(self, query=None) -> DataFrame:
        """Number of matching documents alone."""
        return matching(self.whole, query, self.mapping).agg(F.count("*").alias("n_docs"))

    def _n_docs(self) -> int:
        keys = list(self.key)
        if self.side is None:
            return self.df.count()
        return self.df.select(*keys).join(self.side.select(*keys), keys).count()

    def _idf(self, source: Source, field: str, terms: list[str], n_docs: int) -> Column:
        freqs = known_statistics(source, field, terms, "doc_freq")
        return constant_array([inverse_doc_freq(n_docs, d) for d in freqs], "double")

    def _score(self, field: str, terms: list[str]) -> Callable[[DataFrame], DataFrame]:
        """What adds ``score`` to a frame of documents."""
        terms = list(dict.fromkeys(terms))
        if vocabulary_bytes(terms) > broadcast_limit(self.df.sparkSession):
            raise ValueError("these are too many query terms: use tf_idf and add up its rows")
        idf = self._idf(self._source(field), field, terms, self._n_docs())

        def score(q: Column) -> Column:
            parts = F.zip_with(q["indices"], q["values"], lambda i, tf: tf * F.get(idf, i))
            total = F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)
            return F.when(F.size(q["indices"]) > 0, total)

        def add(df: DataFrame) -> DataFrame:
            counted = count_terms(df, field, terms, self.mapping, binary=False, out="__q")
            return counted.withColumn("score", once(F.col("__q"), score)).drop("__q")

        return add

    def scored(self, field: str, terms: list[str]) -> DataFrame:
        """Add ``score``: the sum of tf-idf over the query terms, null without any of them.

        The terms are few, so each document is scored inside its own row.
        """
        add = self._score(field, terms)
        if self.side is None:
            return add(self.df)
        keys = list(self.key)
        table = self._source(field).corpus
        other = self.side if table is self.df else self.df
        return add(kept_by(table, other, keys)).join(other.select(*keys), keys, "left_semi")

    def top_by_relevance(self, field: str, terms: list[str], size: int) -> DataFrame:
        """``(key, score)`` of the best documents by their full scores, equal ones by key."""
        add, keys = self._score(field, terms), list(self.key)
        table = self._source(field).corpus
        best = add(table.select(*dict.fromkeys([*keys, field]))).select(*keys, "score")
        if self.side is not None:
            other = self.side if table is self.df else self.df
            best = best.join(other.select(*keys), keys, "left_semi")
        # A filter above the limit stays there; below it, every text would be analyzed twice.
        top = first_rows(best, [F.desc_nulls_last("score"), *(F.col(k) for k in keys)], size)
        return top.where(F.col("score").isNotNull())

    def tf_idf(self, spec: FeatureSpec) -> DataFrame:
        """``(key, col, data)``: term frequency times inverse document frequency.

        Covers the term columns of ``spec``; its value options do not matter here.  Without term
        columns there are no rows.
        """
        keys, spark = list(self.key), self.df.sparkSession
        columns = spec.term_columns()
        fields = ", ".join(f"{k} {self.df.schema[k].dataType.simpleString()}" for k in keys)
        union = spark.createDataFrame([], f"{fields}, col int, data double")
        n_docs = self._n_docs() if columns else 0
        for name, (terms, cols) in columns.items():
            source = self._source(name)
            if name not in source.corpus.columns:
                continue
            if vocabulary_bytes(terms) > broadcast_limit(spark):
                words = spark.createDataFrame(list(zip(terms, cols)), "term string, col int")
                weight = F.log(F.lit(float(n_docs + 1)) / (F.col("doc_freq") + 1))
                arm = joined_weights(source.corpus, name, words, weight, source, keys)
            else:
                idf, table = self._idf(source, name, terms, n_docs), constant_array(cols, "int")
                raw = FeatureSpec.from_spec([{"field": name, "span": terms}])
                cells = with_cells(source.corpus, raw, key=keys, mapping=self.mapping)
                weighted = F.transform(
                    "cells",
                    lambda c: F.struct(
                        F.get(table, c["col"]).alias("col"),
                        (c["value"] * F.get(idf, c["col"])).alias("data"),
                    ),
                )
                slim = source.counting(cells.select(*keys, weighted.alias("__w")))
                arm = slim.select(*keys, F.explode_outer("__w").alias("c")).select(*keys, "c.col", "c.data")
            union = union.unionByName(arm)
        return union.where(F.col("col").isNotNull() & (F.col("data") != 0))

    def from_dictionary(self, field: str, words: DataFrame, option: str = "term_freq", **source) -> DataFrame:
        """``(key, cells)`` for a dictionary of any size, a frame ``(term, col)`` of distinct terms.

        Documents without a cell are left out.  ``statistics`` and ``scope`` as elsewhere.
        """
        known = self._source(field)._replace(**source)
        members = self._members(known.corpus, known.scope)
        cells = joined_cells(known.corpus, field, words, option, known._replace(members=members), list(self.key))
        return cells if members is None else cells.join(members.select(*self.key), list(self.key), "left_semi")


def _coo_arrays(cells: Column) -> Column:
    return F.struct(
        F.transform(cells, lambda c: F.lit(0)).alias("row"),
        F.transform(cells, lambda c: c["col"]).alias("col"),
        F.transform(cells, lambda c: c["value"]).alias("data"),
    )


def _sort_entry(entry: str | Column) -> tuple[Column, bool]:
    if isinstance(entry, Column):
        return entry, False
    name, _, direction = entry.partition(":")
    if direction not in ("", "asc", "desc"):
        raise ValueError(f"sort {entry!r} is not of the form field:asc or field:desc")
    return F.col(name), direction == "desc"


def random_order(key: str | list[str], seed: int) -> Column:
    """A repeatable random sort value: the same for any partitioning and any engine."""
    return seeded_digest(key, seed)


def page_of(hits: DataFrame, order: list[Order], from_: int, size: int) -> DataFrame:
    """One page of the hits with ``row`` counting from 0."""
    if from_ < 0 or size < 0:
        raise ValueError("'from_' and 'size' are not negative")
    if from_ + size <= TOP_K_ROWS:
        # A top-k leaves one ordered partition, in which this number counts from 0.
        top = hits.orderBy(*[by.column() for by in order]).offset(from_).limit(size)
        return top.withColumn("row", F.monotonically_increasing_id())
    return page(hits, order, from_, size)
