"""Query conditions.  Each returns a function of (frame, field mapping) giving a boolean column."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import Analyzer, FieldMapping, analyzed, once

Condition = Callable[[DataFrame, FieldMapping], Column]


def match_all() -> Condition:
    return lambda df, mapping: F.lit(True)


def term(field: str, value) -> Condition:
    """Exact value, or a token equal to ``value``; the value itself is not analyzed."""
    return terms(field, [value])


def terms(field: str, values: list) -> Condition:
    """Any of the values."""

    def condition(df: DataFrame, mapping: FieldMapping) -> Column:
        if _plain(df, field, mapping):
            return F.col(field).isin(list(values))
        kind = df.schema[field].dataType
        if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, T.StringType):
            return F.arrays_overlap(F.col(field), F.array(*map(F.lit, values)).cast(kind))
        wanted = F.array(*[F.lit(str(v)) for v in values]).cast("array<string>")
        return F.arrays_overlap(mapping.tokens(df, field), wanted)

    return condition


def match(q: str, field: str, operator: str = "or", analyzer: Analyzer | None = None) -> Condition:
    """The analyzed terms of ``q``: any of them, or with ``operator='and'`` all of them."""
    if operator.lower() not in ("or", "and"):
        raise ValueError(f"operator {operator!r} is neither 'or' nor 'and'")

    def condition(df: DataFrame, mapping: FieldMapping) -> Column:
        wanted = (analyzer or mapping.analyzer(field)).tokens(F.lit(q))
        found = mapping.tokens(df, field)
        if operator.lower() == "or":
            return F.arrays_overlap(found, wanted)
        return (F.size(wanted) > 0) & (F.size(F.array_except(wanted, found)) == 0)

    return condition


def phrase(field: str, text: str, slop: int = 0, analyzer: Analyzer | None = None) -> Condition:
    """The analyzed terms of ``text`` next to each other and in their order.

    With ``slop``, the terms may be moved: those places count whose distance from the phrase differs
    by at most ``slop`` among the terms.  A term asked for twice must stand there twice.  Places of dropped
    stop words count on both sides.
    """

    def condition(df: DataFrame, mapping: FieldMapping) -> Column:
        wanted = analyzed(df.sparkSession, analyzer or mapping.analyzer(field), text)
        return in_order(mapping.slots(df, field), wanted, slop)

    return condition


def in_order(slots: Column, wanted: list[str | None], slop: int = 0) -> Column:
    """Whether terms stand in ``slots`` as in ``wanted``, in which null is any place."""
    words = [(w, i) for i, w in enumerate(wanted) if w is not None]
    if not words:
        return F.lit(False)
    words = [(w, i - words[0][1]) for w, i in words]
    if len(words) == 1:
        return F.array_contains(slots, F.lit(words[0][0]))

    def exact(s: Column) -> Column:
        def here(t: Column, i: Column) -> Column:
            return reduce(lambda a, b: a & b, [F.get(s, i + o).eqNullSafe(F.lit(w)) for w, o in words])

        return F.exists(F.transform(s, here), lambda x: x)

    def moved(s: Column) -> Column:
        offsets: dict[str, list[int]] = {}
        for w, o in words:
            offsets.setdefault(w, []).append(o)

        def fits(start: Column) -> Column:
            tests = []
            for w, at in offsets.items():
                # Equal terms take places one after the other, each the first that is left.
                taken = F.lit(-1)
                for o in at:
                    taken = _first_place(s, w, taken, start + o, start + o + slop)
                tests.append(taken < _NOWHERE)
            return reduce(lambda a, b: a & b, tests)

        starts = [_shifted(_places(s, w), o) for w, o in words]
        return F.exists(F.array_distinct(F.concat(*starts)), fits)

    return once(slots, moved if slop > 0 else exact)


# Beyond every place; what follows it is beyond all bounds too.
_NOWHERE = 1 << 30


def _places(slots: Column, word: str) -> Column:
    return F.array_compact(F.transform(slots, lambda t, i: F.when(t == word, i)))


def _shifted(places: Column, by: int) -> Column:
    return F.transform(places, lambda p: p - by)


def _first_place(slots: Column, word: str, after: Column, low: Column, high: Column) -> Column:
    """The first place of a word beyond ``after`` within bounds, ``_NOWHERE`` if there is none.

    Only the slots within bounds are looked at, and each bound is bound once: nested expressions would be
    worked out again for every place of a text.
    """

    def seen(first: Column) -> Column:
        window = F.slice(slots, first + 1, F.greatest(high - first + 1, F.lit(0)))
        at = F.array_position(window, F.lit(word)).cast("int")
        return once(at, lambda n: F.when(n > 0, first + n - 1).otherwise(F.lit(_NOWHERE)))

    return once(F.greatest(after + 1, low), seen)


def prefix(field: str, start: str, lowercase: bool = True, dictionary: DataFrame | None = None) -> Condition:
    """A term with this beginning; for ``dictionary`` see :func:`some_term`."""
    wanted = start.lower() if lowercase else start
    return some_term(field, lambda t: t.startswith(wanted), dictionary)


def wildcard(field: str, pattern: str, lowercase: bool = True, dictionary: DataFrame | None = None) -> Condition:
    """``*`` stands for any characters and ``?`` for one."""
    text = pattern.lower() if lowercase else pattern
    marks = {"*": "%", "?": "_"}
    return some_term(field, like_pattern([marks.get(c, literal_like(c)) for c in text]), dictionary)


def literal_like(char: str) -> str:
    """A character that stands for itself in a LIKE pattern."""
    return "\\" + char if char in "\\%_" else char


def like_pattern(parts: list[str]) -> Callable[[Column], Column]:
    """The test for a pattern in LIKE's own notation; beginnings and whole terms are compared plainly."""
    body, last = parts[:-1], parts[-1:]
    if last == ["%"] and not any(p in ("%", "_") for p in body):
        start = "".join(p[-1] for p in body)
        return lambda t: t.startswith(start)
    return lambda t: t.like("".join(parts))


def fuzzy(
    field: str,
    text: str,
    edits: int = 2,
    lowercase: bool = True,
    prefix_length: int = 0,
    transpositions: bool = True,
    dictionary: DataFrame | None = None,
) -> Condition:
    """A term at most ``edits`` characters away: inserted, deleted, replaced, or two neighbours swapped.

    A swap is made in ``text`` before other edits.  The first ``prefix_length`` characters must agree.
    """
    if edits not in (0, 1, 2):
        raise ValueError("a fuzzy term allows 0, 1 or 2 edits")
    word = text.lower() if lowercase else text
    swapped = {
        word[:i] + word[i + 1] + word[i] + word[i + 2 :] for i in range(prefix_length, len(word) - 1)
    } - {word}
    ways = [(word, edits)] + [(w, edits - 1) for w in sorted(swapped) if transpositions and edits > 0]
    if transpositions and edits == 2:
        twice = {w[:i] + w[i + 1] + w[i] + w[i + 2 :] for w in swapped for i in range(prefix_length, len(w) - 1)}
        ways += [(w, 0) for w in sorted(twice - swapped - {word})]

    def test(t: Column) -> Column:
        exact = [w for w, k in ways if k == 0]
        parts = [F.levenshtein(t, F.lit(w), k) >= 0 for w, k in ways if k > 0]
        near = reduce(lambda a, b: a | b, parts + ([t.isin(*exact)] if exact else []))
        long = F.length(t)
        fits = (long >= len(word) - edits) & (long <= len(word) + edits)
        return (fits & t.startswith(word[:prefix_length]) if prefix_length else fits) & near

    return some_term(field, test, dictionary)


def regexp(field: str, pattern: str, dictionary: DataFrame | None = None) -> Condition:
    """A term that a regular expression (Java's notation) matches as a whole."""
    return some_term(field, lambda t: t.rlike(f"^(?:{pattern})$"), dictionary)


# So many terms of a dictionary are looked up as a set; if more fit, each token is tested instead.
MOST_EXPANDED = 20_000


def some_term(field: str, test: Callable[[Column], Column], dictionary: DataFrame | None = None) -> Condition:
    """A term of the field passes ``test``.

    ``dictionary``, a table with the columns ``field`` and ``term`` such as stored term statistics of
    the documents, is tested instead of every token: the terms found there are then looked up as a set.
    """

    def condition(df: DataFrame, mapping: FieldMapping) -> Column:
        found = mapping.tokens(df, field)
        if dictionary is not None:
            fitting = dictionary.where((F.col("field") == field) & test(F.col("term"))).select("term").distinct()
            listed = [r["term"] for r in fitting.limit(MOST_EXPANDED + 1).collect()]
            if len(listed) <= MOST_EXPANDED:
                return F.exists(found, lambda t: t.isin(listed)) if listed else F.lit(False)
        return F.exists(found, test)

    return condition


def all_of(*conditions) -> Condition:
    """Every condition holds; of none given, always."""
    return _combined(conditions, lambda a, b: a & b, True)


def any_of(*conditions) -> Condition:
    """At least one condition holds; of none given, never."""
    return _combined(conditions, lambda a, b: a | b, False)


def none_of(*conditions) -> Condition:
    """No condition holds."""
    some = any_of(*conditions)
    return lambda df, mapping: ~some(df, mapping)


def _combined(conditions, join: Callable[[Column, Column], Column], empty: bool) -> Condition:
    def condition(df: DataFrame, mapping: FieldMapping) -> Column:
        # A condition on a missing value does not hold, so that its negation does; None is match-all.
        parts = [match_all() if c is None else c for c in conditions]
        resolved = [F.coalesce(resolve(c, df, mapping), F.lit(False)) for c in parts]
        return reduce(join, resolved, F.lit(empty))

    return condition


def range_(field: str, gte=None, gt=None, lte=None, lt=None) -> Condition:
    """A value, or a token of an analyzed field, within bounds; bounds that are None do not limit it."""

    def within(value: Column) -> Column:
        tests = [(gte, value.__ge__), (gt, value.__gt__), (lte, value.__le__), (lt, value.__lt__)]
        return reduce(lambda a, b: a & b, [test(F.lit(x)) for x, test in tests if x is not None], value.isNotNull())

    def condition(df: DataFrame, mapping: FieldMapping) -> Column:
        if _plain(df, field, mapping):
            return within(F.col(field))
        kind = df.schema[field].dataType
        if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, T.StringType):
            return F.exists(F.col(field), within)
        return F.exists(mapping.tokens(df, field), within)

    return condition


def exists(field: str) -> Condition:
    """The field has a value; an array must hold one that is not null."""

    def condition(df: DataFrame, mapping: FieldMapping) -> Column:
        if isinstance(df.schema[field].dataType, T.ArrayType):
            return F.coalesce(F.size(F.array_compact(field)) > 0, F.lit(False))
        return F.col(field).isNotNull()

    return condition


def ids(values: list, key: str = "doc_id") -> Condition:
    """Documents by their keys."""
    return lambda df, mapping: F.col(key).isin(list(values))


def _plain(df: DataFrame, field: str, mapping: FieldMapping) -> bool:
    # A scalar column compares directly, so the filter reaches the parquet scan.
    kind = df.schema[field].dataType
    if isinstance(kind, T.StringType):
        return field in mapping.keywords
    return not isinstance(kind, T.ArrayType)


def resolve(query, df: DataFrame, mapping: FieldMapping) -> Column | None:
    """A condition, a plain column or None (every document) as a column."""
    if query is None or isinstance(query, Column):
        return query
    return query(df, mapping)


def analyzed_fields(query, df: DataFrame, mapping: FieldMapping) -> list[str]:
    """The fields whose tokens a condition looks at."""
    seen: dict[str, None] = {}

    class Recording(FieldMapping):
        def tokens(self, df: DataFrame, name: str) -> Column:
            seen[name] = None
            return super().tokens(df, name)

    resolve(query, df, Recording(mapping.keywords, mapping.analyzers, mapping.default))
    return list(seen)


def matching(df: DataFrame, query, mapping: FieldMapping) -> DataFrame:
    wanted = resolve(query, df, mapping)
    return df if wanted is None else df.where(wanted)
