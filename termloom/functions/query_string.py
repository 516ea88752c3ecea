"""Query strings: the short notation for conditions that a person types.

    quick "brown fox"~2 +lang:en -(spam OR "junk mail") n_chars:[100 TO 500} title:wor* colour~1

A string becomes the conditions of :mod:`.conditions`; nothing else is executed here.  Clauses are
optional, required (``+``, ``AND``) or excluded (``-``, ``NOT``): all required ones hold, no excluded one
does, and if none is required, some optional one.  ``AND`` and ``OR`` bind as in the classic notation: ``AND``
makes both neighbours required.  Words without a field ask the default field.  A boost (``^2``) is
read and has no effect, as it changes scores and not the documents found.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .conditions import (
    Condition,
    all_of,
    any_of,
    exists,
    fuzzy,
    in_order,
    like_pattern,
    literal_like,
    none_of,
    range_,
    regexp,
    some_term,
    term,
)
from .text import Analyzer, FieldMapping, analyzed

MUST, SHOULD, MUST_NOT = "must", "should", "must not"

_CHAR = r"\\.|[^\s+\-!(){}\[\]^\"~:\\/]"
_SYNTAX = re.compile(
    rf"""(?P<blank>\s+)
    |(?P<quoted>"(?:\\.|[^"\\])*")
    |(?P<regex>/(?:\\.|[^/\\])*/)
    |(?P<range>[\[{{]\s*(?:"(?:\\.|[^"\\])*"|\S+)\s+TO\s+(?:"(?:\\.|[^"\\])*"|[^\s\]}}]+)\s*[\]}}])
    |(?P<both>&&|\|\|)
    |(?P<compare>(?<=:)[<>]=?(?:{_CHAR}|[-+.])+)
    |(?P<boost>\^[0-9]*\.?[0-9]+)
    |(?P<fuzzy>~[0-9]*\.?[0-9]*)
    |(?P<mark>[+\-!():])
    |(?P<term>(?:{_CHAR})(?:{_CHAR}|[-+/])*)""",
    re.VERBOSE | re.DOTALL,
)
_BOUNDS = re.compile(r'[\[{]\s*("(?:\\.|[^"\\])*"|\S+)\s+TO\s+("(?:\\.|[^"\\])*"|[^\s\]}]+)\s*[\]}]', re.DOTALL)


class QueryStringError(ValueError):
    """A string that is no query, with the position at which reading stopped."""

    def __init__(self, reason: str, at: int):
        super().__init__(f"{reason} at position {at}")
        self.at = at


@dataclass(frozen=True)
class Leaf:
    """One clause without parts: ``kind`` says how ``text`` is meant."""

    kind: str
    field: str | None
    text: str
    number: int = 0


@dataclass(frozen=True)
class Group:
    clauses: tuple[tuple[str, Leaf | Group], ...]


@dataclass(frozen=True)
class _Token:
    kind: str
    text: str
    at: int


def _tokens(q: str) -> list[_Token]:
    out, at = [], 0
    while at < len(q):
        found = _SYNTAX.match(q, at)
        if found is None:
            raise QueryStringError(f"{q[at]!r} does not fit", at)
        kind, text = found.lastgroup, found.group()
        if kind == "term" and text in ("AND", "OR", "NOT"):
            kind = "word"
        if kind == "both":
            kind, text = "word", "AND" if text == "&&" else "OR"
        if (kind, text) == ("mark", "!"):
            kind, text = "word", "NOT"
        if kind != "blank":
            out.append(_Token(kind, text, at))
        at = found.end()
    return [*out, _Token("end", "", len(q))]


class _Reader:
    """Reads tokens from left to right into clauses."""

    def __init__(self, q: str, operator: str):
        self._tokens, self._next, self._all = _tokens(q), 0, operator == "and"

    def _peek(self, *kinds: str, text: str | None = None) -> bool:
        token = self._tokens[self._next]
        return token.kind in kinds and (text is None or token.text == text)

    def _take(self) -> _Token:
        self._next += 1
        return self._tokens[self._next - 1]

    def read(self) -> Group:
        whole = self._group(None)
        if not self._peek("end"):
            raise QueryStringError("unexpected ')'", self._tokens[self._next].at)
        return whole

    def _group(self, field: str | None) -> Group:
        clauses: list[tuple[str, Leaf | Group]] = []
        while not self._peek("end") and not self._peek("mark", text=")"):
            joint = self._joint(bool(clauses))
            sign = self._sign()
            node = self._clause(field)
            # A joint also speaks about the clause before it.
            if clauses and clauses[-1][0] != MUST_NOT:
                if joint == "AND":
                    clauses[-1] = (MUST, clauses[-1][1])
                elif joint == "OR" and self._all:
                    clauses[-1] = (SHOULD, clauses[-1][1])
            if sign == MUST_NOT:
                occur = MUST_NOT
            elif self._all:
                occur = SHOULD if joint == "OR" and sign != MUST else MUST
            else:
                occur = MUST if sign == MUST or joint == "AND" else SHOULD
            clauses.append((occur, node))
        return Group(tuple(clauses))

    def _joint(self, inside: bool) -> str | None:
        if self._peek("word", text="AND") or self._peek("word", text="OR"):
            token = self._take()
            if not inside:
                raise QueryStringError(f"{token.text} has nothing before it", token.at)
            return token.text
        return None

    def _sign(self) -> str | None:
        if self._peek("mark", text="+"):
            self._take()
            return MUST
        if self._peek("mark", text="-") or self._peek("word", text="NOT"):
            self._take()
            return MUST_NOT
        return None

    def _clause(self, field: str | None) -> Leaf | Group:
        token = self._take()
        if token.kind == "term" and self._peek("mark", text=":"):
            self._take()
            field = _plain(token.text)
            token = self._take()
        if token.kind == "mark" and token.text == "(":
            node: Leaf | Group = self._group(field)
            if not self._peek("mark", text=")"):
                raise QueryStringError("'(' is not closed", token.at)
            self._take()
        else:
            node = self._leaf(token, field)
        if self._peek("boost"):
            self._take()
        return node

    def _leaf(self, token: _Token, field: str | None) -> Leaf:
        text = token.text
        if token.kind == "quoted":
            slop = self._number(0)
            return Leaf("phrase", field, _plain(text[1:-1]), int(slop))
        if token.kind == "regex":
            return Leaf("regex", field, text[1:-1].replace("\\/", "/"))
        if token.kind in ("range", "compare"):
            return Leaf(token.kind, field, text)
        if token.kind != "term":
            what = "the end" if token.kind == "end" else repr(text)
            raise QueryStringError(f"a clause is wanted, not {what}", token.at)
        if text == "*":
            return Leaf("exists", None if field == "*" else field, text)
        if self._peek("fuzzy"):
            return Leaf("fuzzy", field, _plain(text), self._edits(_plain(text)))
        bare = re.sub(r"\\.", "", text, flags=re.DOTALL)
        if "*" in bare or "?" in bare:
            return Leaf("wildcard", field, text)
        return Leaf("exists", _plain(text), text) if field == "_exists_" else Leaf("text", field, _plain(text))

    def _number(self, usual: float) -> float:
        if not self._peek("fuzzy"):
            return usual
        digits = self._take().text[1:]
        return float(digits) if digits.strip(".") else usual

    def _edits(self, word: str) -> int:
        """A whole number of edits, or the share of the word that must agree, as in older queries."""
        number = self._number(2)
        return int((1 - number) * len(word)) if 0 < number < 1 else int(number)


def _plain(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def parse_query(q: str, default_operator: str = "or") -> Group:
    """The clauses of a query string."""
    if default_operator.lower() not in ("or", "and"):
        raise ValueError(f"operator {default_operator!r} is neither 'or' nor 'and'")
    return _Reader(q, default_operator.lower()).read()


def query_string(
    q: str,
    default_field: str | list[str] | None = None,
    default_operator: str = "or",
    analyzer: Analyzer | None = None,
    lowercase_expanded_terms: bool = True,
    analyze_wildcard: bool = False,
    lenient: bool = False,
    dictionary: DataFrame | None = None,
) -> Condition:
    """The condition that a query string describes.

    Without ``default_field`` a clause without a field asks all string fields.  ``analyzer`` takes the
    place of the fields' own for the words of the query.  With ``lenient`` a text that is no value of a
    number field matches nothing instead of being an error.  ``dictionary`` serves patterns and fuzzy
    terms, see :func:`.conditions.some_term`.  A clause whose words are all stop words is left out;
    a query without any clause finds nothing.
    """
    whole = parse_query(q, default_operator)

    def condition(df: DataFrame, mapping: FieldMapping) -> Column:
        asked = [default_field] if isinstance(default_field, str) else default_field
        if asked is None:
            asked = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]

        def one_field(leaf: Leaf, field: str) -> Condition | None:
            if field not in df.columns:
                return none_of(None)
            kind = df.schema[field].dataType
            element = kind.elementType if isinstance(kind, T.ArrayType) else kind
            words = isinstance(element, T.StringType)

            def value(text: str):
                """A bound or value of a field that is not text."""
                if words:
                    return text
                found = df.sparkSession.sql("SELECT 1").select(F.lit(text).try_cast(element)).first()[0]
                if found is None and not lenient:
                    raise ValueError(f"{text!r} is no value of the field {field!r}")
                return found

            if leaf.kind in ("range", "compare"):
                bounds = _bounds(leaf)
                known = {name: value(_expanded(text, words)) for name, text in bounds.items()}
                return none_of(None) if None in known.values() else range_(field, **known)
            if not words:
                if leaf.kind not in ("text", "phrase"):
                    raise ValueError(f"the field {field!r} holds no text for {leaf.text!r}")
                known = value(leaf.text)
                return none_of(None) if known is None else term(field, known)
            if leaf.kind == "regex":
                return regexp(field, _expanded(leaf.text, words), dictionary)
            if leaf.kind == "fuzzy":
                return fuzzy(field, leaf.text, min(leaf.number, 2), lowercase_expanded_terms, dictionary=dictionary)
            if leaf.kind == "wildcard":
                return some_term(field, like_pattern(_like(leaf.text, field)), dictionary)
            if field in mapping.keywords:
                return term(field, leaf.text)
            found = analyzed(df.sparkSession, analyzer or mapping.analyzer(field), leaf.text)
            if not any(w is not None for w in found):
                return None
            if leaf.kind == "phrase":
                return lambda df, mapping: in_order(mapping.slots(df, field), found, leaf.number)
            join = all_of if default_operator.lower() == "and" else any_of
            return join(*[term(field, w) for w in found if w is not None])

        def _expanded(text: str, words: bool) -> str:
            return text.lower() if words and lowercase_expanded_terms else text

        def _like(text: str, field: str) -> list[str]:
            parts: list[str] = []
            for piece in re.findall(r"(?:\\.|[^*?\\])+|[*?]", text, re.DOTALL):
                if piece in "*?":
                    parts.append("%" if piece == "*" else "_")
                    continue
                plain = _plain(piece)
                if analyze_wildcard and field not in mapping.keywords:
                    own = analyzed(df.sparkSession, analyzer or mapping.analyzer(field), plain)
                    plain = "".join(w for w in own if w is not None)
                parts += [literal_like(c) for c in _expanded(plain, True)]
            return parts

        def leaf_condition(leaf: Leaf) -> Condition | None:
            if leaf.kind == "exists":
                if leaf.field is not None and leaf.field not in df.columns:
                    return none_of(None)
                return all_of() if leaf.field is None else exists(leaf.field)
            fields = asked if leaf.field is None else [leaf.field]
            parts = [c for c in (one_field(leaf, f) for f in fields) if c is not None]
            return any_of(*parts) if parts else None

        def build(node: Leaf | Group) -> Condition | None:
            if isinstance(node, Leaf):
                return leaf_condition(node)
            kept: dict[str, list[Condition]] = {MUST: [], SHOULD: [], MUST_NOT: []}
            for occur, part in node.clauses:
                built = build(part)
                if built is not None:
                    kept[occur].append(built)
            if not any(kept.values()):
                return None
            needed = kept[MUST] or ([any_of(*kept[SHOULD])] if kept[SHOULD] else [])
            return all_of(*needed, *([none_of(*kept[MUST_NOT])] if kept[MUST_NOT] else []))

        built = build(whole)
        return F.lit(False) if built is None else built(df, mapping)

    return condition


def _bounds(leaf: Leaf) -> dict[str, str]:
    if leaf.kind == "compare":
        sign, text = re.fullmatch(r"([<>]=?)(.*)", leaf.text, re.DOTALL).groups()
        return {{">": "gt", ">=": "gte", "<": "lt", "<=": "lte"}[sign]: _plain(text)}
    low, high = _BOUNDS.fullmatch(leaf.text).groups()
    names = "gte" if leaf.text[0] == "[" else "gt", "lte" if leaf.text[-1] == "]" else "lt"
    texts = [_plain(t[1:-1] if t[0] == '"' else t) for t in (low, high)]
    return {n: t for n, t in zip(names, texts) if t != "*"}
