"""Text analysis as column expressions: everything stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as a token.  The second pattern first tries a URL, then an e-mail address.
WORD_PATTERN = r"[\p{L}\p{N}_]+"
URL_EMAIL_PATTERN = r"https?://[^\s]+|[^\s@]+@[^\s@]+\.[\p{L}]+|[\p{L}\p{N}_]+"

NO_TOKENS = "array<string>"


@dataclass(frozen=True)
class Analyzer:
    """Tokenize, drop stop words, lower-case.

    With ``stop_before_lower`` the stop list meets the tokens as written, so that capitalised
    stop words survive; otherwise it meets lower-cased tokens.
    """

    pattern: str = WORD_PATTERN
    lowercase: bool = True
    stop_words: tuple[str, ...] = ()
    stop_before_lower: bool = False
    max_token_length: int | None = None

    @property
    def drops(self) -> bool:
        """Whether tokens may be left out, so that a place in the array is no position."""
        return bool(self.stop_words) or self.max_token_length is not None

    def _found(self, text: Column) -> tuple[Column, bool]:
        late = self.lowercase and self.stop_before_lower and bool(self.stop_words)
        source = F.lower(text) if self.lowercase and not late else text
        return F.regexp_extract_all(source, F.lit(self.pattern), F.lit(0)), late

    def _keeps(self, token: Column) -> Column:
        keeps = F.lit(True) if self.max_token_length is None else F.length(token) <= self.max_token_length
        return keeps & ~token.isin(*self.stop_words) if self.stop_words else keeps

    def tokens(self, text: Column) -> Column:
        found, late = self._found(text)
        if self.drops:
            found = F.filter(found, self._keeps)
        if late:
            found = F.transform(found, F.lower)
        return F.coalesce(found, F.array().cast(NO_TOKENS))

    def slots(self, text: Column) -> Column:
        """The tokens by position: null where one is left out."""
        if not self.drops:
            return self.tokens(text)
        found, late = self._found(text)
        placed = F.transform(found, lambda t: F.when(self._keeps(t), F.lower(t) if late else t))
        return F.coalesce(placed, F.array().cast(NO_TOKENS))


def analyze(text: Column, analyzer: Analyzer | None = None) -> Column:
    return (analyzer or Analyzer()).tokens(text)


def analyzed(spark: SparkSession, analyzer: Analyzer, text: str) -> list[str | None]:
    """The tokens of one short text by position, such as those of a query; null where one is left out."""
    return spark.sql("SELECT 1").select(analyzer.slots(F.lit(text))).first()[0]


def keyword(value: Column) -> Column:
    """A string that is not analyzed: the whole value is its one term."""
    return F.array_compact(F.array(value))


@dataclass(frozen=True)
class FieldMapping:
    """How string fields become terms: ``keywords`` as they are, all others through an analyzer."""

    keywords: frozenset[str] = frozenset()
    analyzers: Mapping[str, Analyzer] = field(default_factory=dict)
    default: Analyzer = Analyzer()

    def analyzer(self, name: str) -> Analyzer:
        return self.analyzers.get(name, self.default)

    def tokens(self, df: DataFrame, name: str) -> Column:
        if ready_name(name) in df.columns:
            return F.col(ready_name(name))
        kind, value = df.schema[name].dataType, F.col(name)
        if isinstance(kind, T.StringType):
            return keyword(value) if name in self.keywords else self.analyzer(name).tokens(value)
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            values = F.coalesce(F.array_compact(value), F.array().cast(NO_TOKENS))
            if name in self.keywords:
                return values
            return F.flatten(F.transform(values, self.analyzer(name).tokens))
        raise ValueError(f"field {name!r} of type {kind.simpleString()} holds no terms")

    def slots(self, df: DataFrame, name: str) -> Column:
        """The tokens of a field by position; the values of an array follow each other."""
        kind, analyzer = df.schema[name].dataType, self.analyzer(name)
        if name in self.keywords or not analyzer.drops:
            return self.tokens(df, name)
        if isinstance(kind, T.ArrayType):
            values = F.coalesce(F.array_compact(F.col(name)), F.array().cast(NO_TOKENS))
            return F.flatten(F.transform(values, analyzer.slots))
        return analyzer.slots(F.col(name))


def ready_name(field: str) -> str:
    """The column that holds the tokens of a field once they are worked out."""
    return f"__tokens:{field}"


def with_ready_tokens(df: DataFrame, fields: list[str], mapping: FieldMapping) -> DataFrame:
    """Add the tokens of some fields for several uses, such as a filter and a count.

    A generated column is what the optimizer neither copies into a filter nor pushes one below, so
    each text is analyzed once.
    """
    for name in fields:
        df = df.select("*", F.explode_outer(F.array(mapping.tokens(df, name))).alias(ready_name(name)))
    return df


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """Bind an expensive expression to a lambda variable, so that it runs once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of one document, counted inside its own row.

    Sorting brings equal tokens together; a run ends where the next one starts.
    """

    def count(ordered: Column) -> Column:
        starts = F.filter(
            F.transform(
                ordered,
                lambda t, i: F.when(
                    ~t.eqNullSafe(F.get(ordered, i - 1)), F.struct(t.alias("term"), i.alias("at"))
                ),
            ),
            lambda start: start.isNotNull(),
        )

        def lengths(runs: Column) -> Column:
            def one(run: Column, i: Column) -> Column:
                end = F.coalesce(F.get(runs, i + 1)["at"], F.size(ordered))
                return F.struct(run["term"].alias("term"), (end - run["at"]).alias("tf"))

            return F.transform(runs, one)

        return once(starts, lengths)

    return once(F.sort_array(tokens), count)


def parse_date(value: Column, pattern: str, strict: bool = False) -> Column:
    """Timestamp from text.  A leading weekday carries no information and is left out.

    Text that is no such date gives null, or with ``strict`` an error.
    """
    if pattern.startswith("EEE "):
        value, pattern = F.substr(value, F.lit(5)), pattern[4:]
    return (F.to_timestamp if strict else F.try_to_timestamp)(value, F.lit(pattern) if not strict else pattern)
