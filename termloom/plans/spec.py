"""Feature specification: which columns a document-term matrix has, and in which order.

A specification is a small immutable value on the driver.  A column is either one term of a
text field or one value slot of a numeric field, and its position never depends on data.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

# The names of the value options and of the keys of a specification entry.
VALUE_OPTIONS = ("binary", "term_freq", "doc_freq", "ttf")
DEFAULT_OPTION = "term_freq"
ENTRY_KEYS = ("field", "span", "value")


class Feature(NamedTuple):
    """One column: exactly one of ``term`` (text field) and ``slot`` (numeric field) is set."""

    field: str
    term: str | None = None
    slot: int | None = None


@dataclass(frozen=True)
class FeatureSpec:
    features: tuple[Feature, ...] = ()
    options: tuple[tuple[str, str], ...] = ()
    numeric_fields: tuple[str, ...] = ()

    # -- building ---------------------------------------------------------------------------
    @classmethod
    def from_spec(cls, entries: Iterable[Mapping]) -> "FeatureSpec":
        """Check ``{field, span, value}`` entries and lay out their columns in order."""
        return cls().extend(entries)

    def extend(self, entries: Iterable[Mapping]) -> "FeatureSpec":
        """Append entries; the columns that are already there keep their positions."""
        features = dict.fromkeys(self.features)
        options = dict(self.options)
        numeric = dict.fromkeys(self.numeric_fields)
        for position, entry in enumerate(entries):
            field, span, option = _checked(position, entry)
            if isinstance(span, int):
                numeric[field] = None
                features.update(dict.fromkeys(Feature(field, slot=i) for i in range(span)))
            else:
                options[field] = option
                features.update(dict.fromkeys(Feature(field, term=word) for word in span))
        return FeatureSpec(tuple(features), tuple(options.items()), tuple(numeric))

    def extend_terms(self, field: str, terms: Iterable[str]) -> "FeatureSpec":
        """Append terms of a text field and keep the value option the field has now."""
        option = dict(self.options).get(field, DEFAULT_OPTION)
        return self.extend([{"field": field, "span": list(terms), "value": option}])

    def set_value(self, field: str, option: str) -> "FeatureSpec":
        """Change the value option of one field; columns stay as they are."""
        options = dict(self.options)
        options[field] = _option(option)
        return FeatureSpec(self.features, tuple(options.items()), self.numeric_fields)

    def head(self, n_cols: int) -> "FeatureSpec":
        """The first ``n_cols`` columns alone (all but the label, for a training set)."""
        kept = self.features[:n_cols]
        slots = {f.field for f in kept if f.slot is not None}
        terms = {f.field for f in kept if f.term is not None}
        return FeatureSpec(
            kept,
            tuple((f, o) for f, o in self.options if f in terms),
            tuple(f for f in self.numeric_fields if f in slots),
        )

    # -- reading ----------------------------------------------------------------------------
    @property
    def n_cols(self) -> int:
        return len(self.features)

    def option(self, field: str) -> str:
        return dict(self.options)[field]

    def term_columns(self) -> dict[str, tuple[list[str], list[int]]]:
        """Per text field: its terms in column order, and the column of each."""
        found: dict[str, tuple[list[str], list[int]]] = {}
        for col, feature in enumerate(self.features):
            if feature.term is not None:
                terms, cols = found.setdefault(feature.field, ([], []))
                terms.append(feature.term)
                cols.append(col)
        return found

    def slot_columns(self) -> dict[str, list[int]]:
        """Per numeric field: the column of value slot 0, 1, 2, ..."""
        found: dict[str, list[int]] = {}
        for col, feature in enumerate(self.features):
            if feature.slot is not None:
                found.setdefault(feature.field, []).append(col)
        return found

    @property
    def needs_statistics(self) -> bool:
        used = self.term_columns()
        return any(o in ("doc_freq", "ttf") for f, o in self.options if f in used)

    @property
    def all_binary(self) -> bool:
        return all(o == "binary" for _, o in self.options)

    def vocabulary(self, spark: SparkSession) -> DataFrame:
        """Columns as rows: ``(col, field, term, slot)``."""
        rows = [(col, f.field, f.term, f.slot) for col, f in enumerate(self.features)]
        return spark.createDataFrame(rows, "col int, field string, term string, slot int")

    def feature_names(self) -> list[str]:
        """``field=term`` or ``field[slot]`` for every column."""
        return [
            f"{f.field}={f.term}" if f.term is not None else f"{f.field}[{f.slot}]"
            for f in self.features
        ]

    # -- keeping a specification beside a model -----------------------------------------------
    def to_json(self) -> str:
        return json.dumps(
            {
                "features": [list(f) for f in self.features],
                "options": [list(o) for o in self.options],
                "numeric_fields": list(self.numeric_fields),
            },
            ensure_ascii=False,
        )

    @classmethod
    def from_json(cls, text: str) -> "FeatureSpec":
        raw = json.loads(text)
        return cls(
            tuple(Feature(*f) for f in raw["features"]),
            tuple((f, o) for f, o in raw["options"]),
            tuple(raw["numeric_fields"]),
        )

    def save(self, path: str) -> None:
        """Write to any path that Spark can write, as one line of JSON."""
        line = SparkSession.builder.getOrCreate().createDataFrame([(self.to_json(),)], "value string")
        line.coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, path: str) -> "FeatureSpec":
        return cls.from_json(SparkSession.builder.getOrCreate().read.text(path).first()["value"])


def _checked(position: int, entry: Mapping) -> tuple[str, int | list[str], str]:
    unknown = [k for k in entry if k not in ENTRY_KEYS]
    if unknown:
        raise ValueError(f"entry {position}: unknown parameter {unknown[0]!r}")
    if entry.get("field") is None:
        raise ValueError(f"entry {position}: the parameter 'field' is required")
    option = _option(entry.get("value", DEFAULT_OPTION))
    span = entry.get("span", [])
    if isinstance(span, (int, float)) and not isinstance(span, bool):
        return str(entry["field"]), max(int(span), 0), option
    if isinstance(span, (list, tuple)):
        if any(not isinstance(w, (str, int, float)) for w in span):
            raise ValueError(f"entry {position}: a span lists plain terms only")
        return str(entry["field"]), [_term(w) for w in span], option
    raise ValueError(f"entry {position}: 'span' must be a list of terms or one integer")


def _term(value: str | int | float | bool) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def _option(name: str) -> str:
    option = str(name).lower()
    if option not in VALUE_OPTIONS:
        raise ValueError(f"value option {name!r} is not one of {', '.join(VALUE_OPTIONS)}")
    return option
