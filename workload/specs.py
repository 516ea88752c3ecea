"""Specifications and settings shared by the queries and their SQL twins."""

from termloom import FeatureSpec, FieldMapping

WORDS = ["the", "of", "and", "le", "der", "la", "los", "is", "that", "was"]
LANGS = ["en", "fr", "de", "es"]
STOP_WORDS = ("the", "of", "and", "to", "in", "de", "la", "le", "der", "die")
KEYWORDS = FieldMapping(keywords=frozenset({"lang", "source", "role", "event_type"}))
SEED = 7
BATCH = 128
PAGE_FROM, PAGE_SIZE = 20, 30
N_SIGNIFICANT = 10
N_PER_CLASS = 3000
ASKED = ["idiot", "moron", "les", "was"]
N_SLOTS = 5


def text_spec(option: str) -> FeatureSpec:
    return FeatureSpec.from_spec([{"field": "text", "span": WORDS, "value": option}])


def mixed_entries() -> list[dict]:
    """Terms, keyword terms and two numeric fields side by side; the label is the last column."""
    return [
        {"field": "text", "span": WORDS, "value": "term_freq"},
        {"field": "lang", "span": LANGS, "value": "binary"},
        {"field": "n_chars", "span": 1},
        {"field": "toxic", "span": 1},
    ]


MIXED_COLS = len(WORDS) + len(LANGS) + 2
