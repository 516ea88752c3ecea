"""Document-term matrices on Spark."""

from .functions.conditions import (
    all_of,
    any_of,
    exists,
    fuzzy,
    ids,
    match,
    match_all,
    none_of,
    phrase,
    prefix,
    range_,
    regexp,
    term,
    terms,
    wildcard,
)
from .functions.query_string import QueryStringError, query_string
from .functions.text import Analyzer, FieldMapping, analyze, keyword, parse_date
from .functions.wordbreak import standard_analyzer, url_email_analyzer
from .operators.matrix import Matrix
from .operators.search import Collection, random_order
from .plans.spec import Feature, FeatureSpec
from .sources.corpus import field_mapping, load_corpus, scan_indices
from .sources.names import scan_matching
from .sources.sinks import write_batches, write_market, write_market_batches, write_matrix

__all__ = [
    "Analyzer",
    "Collection",
    "Feature",
    "FeatureSpec",
    "FieldMapping",
    "Matrix",
    "QueryStringError",
    "all_of",
    "analyze",
    "any_of",
    "exists",
    "field_mapping",
    "fuzzy",
    "ids",
    "keyword",
    "load_corpus",
    "match",
    "match_all",
    "none_of",
    "parse_date",
    "phrase",
    "prefix",
    "query_string",
    "random_order",
    "range_",
    "regexp",
    "scan_indices",
    "scan_matching",
    "standard_analyzer",
    "term",
    "terms",
    "url_email_analyzer",
    "wildcard",
    "write_batches",
    "write_market",
    "write_market_batches",
    "write_matrix",
]
