"""Score formulas."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def significance(count: Column, size: Column, bg_count: Column, bg_size: Column) -> Column:
    """Absolute times relative change of a term's share: ``(f - b) * (f / b)``."""
    f = F.try_divide(count.cast("double"), size.cast("double"))
    b = F.try_divide(bg_count.cast("double"), bg_size.cast("double"))
    return (f - b) * F.try_divide(f, b)


def inverse_doc_freq(n_docs: int, doc_freq: int) -> float:
    return math.log((n_docs + 1) / (doc_freq + 1))
