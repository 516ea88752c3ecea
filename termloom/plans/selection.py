"""Pages and samples far down an order, without sorting all rows."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from . import numbering
from .sizing import settle

# Rows are cut into about so many intervals at a time, by pivots from a sample so many times as large.
INTERVALS = 64
SAMPLED_PER_INTERVAL = 32
ROUNDS = 6


class Order(NamedTuple):
    """One column of a total order."""

    name: str
    descending: bool = False
    nulls_last: bool = False

    def column(self) -> Column:
        value = F.col(self.name)
        if self.descending:
            return value.desc_nulls_last() if self.nulls_last else value.desc_nulls_first()
        return value.asc_nulls_last() if self.nulls_last else value.asc_nulls_first()

    def ahead(self, bound) -> Column:
        """Whether a row comes before a value of this column."""
        value = F.col(self.name)
        if bound is None:
            return value.isNotNull() if self.nulls_last else F.lit(False)
        less = value > F.lit(bound) if self.descending else value < F.lit(bound)
        return F.coalesce(less, F.lit(not self.nulls_last))


def _up_to(order: list[Order], pivot: Row) -> Column:
    """Whether a row comes before the pivot or is at its place."""
    result = F.lit(True)
    for by in reversed(order):
        bound = pivot[by.name]
        result = by.ahead(bound) | (F.col(by.name).eqNullSafe(F.lit(bound)) & result)
    return result


def _pivots(rows: DataFrame, order: list[Order], n: int) -> list[Row]:
    """Places that cut the rows into intervals of like size, give or take."""
    wanted = INTERVALS * SAMPLED_PER_INTERVAL
    sampled = rows.sample(fraction=min(1.0, wanted / n), seed=n).orderBy(*[by.column() for by in order])
    # A sample far beyond its usual size is as good when cut.
    found = sampled.limit(4 * wanted).collect()
    step = max(1, len(found) // INTERVALS)
    return list(dict.fromkeys(found[step::step]))


def page(rows: DataFrame, order: list[Order], from_: int, size: int) -> DataFrame:
    """``size`` rows from row ``from_`` on, with ``row`` counting from 0; the last columns of ``order`` are unique.

    Only intervals that hold the page are sorted.  A sample gives pivots, one pass counts the rows up to each of them
    exactly, and the rows between the two pivots around the page go on, until sorting them costs no more than the page
    itself.  The sample decides how much is sorted, never which rows are found.
    """
    names = [by.name for by in order]
    rest = settle(rows.select(*names, *[c for c in rows.columns if c not in names]))
    n, before = rest.count(), 0
    for _ in range(ROUNDS):
        if n <= max(2 * size, numbering.TOP_K_ROWS):
            break
        pivots = _pivots(rest.select(*names), order, n)
        if not pivots:
            break
        tests = [_up_to(order, p) for p in pivots]
        counts = [0, *rest.agg(*[F.count_if(t).alias(f"c{i}") for i, t in enumerate(tests)]).first(), n]
        first, last = from_ - before, from_ - before + size
        low = max(i for i, c in enumerate(counts) if c <= max(first, 0) and i < len(counts) - 1)
        high = min((i for i, c in enumerate(counts) if c >= min(last, n) and i > low), default=len(counts) - 1)
        kept = counts[high] - counts[low]
        if kept >= n:
            break
        above = [] if low == 0 else [~tests[low - 1]]
        below = [] if high == len(counts) - 1 else [tests[high - 1]]
        rest = settle(rest.where(reduce(lambda a, b: a & b, above + below)))
        n, before = kept, before + counts[low]
    by = [o.column() for o in order]
    start = from_ - before
    if start + size <= numbering.TOP_K_ROWS:
        return rest.orderBy(*by).offset(start).limit(size).withColumn("row", F.monotonically_increasing_id())
    numbered = numbering.row_index(rest, by)
    found = numbered.where((F.col("row") >= start) & (F.col("row") < start + size))
    return found.withColumn("row", F.col("row") - start)
