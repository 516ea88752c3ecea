"""Numeric field values as matrix cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_MODES = ("keep", "int_compat")
_WRAP = 1 << 32
_HALF = 1 << 31


def is_numeric(kind: T.DataType) -> bool:
    return isinstance(
        kind,
        (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType),
    )


def cell_value(value: Column, kind: T.DataType, mode: str = "keep") -> Column:
    """A field value as a double.

    ``keep`` keeps the real value (dates as epoch milliseconds).  ``int_compat`` gives whole
    numbers only: longs wrap to 32 bits and every other type becomes -1.
    """
    if mode not in NUMERIC_MODES:
        raise ValueError(f"numeric mode {mode!r} is not one of {', '.join(NUMERIC_MODES)}")
    if mode == "int_compat":
        if isinstance(kind, T.LongType):
            low = value.bitwiseAND(F.lit(_WRAP - 1)) + F.lit(_HALF)
            return (low.bitwiseAND(F.lit(_WRAP - 1)) - F.lit(_HALF)).cast("double")
        if not isinstance(kind, (T.BooleanType, T.ShortType, T.IntegerType)):
            return F.when(value.isNotNull(), F.lit(-1.0))
    if isinstance(kind, T.TimestampType):
        return F.unix_millis(value).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value) * F.lit(86_400_000.0)
    if isinstance(kind, T.TimestampNTZType):
        return _wall_clock_millis(value)
    return value.cast("double")


def _wall_clock_millis(value: Column) -> Column:
    # A timestamp without a zone is read as UTC, whatever the zone of the session.
    gap = value - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    units = {"DAY": 86_400_000, "HOUR": 3_600_000, "MINUTE": 60_000}
    whole = sum((F.extract(F.lit(u), gap).cast("bigint") * F.lit(n) for u, n in units.items()), F.lit(0))
    return (whole + F.floor(F.extract(F.lit("SECOND"), gap) * 1000)).cast("double")


def seeded_digest(key: str | list[str], seed: int) -> Column:
    """A repeatable random string per key, the same for any partitioning and any engine."""
    names = [key] if isinstance(key, str) else list(key)
    parts = [F.coalesce(F.col(n).cast("string"), F.lit("")) if len(names) > 1 else F.col(n).cast("string") for n in names]
    return F.md5(F.concat_ws(":", *parts, F.lit(str(seed))))
