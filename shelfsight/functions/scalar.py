"""Null-safe column helpers.

Missing is always NULL here, never NaN, and no helper raises on bad input:
the session runs in ANSI mode, so casts and divisions go through ``try_`` forms.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_DATE_PATTERNS = ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "yyyyMMdd")


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def clip(x: Column, low=None, high=None) -> Column:
    """Limit to [low, high]; NULL stays NULL (``greatest``/``least`` would skip it)."""
    out = x
    if low is not None:
        out = F.greatest(out, as_column(low))
    if high is not None:
        out = F.least(out, as_column(high))
    return F.when(x.isNotNull(), out)


def strip(x: Column) -> Column:
    """Remove all white space at both ends, not just blanks."""
    return F.regexp_replace(x.cast("string"), r"(?U)^\s+|\s+$", "")


def is_blank(x: Column) -> Column:
    """Missing, or text without anything but white space."""
    return x.isNull() | ~x.cast("string").rlike(r"(?U)\S")


def not_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def number(df: DataFrame, name: str) -> Column:
    """The column as double; text that is no number becomes NULL."""
    return numeric(F.col(name), df.schema[name].dataType)


def numeric(x: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return not_nan(x.cast("double"))
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return x.cast("double")
    text = x.cast("string")
    # The pattern keeps out spellings only Spark reads as numbers, such as "1d".
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def timestamp(df: DataFrame, name: str, patterns: tuple[str, ...] = _DATE_PATTERNS) -> Column:
    """The column as timestamp; text in none of the patterns becomes NULL."""
    x = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return x.cast("timestamp_ntz")
    text = strip(x)
    return F.coalesce(
        text.try_cast("timestamp_ntz"), *[F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz") for p in patterns]
    )


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, NULL where bottom is 0 or NULL."""
    return F.try_divide(top, bottom)


def finite(x: Column) -> Column:
    """x where it is a finite number, else NULL."""
    return F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def lookup(key: Column, mapping: Mapping[str, object]) -> Column:
    """Value of ``key`` in a small fixed mapping, NULL when absent."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def any_of(conditions) -> Column:
    conditions = list(conditions)
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def all_of(conditions) -> Column:
    conditions = list(conditions)
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


def flag(condition: Column) -> Column:
    """A condition with "unknown" read as false."""
    return F.coalesce(condition, F.lit(False))


def col_or(df: DataFrame, name: str, default) -> Column:
    """The column, or a constant when the frame does not have it."""
    return F.col(name) if name in df.columns else as_column(default)


def thousands(x: Column, decimals: int = 0) -> Column:
    return F.format_number(x, decimals)
