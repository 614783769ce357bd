"""Null-on-error conversions to the conformed types.

Sources may hold text (CSV, crawled tables) or typed columns (Parquet, JDBC).
Each converter picks its expression from the input type at plan time, so the
result is one JVM expression per column, inside whole-stage codegen. Invalid
values become NULL, with ANSI mode on or off, and the quality gate decides
what happens to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DATE_FORMAT, MONEY, TIMESTAMP_FORMAT

# The shape of TIMESTAMP_FORMAT.
_STAMP = r"\A-?[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"

# A whole number written with a zero fraction.
_ZERO_FRACTION = r"\A\s*[+-]?[0-9]+\.0*\s*\z"


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def to_long(df: DataFrame, name: str) -> Column:
    """64-bit integer; a value with a fraction is NULL, one whose fraction is zero is whole.

    The rule is the same for text and for numbers, so ``5.0`` is 5 whether a
    column was read as text or inferred as a double. Text may have spaces
    around; other characters give NULL.
    """
    value = F.col(name)
    dtype = _dtype(df, name)
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.when(value == F.floor(value), value.try_cast(T.LongType()))
    if isinstance(dtype, T.StringType):
        whole = F.when(value.rlike(_ZERO_FRACTION), F.split_part(value, F.lit("."), F.lit(1)).try_cast(T.LongType()))
        return F.coalesce(value.try_cast(T.LongType()), whole)
    return value.try_cast(T.LongType())


def to_text(df: DataFrame, name: str) -> Column:
    """Text. Length bounds belong to the table definition (VARCHAR(n))."""
    if isinstance(_dtype(df, name), T.StringType):
        return F.col(name)
    return F.col(name).try_cast(T.StringType())


def to_money(df: DataFrame, name: str) -> Column:
    """P5: decimal(12,2); extra digits round half up, overflow gives NULL."""
    return F.col(name).try_cast(MONEY)


def to_date(df: DataFrame, name: str, fmt: str = DATE_FORMAT) -> Column:
    """Date from text in ``fmt``; DATE and TIMESTAMP input pass through."""
    dtype = _dtype(df, name)
    if isinstance(dtype, T.DateType):
        return F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(F.col(name))
    return F.try_to_date(F.col(name).cast(T.StringType()), fmt)


def to_timestamp(df: DataFrame, name: str, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Timestamp without time zone from text in ``fmt``.

    The shape decides what is tried, and one cast to a zone-free wall clock
    decides validity, so the session time zone never shifts it. Patterns other
    than the default are tested by ``try_to_timestamp`` first.
    Typed input is converted to the same wall clock.
    """
    dtype = _dtype(df, name)
    if isinstance(dtype, T.TimestampNTZType):
        return F.col(name)
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return F.col(name).cast(T.TimestampNTZType())
    text = F.col(name).cast(T.StringType())
    valid = text.rlike(_STAMP) if fmt == TIMESTAMP_FORMAT else F.try_to_timestamp(text, F.lit(fmt)).isNotNull()
    return F.when(valid, text.try_cast(T.TimestampNTZType()))
