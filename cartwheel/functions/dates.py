"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import DATE_FORMAT, TIMESTAMP_FORMAT


def month_of(c: Column) -> Column:
    """Month number 1-12 of a date or timestamp, without the year."""
    return F.month(c)


def year_month_of(c: Column) -> Column:
    """Month key with the year, yyyymm, for callers who must keep years apart."""
    return F.year(c) * 100 + F.month(c)


def add_days(start: Column, days: Column) -> Column:
    """Date plus whole days."""
    return F.date_add(start, days.cast("int"))


def add_hours(ts: Column, hours: Column) -> Column:
    """Timestamp (or date at midnight) plus whole hours, without a zone."""
    return ts.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hours.cast("int"))


def date_text(c: Column) -> Column:
    """``yyyy-MM-dd``."""
    return F.date_format(c, DATE_FORMAT)


def timestamp_text(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(c, TIMESTAMP_FORMAT)
