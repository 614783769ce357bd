"""Row filters (F1-F3). All are plain predicates Catalyst can push to the scan."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_present(df: DataFrame, name: str) -> DataFrame:
    """drop rows whose ``name`` is NULL."""
    return df.filter(F.col(name).isNotNull())


def keep_equal(df: DataFrame, name: str, value) -> DataFrame:
    """keep rows where ``name`` equals ``value`` exactly (case-sensitive)."""
    return df.filter(F.col(name) == F.lit(value))


def any_null(names: Iterable[str]) -> Column:
    """true when at least one of ``names`` is NULL."""
    tests = [F.col(n).isNull() for n in names]
    if not tests:
        return F.lit(False)
    return functools.reduce(operator.or_, tests)
