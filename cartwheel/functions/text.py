"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_spaces(c: Column) -> Column:
    """Remove spaces at both ends (spaces only, not tabs)."""
    return F.trim(c)


def title_case(c: Column) -> Column:
    """Upper-case the first letter of each space-separated word, lower the rest."""
    return F.initcap(c)


def tidy_city(c: Column) -> Column:
    """X1 + X2: ``"  DELHI "`` becomes ``"Delhi"``."""
    return title_case(strip_spaces(c))
