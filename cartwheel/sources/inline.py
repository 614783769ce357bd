"""Inline typed rows as a relation.

For small reference data written in code or a script, the way a table
initialiser lists rows in ``VALUES``. The rows pass through the driver, so
this is for hand-written sets only, never for data that grows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import CONFORMED_SCHEMA


def inline_rows(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType = CONFORMED_SCHEMA) -> DataFrame:
    """A DataFrame of ``rows`` with a fixed schema (types are checked)."""
    return spark.createDataFrame(list(rows), schema=schema, verifySchema=True)
