"""One row per key with a defined survivor.

The survivor is the row with the latest ``updated_at``; ties are broken by the
other columns, largest first, and NULL sorts lowest, so the choice is
repeatable on every run and every retry.

Plan: ``max`` over a struct (ordering column first, then every other column)
grouped by the key. Spark runs it as a partial aggregate before the shuffle
and a final one after it, so each map task sends at most one row per key. A
hot key (for example NULL, which groups like any value) therefore costs one
row per map task in the shuffle, not a third of the table in one reducer. A
``row_number() = 1`` window gets the same only while the optimizer inserts a
partial window group limit (a threshold setting); the aggregate always does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import KEY_COLUMN

_PICK = "__survivor"


def dedup_latest(
    df: DataFrame,
    key: str | Sequence[str] = KEY_COLUMN,
    order_by: Sequence[str] = ("updated_at",),
) -> DataFrame:
    """Keep one row per ``key``: the greatest (``order_by``, other columns)."""
    keys = [key] if isinstance(key, str) else list(key)
    columns = df.columns
    rest = [c for c in columns if c not in keys and c not in order_by]
    ordered = [*order_by, *rest]
    picked = df.groupBy(*keys).agg(
        F.max(F.struct(*[F.col(c) for c in ordered])).alias(_PICK)
    )
    return picked.select(
        *[F.col(c) if c in keys else F.col(f"{_PICK}.{c}").alias(c) for c in columns]
    )
