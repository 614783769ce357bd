"""Conform raw orders to typed columns.

Two shapes exist because the two loads differ on purpose:

* ``normalize_orders`` is the strict load: all nine columns, each converted,
  city kept as it is.
* ``tidy_orders`` is the CSV load: rows without a key are dropped before the
  key is converted, the city is trimmed and title-cased, and the update month
  is added.

Both are narrow projections: no shuffle, and Catalyst prunes unused columns
and pushes later filters on untouched columns into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, parse, text
from ..schema import ORDER_COLUMNS
from .filters import keep_present
from .quality import require_columns


def conversions(df: DataFrame) -> dict[str, Column]:
    """The typed expression of each of the nine columns, in order."""
    return {
        "order_id": parse.to_long(df, "order_id"),
        "customer_id": parse.to_text(df, "customer_id"),
        "order_date": parse.to_date(df, "order_date"),
        "product_category": parse.to_text(df, "product_category"),
        "city": parse.to_text(df, "city"),
        "order_amount": parse.to_money(df, "order_amount"),
        "order_status": parse.to_text(df, "order_status"),
        "payment_status": parse.to_text(df, "payment_status"),
        "updated_at": parse.to_timestamp(df, "updated_at"),
    }


def normalize_orders(df: DataFrame) -> DataFrame:
    """P1 + P3-P7: the fixed, ordered, typed select list of the strict load.

    Raises ``ValueError`` naming the missing columns (sorted) when the source
    lacks any of the nine; extra columns are ignored.
    """
    require_columns(df, ORDER_COLUMNS, "source")
    return df.select(*[value.alias(name) for name, value in conversions(df).items()])


def tidy_orders(df: DataFrame) -> DataFrame:
    """F1 + P2 + X1-X3: the CSV load's transform, with ``updated_month`` last.

    The key filter tests the raw value, so a key that is present but not a
    number passes and becomes NULL.
    """
    require_columns(df, ORDER_COLUMNS, "source")
    present = keep_present(df, "order_id")
    converted = present.withColumns(
        {
            "order_id": parse.to_long(present, "order_id"),
            "order_date": parse.to_date(present, "order_date"),
            "order_amount": parse.to_money(present, "order_amount"),
            "updated_at": parse.to_timestamp(present, "updated_at"),
            "city": text.tidy_city(F.col("city")),
        }
    )
    with_month = converted.withColumn("updated_month", dates.month_of(F.col("updated_at")))
    return with_month.select(*ORDER_COLUMNS, "updated_month")
