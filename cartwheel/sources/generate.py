"""Synthetic orders as a distributed job.

Each row is a pure function of (seed, row number): the eight columns are
drawn from the 32-bit words of two MD5 digests, ``md5("seed:0:row")`` and
``md5("seed:1:row")``. No state is shared between rows, so the job is
one narrow stage over ``spark.range`` (or any DataFrame of row numbers), the
output does not depend on the partition count, and a retried task redraws the
same values. Dates and timestamps come out as text, the way the raw landing
files hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.hashing import cents_in_range, draw, draws, in_range, padded_id, pick
from ..schema import (
    CATEGORIES,
    CITIES,
    DRAWN_ORDER_STATUSES,
    DRAWN_PAYMENT_STATUSES,
    GENERATOR_CUSTOMERS,
    GENERATOR_DATE_SPAN_DAYS,
    GENERATOR_FIRST_ORDER_ID,
    GENERATOR_MAX_AMOUNT,
    GENERATOR_MAX_HOURS,
    GENERATOR_MIN_AMOUNT,
    GENERATOR_ROWS,
    GENERATOR_SEED,
    GENERATOR_START_DATE,
)


def _cents(amount: str) -> int:
    whole, _, frac = amount.partition(".")
    return int(whole) * 100 + int((frac + "00")[:2])


def generate_orders(
    spark: SparkSession,
    n: int = GENERATOR_ROWS,
    seed: int = GENERATOR_SEED,
    num_partitions: int | None = None,
) -> DataFrame:
    """``n`` synthetic orders, rows 1..n."""
    if n < 0:
        raise ValueError("n must not be negative")
    rows = spark.range(1, n + 1, numPartitions=num_partitions).select(F.col("id").alias("row"))
    return orders_for_rows(rows, "row", seed)


# Draw streams, in digest order: the first four share one digest, the rest the next.
STREAMS: tuple[str, ...] = (
    "customer_id",
    "order_date",
    "updated_at",
    "order_amount",
    "product_category",
    "city",
    "order_status",
    "payment_status",
)


def orders_for_rows(df: DataFrame, row: str = "row", seed: int = GENERATOR_SEED) -> DataFrame:
    """Draw one order per value of the ``row`` column (a positive integer)."""
    r = F.col(row)
    u = draws(seed, r, STREAMS)
    order_date = dates.add_days(
        F.to_date(F.lit(GENERATOR_START_DATE)), in_range(u["order_date"], 0, GENERATOR_DATE_SPAN_DAYS)
    )
    updated_at = dates.add_hours(order_date, in_range(u["updated_at"], 1, GENERATOR_MAX_HOURS))
    return df.select(
        (F.lit(GENERATOR_FIRST_ORDER_ID) + r).cast("bigint").alias("order_id"),
        padded_id("C", in_range(u["customer_id"], 1, GENERATOR_CUSTOMERS), 4).alias("customer_id"),
        dates.date_text(order_date).alias("order_date"),
        pick(u["product_category"], CATEGORIES).alias("product_category"),
        pick(u["city"], CITIES).alias("city"),
        cents_in_range(
            u["order_amount"], _cents(GENERATOR_MIN_AMOUNT), _cents(GENERATOR_MAX_AMOUNT)
        ).alias("order_amount"),
        pick(u["order_status"], DRAWN_ORDER_STATUSES).alias("order_status"),
        pick(u["payment_status"], DRAWN_PAYMENT_STATUSES).alias("payment_status"),
        dates.timestamp_text(updated_at).alias("updated_at"),
    )


def draw_column(seed: int, stream: str, row: Column) -> Column:
    """The raw 32-bit draw, exposed for tests and oracles."""
    return draw(seed, stream, row)
