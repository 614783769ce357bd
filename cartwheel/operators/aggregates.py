"""Group summaries.

All aggregates here are algebraic (count, sum), so Spark computes them as a
partial hash aggregate in each map task and merges one row per group per task
after the shuffle. A city holding a third of all rows costs the same shuffle
as any other city.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import month_of, year_month_of

# Exact average of decimal(12,2) values fits the same type after rounding.
AVERAGE_TYPE = T.DecimalType(12, 2)


def exact_average(total, count):
    """A3 + X5: ``round(sum / count, 2)``, NULL when nothing was counted.

    Spark's ``avg`` on decimal(12,2) keeps six decimals and then rounds again,
    which can move the last cent; one division of the exact sum rounds once.
    """
    return F.round(F.try_divide(total, count), 2).cast(AVERAGE_TYPE)


REVENUE_TYPE = T.DecimalType(22, 2)  # sum of decimal(12,2), as Spark types it
REVENUE_COLUMNS = ("city", "order_count", "total_revenue", "average_order_value")


def city_revenue_parts(df: DataFrame, city: str = "city", amount: str = "order_amount") -> DataFrame:
    """The additive parts of the city revenue: row count, exact sum, count of amounts.

    Parts of two batches add up to the parts of both, so a summary can be
    kept up to date from each new batch alone (``merge_revenue_parts``).
    """
    return df.groupBy(F.col(city).alias("city")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(amount).cast(REVENUE_TYPE).alias("total_revenue"),
        F.count(amount).alias("amount_count"),
    )


def merge_revenue_parts(*parts: DataFrame) -> DataFrame:
    """Add up revenue parts city by city (a NULL city is a group like any other)."""
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy("city").agg(
        F.sum("order_count").cast("bigint").alias("order_count"),
        F.sum("total_revenue").cast(REVENUE_TYPE).alias("total_revenue"),
        F.sum("amount_count").cast("bigint").alias("amount_count"),
    )


def finish_revenue(parts: DataFrame, keep_parts: bool = False) -> DataFrame:
    """The public columns from the parts (``amount_count`` kept on request)."""
    cols = [
        "city",
        "order_count",
        "total_revenue",
        exact_average(F.col("total_revenue"), F.col("amount_count")).alias("average_order_value"),
    ]
    return parts.select(*cols, *(["amount_count"] if keep_parts else []))


def city_revenue(df: DataFrame, city: str = "city", amount: str = "order_amount") -> DataFrame:
    """A1-A4: orders, revenue and average order value per city.

    ``order_count`` counts every row (NULL amounts included); the average
    divides by the non-NULL amounts only.
    """
    return finish_revenue(city_revenue_parts(df, city, amount))


def city_month_distribution(
    df: DataFrame, city: str = "city", ts: str = "updated_at", sort: bool = True, with_year: bool = False
) -> DataFrame:
    """A5 + X4 + O1: rows per (city, month of ``ts``), sorted by both.

    The month has no year by default, as in the original query (``with_year``
    gives ``yyyymm``); NULL timestamps form their own group.
    """
    month = year_month_of if with_year else month_of
    out = df.groupBy(F.col(city).alias("city"), month(F.col(ts)).alias("month")).agg(
        F.count(F.lit(1)).alias("record_count")
    )
    return out.orderBy("city", "month") if sort else out


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """The whole-table row count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(name))
