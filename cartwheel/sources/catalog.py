"""Catalog sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.params import check_table_name


def scan_catalog(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    """A table registered in the session catalog (Hive metastore or another catalog service)."""
    name = f"{database}.{table}" if database else table
    check_table_name(name)
    return spark.table(name)


def select_all(spark: SparkSession, table: str) -> DataFrame:
    """``SELECT * FROM table`` for an ad-hoc look at a registered table."""
    check_table_name(table)
    return spark.sql(f"SELECT * FROM {table}")
