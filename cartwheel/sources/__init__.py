"""Sources: each returns a lazy DataFrame."""

from .catalog import scan_catalog, select_all
from .files import (
    CSV_READ_OPTIONS,
    footer_count,
    read_raw_csv,
    refresh_parquet_partitions,
    register_csv_table,
    register_parquet_table,
)
from .fixture import raw_orders, raw_orders_from, tpch_orders
from .generate import generate_orders, orders_for_rows
from .inline import inline_rows
from .jdbc import JdbcConnection, jdbc_read_options, key_bounds, read_jdbc

__all__ = [
    "CSV_READ_OPTIONS",
    "JdbcConnection",
    "footer_count",
    "generate_orders",
    "inline_rows",
    "jdbc_read_options",
    "key_bounds",
    "orders_for_rows",
    "raw_orders",
    "raw_orders_from",
    "read_jdbc",
    "read_raw_csv",
    "refresh_parquet_partitions",
    "register_csv_table",
    "register_parquet_table",
    "scan_catalog",
    "select_all",
    "tpch_orders",
]
