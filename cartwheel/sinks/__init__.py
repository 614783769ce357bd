"""Sinks: each writes a DataFrame and returns what it wrote."""

from .batches import append_batch, batch_ledger, batch_rows, create_batch_table, drop_replaced_batches, known_batches
from .files import (
    CSV_WRITE_OPTIONS,
    SINK_FORMATS,
    write_csv,
    write_dataset,
    write_parquet,
    write_parquet_by_month,
)
from .jdbc import append_jdbc, create_table_column_types, jdbc_write_options, overwrite_jdbc
from .merge import merge_latest, merged_latest
from .tables import append_table, check_new_keys, create_table_if_missing, ctas_replace, publish_table, table_ddl

__all__ = [
    "CSV_WRITE_OPTIONS",
    "SINK_FORMATS",
    "append_batch",
    "append_jdbc",
    "append_table",
    "batch_ledger",
    "batch_rows",
    "check_new_keys",
    "create_batch_table",
    "create_table_column_types",
    "create_table_if_missing",
    "ctas_replace",
    "drop_replaced_batches",
    "jdbc_write_options",
    "known_batches",
    "merge_latest",
    "merged_latest",
    "overwrite_jdbc",
    "publish_table",
    "table_ddl",
    "write_csv",
    "write_dataset",
    "write_parquet",
    "write_parquet_by_month",
]
