"""Relational sink over JDBC (K1, K3).

Each task writes its partition over its own connection in batches and commits
it by itself, so a JDBC append is not atomic across partitions; for an
all-or-nothing load, append to a staging table and move the rows with one
statement in the database. ``num_partitions`` caps the number of concurrent
connections (Spark coalesces to it before writing).

The target's column types come from ``createTableColumnTypes`` when Spark
creates the table on first write. NOT NULL and PRIMARY KEY cannot be declared
that way; the loads gate on them before writing instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..plans.params import check_table_name
from ..schema import TABLE_COLUMNS
from ..sources.jdbc import JdbcConnection

# JDBC column types for the table Spark creates (text bounds and money scale).
_JDBC_TYPES = {"TIMESTAMP_NTZ": "TIMESTAMP"}


def create_table_column_types(columns=TABLE_COLUMNS) -> str:
    """K3: ``createTableColumnTypes`` value: ``customer_id VARCHAR(32), ...``."""
    return ", ".join(f"{name} {_JDBC_TYPES.get(kind, kind)}" for name, kind, _ in columns)


def jdbc_write_options(
    conn: JdbcConnection,
    table: str,
    batch_size: int = 1000,
    num_partitions: int | None = None,
    create_types: bool = True,
    truncate: bool = False,
    isolation_level: str | None = None,
) -> dict[str, str]:
    check_table_name(table)
    opts = conn.options()
    opts.update({"dbtable": table, "batchsize": str(batch_size)})
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    if create_types:
        opts["createTableColumnTypes"] = create_table_column_types()
    if truncate:
        opts["truncate"] = "true"
    if isolation_level:
        opts["isolationLevel"] = isolation_level
    return opts


def append_jdbc(df: DataFrame, conn: JdbcConnection, table: str, **kwargs) -> None:
    """K1: append rows; the table is created with typed columns if missing.

    Re-running the same batch appends it again unless the table has a key.
    """
    df.write.format("jdbc").options(**jdbc_write_options(conn, table, **kwargs)).mode("append").save()


def overwrite_jdbc(df: DataFrame, conn: JdbcConnection, table: str, **kwargs) -> None:
    """Replace the rows, keeping the table definition (``TRUNCATE`` then insert)."""
    kwargs.setdefault("truncate", True)
    df.write.format("jdbc").options(**jdbc_write_options(conn, table, **kwargs)).mode("overwrite").save()
