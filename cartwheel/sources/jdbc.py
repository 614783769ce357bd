"""Relational source over JDBC (S3).

The reference reads its table over one connection. Here the read can be split
into ``num_partitions`` range queries on a numeric column, each executor task
opening its own connection; filters on plain columns (``city = 'Kolkata'``)
and the column list are pushed into the SQL Spark sends. Credentials come from
the caller only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..plans.params import check_identifier, check_jdbc_url, check_table_name


@dataclass(frozen=True)
class JdbcConnection:
    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        check_jdbc_url(self.url)
        opts = {"url": self.url}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        if self.driver:
            opts["driver"] = self.driver
        opts.update(self.properties)
        return opts


def jdbc_read_options(
    conn: JdbcConnection,
    table: str,
    fetch_size: int = 1000,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    prefer_timestamp_ntz: bool = True,
) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``.

    With ``partition_column`` all of bounds and ``num_partitions`` are needed;
    the bounds only set the stride, rows outside them are still read.
    """
    check_table_name(table)
    opts = conn.options()
    opts.update({"dbtable": table, "fetchsize": str(fetch_size)})
    if prefer_timestamp_ntz:
        opts["preferTimestampNTZ"] = "true"
    if partition_column is not None:
        check_identifier(partition_column, "partition column")
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC reads need lower_bound, upper_bound and num_partitions")
        if lower_bound > upper_bound:
            raise ValueError("lower_bound must not exceed upper_bound")
        opts.update(
            {
                "partitionColumn": partition_column,
                "lowerBound": str(lower_bound),
                "upperBound": str(upper_bound),
                "numPartitions": str(num_partitions),
            }
        )
    return opts


def read_jdbc(spark: SparkSession, conn: JdbcConnection, table: str, **kwargs) -> DataFrame:
    """S3: a table over JDBC. The driver asks the database for the schema."""
    return spark.read.format("jdbc").options(**jdbc_read_options(conn, table, **kwargs)).load()


def key_bounds(spark: SparkSession, conn: JdbcConnection, table: str, column: str) -> tuple[int, int] | None:
    """Smallest and largest ``column`` value, computed by the database."""
    check_table_name(table)
    check_identifier(column, "column")
    opts = conn.options()
    opts["query"] = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(**opts).load().first()
    if row is None or row["lo"] is None:
        return None
    return int(row["lo"]), int(row["hi"])
