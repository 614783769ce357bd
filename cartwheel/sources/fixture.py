"""Dirty raw orders derived from the driver's TPC-H-like ``orders`` table.

This is test input, not a job: it turns every row of ``orders`` into raw text
orders with known defects (NULL key, non-numeric key, bad date, padded upper
case city, bad amount, NULL timestamp, a later second copy of some keys).

Two texts describe the same rows. The oracle text (for DuckDB) joins two
small VALUES lists; the Spark text needs no join at all: the city is an array
lookup and the second copy comes from ``explode`` of a one- or two-element
array, so the whole fixture is one narrow scan-project stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


_COLUMNS = """
  CASE WHEN o_orderkey % 97 = 0 THEN NULL
       WHEN o_orderkey % 89 = 0 THEN concat('X', cast(o_orderkey AS varchar(20)))
       ELSE cast(o_orderkey AS varchar(20)) END AS order_id,
  concat('C', lpad(cast(o_custkey AS varchar(20)), 6, '0')) AS customer_id,
  CASE WHEN o_orderkey % 83 = 0 THEN '2026-13-01'
       ELSE cast(cast(o_orderdate AS date) AS varchar(20)) END AS order_date,
  CASE o_orderkey % 6 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Fashion' WHEN 2 THEN 'Grocery'
       WHEN 3 THEN 'Home' WHEN 4 THEN 'Beauty' ELSE 'Sports' END AS product_category,
  CASE WHEN o_orderkey % 5 = 0 THEN concat('  ', upper(c.city), ' ') ELSE c.city END AS city,
  CASE WHEN o_orderkey % 79 = 0 THEN 'n/a' ELSE cast(o_totalprice AS varchar(30)) END AS order_amount,
  CASE o_orderstatus WHEN 'P' THEN 'PLACED' WHEN 'O' THEN 'SHIPPED' ELSE 'DELIVERED' END AS order_status,
  CASE WHEN o_orderkey % 2 = 0 THEN 'PAID' ELSE 'PENDING' END AS payment_status,
  CASE WHEN o_orderkey % 73 = 0 THEN NULL
       ELSE cast(o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 48 + 1 + 24 * d.copy) AS varchar(30)) END AS updated_at
"""

# DuckDB form over the registered ``orders`` view (FIXTURES.md section 4).
ORACLE_RAW_ORDERS_SQL = (
    "SELECT"
    + _COLUMNS
    + """FROM orders
JOIN (VALUES (0, 'Kolkata'), (1, 'Mumbai'), (2, 'Bangalore'), (3, 'Delhi'),
             (4, 'Hyderabad'), (5, 'Pune'), (6, 'Chennai')) AS c(k, city) ON o_custkey % 7 = c.k
JOIN (VALUES (0), (1)) AS d(copy) ON d.copy = 0 OR o_orderkey % 50 = 0
"""
)

# Spark form: same rows (o_custkey and o_orderkey are never NULL), no join.
SPARK_RAW_ORDERS_SQL = (
    "SELECT"
    # Spark treats VARCHAR(n) in a cast as plain text and warns about it.
    + _COLUMNS.replace("varchar(20)", "string").replace("varchar(30)", "string")
    + """FROM (
  SELECT o.*,
         named_struct('city', element_at(
             array('Kolkata', 'Mumbai', 'Bangalore', 'Delhi', 'Hyderabad', 'Pune', 'Chennai'),
             cast(o_custkey % 7 AS int) + 1)) AS c,
         named_struct('copy', copy) AS d
  FROM {orders} AS o
  LATERAL VIEW explode(CASE WHEN o_orderkey % 50 = 0 THEN array(0, 1) ELSE array(0) END) x AS copy
)
"""
)


def tpch_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``orders`` table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text raw orders built from ``{sf_dir}/orders.parquet``."""
    return raw_orders_from(spark, tpch_orders(spark, sf_dir))


def raw_orders_from(spark: SparkSession, orders: DataFrame) -> DataFrame:
    return spark.sql(SPARK_RAW_ORDERS_SQL, orders=orders)
