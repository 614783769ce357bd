"""DuckDB SQL that states each registered query's expected result.

The driver registers the test tables as views (``orders`` among them); each
statement inlines the dirty raw view and the conformed forms as CTEs. Column
names and types follow the Spark results (decimal(22,2) sums, INTEGER months,
zone-free timestamps).
"""

from __future__ import annotations

from ..schema import (
    CATEGORIES,
    CITIES,
    DRAWN_ORDER_STATUSES,
    DRAWN_PAYMENT_STATUSES,
    EXTRACT_CITY,
    GENERATOR_CUSTOMERS,
    GENERATOR_FIRST_ORDER_ID,
    GENERATOR_MAX_HOURS,
    GENERATOR_SEED,
    GENERATOR_START_DATE,
    TEXT_BOUNDS,
)
from ..sources.fixture import ORACLE_RAW_ORDERS_SQL

_NORM = """
SELECT TRY_CAST(order_id AS BIGINT) AS order_id,
       customer_id,
       CAST(TRY_STRPTIME(order_date, '%Y-%m-%d') AS DATE) AS order_date,
       product_category,
       city,
       TRY_CAST(order_amount AS DECIMAL(12,2)) AS order_amount,
       order_status,
       payment_status,
       TRY_STRPTIME(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM raw
"""

_TIDY = """
SELECT TRY_CAST(order_id AS BIGINT) AS order_id,
       customer_id,
       CAST(TRY_STRPTIME(order_date, '%Y-%m-%d') AS DATE) AS order_date,
       product_category,
       upper(left(trim(city), 1)) || lower(substr(trim(city), 2)) AS city,
       TRY_CAST(order_amount AS DECIMAL(12,2)) AS order_amount,
       order_status,
       payment_status,
       TRY_STRPTIME(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at,
       CAST(EXTRACT(MONTH FROM TRY_STRPTIME(updated_at, '%Y-%m-%d %H:%M:%S')) AS INTEGER) AS updated_month
FROM raw
WHERE order_id IS NOT NULL
"""

_REQUIRED_NULL = (
    "order_id IS NULL OR customer_id IS NULL OR order_date IS NULL "
    "OR order_amount IS NULL OR updated_at IS NULL"
)

_COLS = (
    "order_id, customer_id, order_date, product_category, city, order_amount, "
    "order_status, payment_status, updated_at"
)

_SURVIVOR_ORDER = (
    "updated_at DESC NULLS LAST, customer_id DESC NULLS LAST, order_date DESC NULLS LAST, "
    "product_category DESC NULLS LAST, city DESC NULLS LAST, order_amount DESC NULLS LAST, "
    "order_status DESC NULLS LAST, payment_status DESC NULLS LAST"
)


def _dedup(source: str) -> str:
    return f"""
SELECT {_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {_SURVIVOR_ORDER}) AS rn
  FROM {source}
) WHERE rn = 1
"""


_CTES = (
    "WITH raw AS ("
    + ORACLE_RAW_ORDERS_SQL
    + "),\nnorm AS ("
    + _NORM
    + "),\ntidy AS ("
    + _TIDY
    + "),\nvalid AS (SELECT * FROM norm WHERE NOT ("
    + _REQUIRED_NULL
    + ")),\nconformed AS ("
    + _dedup("valid")
    + "),\ndedup AS ("
    + _dedup("norm")
    + ")\n"
)


def _with(body: str) -> str:
    return _CTES + body


_REVENUE = """
SELECT city,
       COUNT(*) AS order_count,
       CAST(SUM(order_amount) AS DECIMAL(22,2)) AS total_revenue,
       CAST(ROUND(SUM(order_amount) / CAST(COUNT(order_amount) AS DECIMAL(20,0)), 2) AS DECIMAL(12,2))
         AS average_order_value
FROM tidy GROUP BY city
"""

_EXTRACT = f"""
SELECT {_COLS}, CAST(EXTRACT(MONTH FROM updated_at) AS INTEGER) AS month
FROM dedup WHERE city = '{EXTRACT_CITY}' AND updated_at IS NOT NULL
"""


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_STREAMS = (
    "customer_id", "order_date", "updated_at", "order_amount",
    "product_category", "city", "order_status", "payment_status",
)


def _draw(stream: str) -> str:
    digest, word = divmod(_STREAMS.index(stream), 4)
    key = f"'{GENERATOR_SEED}:{digest}:' || CAST(o_orderkey + 1 AS VARCHAR)"
    return f"CAST('0x' || substr(md5({key}), {1 + 8 * word}, 8) AS BIGINT)"


def _pick(values, stream: str) -> str:
    return f"{_sql_list(values)}[CAST({_draw(stream)} % {len(values)} AS INTEGER) + 1]"


_GENERATED = f"""
WITH g AS (
  SELECT o_orderkey,
         DATE '{GENERATOR_START_DATE}' + CAST({_draw('order_date')} % 61 AS INTEGER) AS od,
         CAST({_draw('updated_at')} % {GENERATOR_MAX_HOURS} + 1 AS INTEGER) AS hrs
  FROM orders
)
SELECT CAST({GENERATOR_FIRST_ORDER_ID} + o_orderkey + 1 AS BIGINT) AS order_id,
       'C' || lpad(CAST({_draw('customer_id')} % {GENERATOR_CUSTOMERS} + 1 AS VARCHAR), 4, '0') AS customer_id,
       strftime(od, '%Y-%m-%d') AS order_date,
       {_pick(CATEGORIES, 'product_category')} AS product_category,
       {_pick(CITIES, 'city')} AS city,
       CAST(CAST(30000 + {_draw('order_amount')} % 7470001 AS DECIMAL(12,0)) / 100 AS DECIMAL(12,2)) AS order_amount,
       {_pick(DRAWN_ORDER_STATUSES, 'order_status')} AS order_status,
       {_pick(DRAWN_PAYMENT_STATUSES, 'payment_status')} AS payment_status,
       strftime(CAST(od AS TIMESTAMP) + to_hours(hrs), '%Y-%m-%d %H:%M:%S') AS updated_at
FROM g
"""


def _constraints() -> str:
    parts = [
        f"SELECT 'not_null' AS constraint_name, '{c}' AS column_name, "
        f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM norm"
        for c in ("order_id", "customer_id", "order_date", "order_amount", "updated_at")
    ]
    parts += [
        f"SELECT 'max_length' AS constraint_name, '{c}' AS column_name, "
        f"CAST(COUNT(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) AS violations FROM norm"
        for c, n in TEXT_BOUNDS.items()
    ]
    return "\nUNION ALL\n".join(parts)


ORACLES: dict[str, str] = {
    "scan_csv_strings": _with("SELECT * FROM raw"),
    "scan_catalog": _with("SELECT * FROM raw"),
    "register_csv_inferred": _with("SELECT * FROM norm"),
    "register_parquet_partitions": _with(_EXTRACT),
    "register_csv_recrawled": _with("SELECT * FROM norm"),
    "register_partitions_diff": _with(f"SELECT * FROM ({_EXTRACT}) WHERE month <> 1"),
    "generate_orders": _GENERATED,
    "normalize_orders": _with("SELECT * FROM norm"),
    "tidy_orders": _with("SELECT * FROM tidy"),
    "invalid_rows": _with(f"SELECT * FROM norm WHERE {_REQUIRED_NULL}"),
    "invalid_month_rows": _with(
        f"SELECT {_COLS}, CAST(EXTRACT(MONTH FROM updated_at) AS INTEGER) AS month "
        f"FROM norm WHERE city = '{EXTRACT_CITY}' AND updated_at IS NULL"
    ),
    "dedup_latest": _with("SELECT * FROM dedup"),
    "city_revenue": _with(_REVENUE),
    "city_month_distribution": _with(
        "SELECT city, CAST(EXTRACT(MONTH FROM updated_at) AS INTEGER) AS month, COUNT(*) AS record_count "
        "FROM tidy GROUP BY 1, 2 ORDER BY 1, 2"
    ),
    "row_count": _with("SELECT COUNT(*) AS row_count FROM dedup"),
    "exists_probe": _with(f"SELECT EXISTS (SELECT 1 FROM norm WHERE {_REQUIRED_NULL}) AS has_invalid_rows"),
    "quality_report": _with(
        "SELECT COUNT(*) AS row_count, "
        "COUNT(*) FILTER (WHERE order_id IS NULL) AS null_order_id, "
        "COUNT(*) FILTER (WHERE customer_id IS NULL) AS null_customer_id, "
        "COUNT(*) FILTER (WHERE order_date IS NULL) AS null_order_date, "
        "COUNT(*) FILTER (WHERE order_amount IS NULL) AS null_order_amount, "
        "COUNT(*) FILTER (WHERE updated_at IS NULL) AS null_updated_at, "
        f"COUNT(*) FILTER (WHERE {_REQUIRED_NULL}) AS invalid_rows, "
        "COUNT(*) FILTER (WHERE EXTRACT(MONTH FROM updated_at) IS NULL) AS null_month "
        "FROM norm"
    ),
    "constraint_violations": _with(_constraints()),
    "duplicate_keys": _with(
        "SELECT order_id, COUNT(*) AS copies FROM norm WHERE order_id IS NOT NULL "
        "GROUP BY order_id HAVING COUNT(*) > 1"
    ),
    "sink_csv_roundtrip": _with("SELECT * FROM norm"),
    "sink_parquet_roundtrip": _with("SELECT * FROM norm"),
    "sink_parquet_by_month": _with(
        f"SELECT {_COLS}, CAST(EXTRACT(MONTH FROM updated_at) AS INTEGER) AS month FROM dedup WHERE updated_at IS NOT NULL"
    ),
    "sink_table_append": _with("SELECT * FROM dedup"),
    "create_table_if_missing": _with("SELECT * FROM dedup"),
    "ctas_replace": _with("SELECT * FROM dedup"),
    "city_revenue_table": _with(_REVENUE),
    "merge_latest_table": _with("SELECT * FROM dedup"),
    "stored_counts": _with(
        "SELECT 'append' AS sink, COUNT(*) AS reported_rows, COUNT(*) AS stored_rows FROM dedup "
        "UNION ALL SELECT 'months', COUNT(updated_at), COUNT(updated_at) FROM dedup"
    ),
    "job_load_orders": _with("SELECT * FROM conformed"),
    "job_load_orders_batches": _with("SELECT * FROM conformed"),
    "city_extract": _with(_EXTRACT),
    "job_city_revenue": _with(_REVENUE),
    "job_city_revenue_rerun": _with(_REVENUE),
    "job_city_revenue_incremental": _with(_REVENUE),
}
