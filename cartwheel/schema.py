"""Column names, types and fixed values of the orders data model.

Every job in the package works on one flat table of nine order columns. The
raw form holds text (CSV landing files, crawled catalog tables); the conformed
form is typed. Extra columns in a source are ignored because every job selects
by name.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names, order, types and bounds of the reference's tables. ---
# Column order of the raw landing files and of the conformed table.
ORDER_COLUMNS: tuple[str, ...] = (
    "order_id",
    "customer_id",
    "order_date",
    "product_category",
    "city",
    "order_amount",
    "order_status",
    "payment_status",
    "updated_at",
)

# Values that must be present after conversion; the load refuses the batch
# otherwise, and the target table declares them NOT NULL.
REQUIRED_COLUMNS: tuple[str, ...] = (
    "order_id",
    "customer_id",
    "order_date",
    "order_amount",
    "updated_at",
)

# Columns the city extract needs from its source.
EXTRACT_COLUMNS: tuple[str, ...] = ("city", "updated_at")

KEY_COLUMN = "order_id"

MONEY = T.DecimalType(12, 2)
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Every column read as text: the CSV source is read without inference.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in ORDER_COLUMNS])

# Conformed orders. Timestamps carry no zone, like the relational target.
CONFORMED_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType(), True),
        T.StructField("customer_id", T.StringType(), True),
        T.StructField("order_date", T.DateType(), True),
        T.StructField("product_category", T.StringType(), True),
        T.StructField("city", T.StringType(), True),
        T.StructField("order_amount", MONEY, True),
        T.StructField("order_status", T.StringType(), True),
        T.StructField("payment_status", T.StringType(), True),
        T.StructField("updated_at", T.TimestampNTZType(), True),
    ]
)

# Column definitions of the relational target, in table order. Text bounds
# and NOT NULL mirror the target table; Spark enforces the VARCHAR bound on
# insert but drops NOT NULL, so quality.constraint_violations checks those.
TABLE_COLUMNS: tuple[tuple[str, str, bool], ...] = (
    ("order_id", "BIGINT", True),
    ("customer_id", "VARCHAR(32)", True),
    ("order_date", "DATE", True),
    ("product_category", "VARCHAR(100)", False),
    ("city", "VARCHAR(100)", False),
    ("order_amount", "DECIMAL(12,2)", True),
    ("order_status", "VARCHAR(32)", False),
    ("payment_status", "VARCHAR(32)", False),
    ("updated_at", "TIMESTAMP_NTZ", True),
)
# --- end of fixed values ---

# Text bounds of the target table, used by the constraint check.
TEXT_BOUNDS: dict[str, int] = {
    name: int(kind[len("VARCHAR(") : -1])
    for name, kind, _ in TABLE_COLUMNS
    if kind.startswith("VARCHAR(")
}

# --- Fixed values: these must equal the reference's generator lists. ---
CITIES: tuple[str, ...] = ("Kolkata", "Mumbai", "Bangalore", "Delhi", "Hyderabad", "Pune", "Chennai")
CATEGORIES: tuple[str, ...] = ("Electronics", "Fashion", "Grocery", "Home", "Beauty", "Sports")
# The statuses that the generator draws.
DRAWN_ORDER_STATUSES: tuple[str, ...] = ("PLACED", "SHIPPED", "DELIVERED")
DRAWN_PAYMENT_STATUSES: tuple[str, ...] = ("PAID", "PENDING")
GENERATOR_SEED = 42
GENERATOR_ROWS = 500
GENERATOR_FIRST_ORDER_ID = 100000
GENERATOR_START_DATE = "2026-01-01"
GENERATOR_DATE_SPAN_DAYS = 60
GENERATOR_CUSTOMERS = 300
GENERATOR_MAX_HOURS = 48
GENERATOR_MIN_AMOUNT = "300.00"
GENERATOR_MAX_AMOUNT = "75000.00"
EXTRACT_CITY = "Kolkata"
# --- end of fixed values ---


def missing_columns(columns, required=ORDER_COLUMNS) -> list[str]:
    """Names in ``required`` that ``columns`` lacks, sorted."""
    present = set(columns)
    return sorted(c for c in set(required) if c not in present)
