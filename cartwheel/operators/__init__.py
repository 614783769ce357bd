"""DataFrame -> DataFrame operators of the orders jobs."""

from .aggregates import city_month_distribution, city_revenue, exact_average, row_count
from .conform import normalize_orders, tidy_orders
from .dedup import dedup_latest
from .filters import any_null, keep_equal, keep_present
from .quality import (
    QualityError,
    constraint_violations,
    duplicate_keys,
    exists,
    exists_flag,
    gate_month,
    gate_required,
    invalid_rows,
    null_month_rows,
    quality_report,
    require_columns,
)

__all__ = [
    "QualityError",
    "any_null",
    "city_month_distribution",
    "city_revenue",
    "constraint_violations",
    "dedup_latest",
    "duplicate_keys",
    "exact_average",
    "exists",
    "exists_flag",
    "gate_month",
    "gate_required",
    "invalid_rows",
    "keep_equal",
    "keep_present",
    "normalize_orders",
    "null_month_rows",
    "quality_report",
    "require_columns",
    "row_count",
    "tidy_orders",
]
