"""Job plans (W1-W3), parameter guards (W4) and the registered queries."""

from .jobs import (
    JobResult,
    city_revenue_job,
    city_rows,
    conform_orders,
    extract_city,
    load_orders,
    refresh_city_revenue,
    seed_orders,
    tidy_load,
)
from .journal import Journal
from .reuse import kept, staged
from .params import check_identifier, check_jdbc_url, check_location, check_table_name

__all__ = [
    "JobResult",
    "Journal",
    "check_identifier",
    "check_jdbc_url",
    "check_location",
    "check_table_name",
    "city_revenue_job",
    "city_rows",
    "conform_orders",
    "extract_city",
    "load_orders",
    "kept",
    "refresh_city_revenue",
    "seed_orders",
    "staged",
    "tidy_load",
]
