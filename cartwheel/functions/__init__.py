"""Column-level helpers: built-in Spark expressions only, no UDFs."""

from .dates import add_days, add_hours, date_text, month_of, timestamp_text, year_month_of
from .hashing import choice, draw, padded_id, uniform_cents, uniform_int
from .parse import to_date, to_long, to_money, to_text, to_timestamp
from .text import strip_spaces, tidy_city, title_case

__all__ = [
    "add_days",
    "add_hours",
    "choice",
    "date_text",
    "draw",
    "month_of",
    "padded_id",
    "strip_spaces",
    "tidy_city",
    "timestamp_text",
    "title_case",
    "to_date",
    "to_long",
    "to_money",
    "to_text",
    "to_timestamp",
    "uniform_cents",
    "uniform_int",
    "year_month_of",
]
