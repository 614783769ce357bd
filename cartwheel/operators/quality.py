"""Data-quality checks and gates.

Reports are single-pass aggregates: every count is a ``count_if`` in one
global aggregate, computed as partial sums per task and merged in one final
task that sees one row per map task. Gates run that report once and raise;
nothing is collected but the one summary row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import KEY_COLUMN, REQUIRED_COLUMNS, TEXT_BOUNDS, missing_columns
from .filters import any_null


class QualityError(ValueError):
    """A batch failed a quality gate; nothing was written."""


def require_columns(df: DataFrame, required: Iterable[str], what: str = "source") -> None:
    """Q1: raise naming the missing columns, sorted, before any job runs."""
    missing = missing_columns(df.columns, tuple(required))
    if missing:
        raise ValueError(f"{what} lacks: {', '.join(missing)}")


def invalid_rows(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """rows where any required value is NULL (after conversion)."""
    return df.filter(any_null(required))


def null_month_rows(df: DataFrame, month: str = "month") -> DataFrame:
    """rows whose derived month is NULL (the timestamp was missing or bad)."""
    return df.filter(F.col(month).isNull())


def exists(df: DataFrame) -> bool:
    """L1: does at least one row exist? Stops at the first row found."""
    return not df.isEmpty()


def exists_flag(df: DataFrame, name: str) -> DataFrame:
    """L1 as a one-row DataFrame. The probe runs here, on ever more splits until a row is found."""
    return df.sparkSession.range(1).select(F.lit(exists(df)).alias(name))


def report_columns(
    required: Sequence[str] = REQUIRED_COLUMNS,
    month: str | None = None,
    bounds: dict[str, int] | None = None,
) -> list[Column]:
    """The aggregates of Q2/Q3 and, with ``bounds``, the overruns of Q5 (``over_<column>``).

    They can be aggregated on their own or observed while a batch is written.
    """
    aggs = [F.count(F.lit(1)).alias("row_count")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required]
    aggs.append(F.count_if(any_null(required)).alias("invalid_rows"))
    if month is not None:
        aggs.append(F.count_if(F.col(month).isNull()).alias("null_month"))
    aggs += [F.count_if(F.length(F.col(c)) > F.lit(n)).alias(f"over_{c}") for c, n in (bounds or {}).items()]
    return aggs


def quality_report(
    df: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    month: str | None = None,
) -> DataFrame:
    """Q2/Q3: one row with the row count and NULL counts of required values.

    ``invalid_rows`` counts rows with at least one required NULL; with
    ``month`` set, ``null_month`` counts rows whose month is NULL.
    """
    return df.agg(*report_columns(required, month))


def refuse_failures(report: dict, target: str = "batch") -> dict:
    """Raise ``QualityError`` if a count of ``report`` other than its rows is not zero; return the report."""
    failed = {name: n for name, n in report.items() if name.startswith(("null_", "over_")) and n}
    if failed:
        counts = ", ".join(f"{name}={n}" for name, n in failed.items())
        raise QualityError(f"{target}: {counts} of {report['row_count']} rows; nothing was written")
    return report


def gate_required(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> dict:
    """Q2: raise ``QualityError`` when a required value is NULL; return the report."""
    return refuse_failures(quality_report(df, required).first().asDict())


def gate_month(df: DataFrame, month: str = "month") -> dict:
    """Q3: raise ``QualityError`` when a partition month is NULL; return counts."""
    counts = [F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(month).isNull()).alias("null_month")]
    return refuse_failures(df.agg(*counts).first().asDict(), "month of updated_at")


def constraint_violations(
    df: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    bounds: dict[str, int] | None = None,
) -> DataFrame:
    """Q5: violations of the target table's NOT NULL and VARCHAR(n) rules.

    One row per declared constraint, zero counts included, from one
    aggregate. Spark's Parquet tables keep neither rule, so this runs as a
    gate before the write.
    """
    bounds = TEXT_BOUNDS if bounds is None else bounds
    checks: list[tuple[str, str, object]] = [("not_null", c, F.col(c).isNull()) for c in required]
    checks += [
        ("max_length", c, F.length(F.col(c)) > F.lit(n)) for c, n in bounds.items() if c in df.columns
    ]
    wide = df.agg(*[F.count_if(cond).alias(f"{kind}:{col}") for kind, col, cond in checks])
    names = [f"{kind}:{col}" for kind, col, _ in checks]
    long = wide.unpivot([], [F.col(f"`{n}`") for n in names], "constraint", "violations")
    return long.select(
        F.split_part(F.col("constraint"), F.lit(":"), F.lit(1)).alias("constraint_name"),
        F.split_part(F.col("constraint"), F.lit(":"), F.lit(2)).alias("column_name"),
        F.col("violations").cast("bigint").alias("violations"),
    )


def duplicate_keys(df: DataFrame, key: str = KEY_COLUMN) -> DataFrame:
    """Q6: keys held by more than one row (NULL keys excluded), with counts."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )
