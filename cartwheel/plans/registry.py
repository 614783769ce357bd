"""Registered queries: one callable per operator group, ``(spark, sf_dir) -> DataFrame``.

Every query starts from the given ``orders`` table (through the dirty raw
view) and runs over all of it. Queries that exercise a sink write to a fresh
folder or database under the session's scratch root (``spark.checkpoint.dir``)
and return what reading it back gives, so the result checks the round trip.
"""

from __future__ import annotations

import functools
import operator
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_of
from ..operators.aggregates import city_month_distribution, city_revenue, row_count
from ..operators.conform import conversions, normalize_orders, tidy_orders
from ..operators.dedup import dedup_latest
from ..operators.quality import (
    constraint_violations,
    duplicate_keys,
    exists_flag,
    invalid_rows,
    null_month_rows,
    quality_report,
)
from ..schema import CONFORMED_SCHEMA, REQUIRED_COLUMNS
from ..session import scratch_database, scratch_path
from ..sinks.batches import batch_rows
from ..sinks.files import CSV_WRITE_OPTIONS, write_csv, write_dataset, write_parquet, write_parquet_by_month
from ..sinks.merge import merge_latest
from ..sinks.tables import append_table, create_table_if_missing, ctas_replace, publish_table
from ..sources.catalog import scan_catalog, select_all
from ..sources.files import footer_count, read_raw_csv, refresh_parquet_partitions, register_csv_table, register_parquet_table
from ..sources.fixture import raw_orders, tpch_orders
from ..sources.generate import orders_for_rows
from ..storage import delete_path, table_location
from . import jobs
from .reuse import kept

Query = Callable[[SparkSession, str], DataFrame]


# --- inputs derived from the given tables -------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_orders(spark, sf_dir)


def _norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_orders(_raw(spark, sf_dir))


def passes_gate(df: DataFrame) -> DataFrame:
    """The rows of ``df``, unconverted, whose required values all convert: the load's success path."""
    values = conversions(df)
    return df.filter(functools.reduce(operator.and_, [values[c].isNotNull() for c in REQUIRED_COLUMNS]))


def _conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, one row each, invalid values NULL."""
    return dedup_latest(_norm(spark, sf_dir))


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders with an update time, which the month partitions need."""
    return _conformed(spark, sf_dir).filter(F.col("updated_at").isNotNull())


def _stored(df: DataFrame, name: str) -> str:
    """Store ``df`` as a catalog table in a fresh database; its name."""
    table = f"{scratch_database(df.sparkSession, name)}.{name}"
    df.write.format("parquet").saveAsTable(table)
    return table


def _land_raw_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the raw rows as CSV landing files and return the folder."""
    path = scratch_path(spark, "raw-orders-csv")
    write_dataset(_raw(spark, sf_dir), path, "csv", mode="overwrite", skip_empty=False)  # K8 -> K6
    return path


# --- sources -------------------------------------------------------------------------------


def q_scan_csv_strings(spark, sf_dir):
    """S1 (with K6 to land the files): raw CSV read back as all-text columns."""
    return read_raw_csv(spark, _land_raw_csv(spark, sf_dir))


def q_scan_catalog(spark, sf_dir):
    """S7 (and S2, used by ``job_load_orders``): the raw rows as a stored table, selected back."""
    return select_all(spark, _stored(_raw(spark, sf_dir), "orders_raw"))


def q_register_csv_inferred(spark, sf_dir):
    """CSV registered with schema inference, then conformed by the strict load."""
    path = _land_raw_csv(spark, sf_dir)
    db = scratch_database(spark, "csv_inferred")
    return normalize_orders(register_csv_table(spark, f"{db}.orders_csv", path))


def q_register_parquet_partitions(spark, sf_dir):
    """The month-partitioned extract registered as a table and read back."""
    path = scratch_path(spark, "orders-city-extract")
    write_parquet_by_month(jobs.city_rows(_dated(spark, sf_dir)), path)
    db = scratch_database(spark, "parquet_parts")
    return register_parquet_table(spark, f"{db}.orders_city", path)


def q_generate_orders(spark, sf_dir):
    """One synthetic order per row of ``orders`` (row number = o_orderkey + 1)."""
    rows = tpch_orders(spark, sf_dir).select((F.col("o_orderkey") + 1).alias("row"))
    return orders_for_rows(rows, "row")


def q_register_csv_recrawled(spark, sf_dir):
    """A clean first delivery crawled, then all other rows, with one more column; types are widened."""
    path, name = scratch_path(spark, "orders-deliveries"), f"{scratch_database(spark, 'recrawl')}.orders_csv"
    raw = _raw(spark, sf_dir)
    clean = F.lit(True)
    for c in conversions(raw).values():
        clean = clean & c.isNotNull()
    write_dataset(raw.filter(clean), f"{path}/first", "csv", skip_empty=False)
    register_csv_table(spark, name, path, files=f"{path}/first")
    others = raw.filter(~clean | clean.isNull()).withColumn("channel", F.lit("web"))
    write_dataset(others, f"{path}/second", "csv", skip_empty=False)
    return normalize_orders(register_csv_table(spark, name, path, merge=True, files=f"{path}/second"))


def q_register_partitions_diff(spark, sf_dir):
    """Month 3 arrives and month 1 goes after the registration; only these two partitions are altered."""
    path, name = scratch_path(spark, "orders-months"), f"{scratch_database(spark, 'months')}.orders_city"
    with kept(jobs.city_rows(_dated(spark, sf_dir))) as rows:
        write_parquet_by_month(rows.filter("month <> 3"), path)
        register_parquet_table(spark, name, path)
        write_parquet_by_month(rows.filter("month = 3"), path, partition_overwrite="dynamic")
    delete_path(spark, f"{path}/month=1")
    refresh_parquet_partitions(spark, name)
    return spark.table(name)


# --- transforms, filters, aggregates, checks -------------------------------------------------


def q_normalize_orders(spark, sf_dir):
    return _norm(spark, sf_dir)


def q_tidy_orders(spark, sf_dir):
    return tidy_orders(_raw(spark, sf_dir))


def q_invalid_rows(spark, sf_dir):
    return invalid_rows(_norm(spark, sf_dir))


def q_invalid_month_rows(spark, sf_dir):
    """F4 on the extract's shape: city rows with a derived month, month NULL."""
    return null_month_rows(jobs.city_rows(_norm(spark, sf_dir)))


def q_dedup_latest(spark, sf_dir):
    return dedup_latest(_norm(spark, sf_dir))


def q_city_revenue(spark, sf_dir):
    return city_revenue(tidy_orders(_raw(spark, sf_dir)))


def q_city_month_distribution(spark, sf_dir):
    return city_month_distribution(tidy_orders(_raw(spark, sf_dir)))


def q_row_count(spark, sf_dir):
    return row_count(dedup_latest(_norm(spark, sf_dir)))


def q_exists_probe(spark, sf_dir):
    return exists_flag(invalid_rows(_norm(spark, sf_dir)), "has_invalid_rows")


def q_quality_report(spark, sf_dir):
    norm = _norm(spark, sf_dir)
    return quality_report(norm.withColumn("month", month_of(F.col("updated_at"))), REQUIRED_COLUMNS, month="month")


def q_constraint_violations(spark, sf_dir):
    return constraint_violations(_norm(spark, sf_dir))


def q_duplicate_keys(spark, sf_dir):
    return duplicate_keys(_norm(spark, sf_dir))


# --- sinks -------------------------------------------------------------------------------------


def q_sink_csv_roundtrip(spark, sf_dir):
    """K6: typed rows to CSV and back with the conformed schema."""
    path = scratch_path(spark, "orders-csv")
    write_csv(_norm(spark, sf_dir), path, mode="overwrite", skip_empty=False)
    return spark.read.schema(CONFORMED_SCHEMA).options(**CSV_WRITE_OPTIONS).csv(path)


def q_sink_parquet_roundtrip(spark, sf_dir):
    """K7: typed rows to Parquet and back."""
    path = scratch_path(spark, "orders-parquet")
    write_parquet(_norm(spark, sf_dir), path, mode="overwrite", skip_empty=False)
    return spark.read.parquet(path)


def q_sink_parquet_by_month(spark, sf_dir):
    """K2: conformed rows partitioned by update month, read back."""
    path = scratch_path(spark, "orders-by-month")
    rows = _dated(spark, sf_dir).withColumn("month", month_of(F.col("updated_at")))
    write_parquet_by_month(rows, path)
    return spark.read.parquet(path)


def q_sink_table_append(spark, sf_dir):
    """K1 (catalog table): append the rows with a key under the key check, the others without; read back."""
    db = scratch_database(spark, "append")
    name = f"{db}.orders"
    create_table_if_missing(spark, name)
    with kept(_conformed(spark, sf_dir)) as rows:
        append_table(rows.filter("order_id IS NOT NULL"), name, key="order_id", stage=False)
        append_table(rows.filter("order_id IS NULL"), name)
    return spark.table(name)


def q_create_table_if_missing(spark, sf_dir):
    """K3: create twice (the second is a no-op), insert, read back."""
    db = scratch_database(spark, "create")
    name = f"{db}.orders"
    create_table_if_missing(spark, name)
    create_table_if_missing(spark, name)
    append_table(_conformed(spark, sf_dir), name)
    return spark.table(name)


def q_ctas_replace(spark, sf_dir):
    """K4: replace the table from a query twice; the result is the same."""
    db = scratch_database(spark, "ctas")
    name = f"{db}.orders"
    with kept(_conformed(spark, sf_dir)) as rows:
        ctas_replace(rows, name)
        ctas_replace(rows, name)
    return spark.table(name)


def q_city_revenue_table(spark, sf_dir):
    """K5: publish the city revenue twice behind one view; read the view."""
    db = scratch_database(spark, "revenue")
    view = f"{db}.city_wise_revenue"
    revenue = city_revenue(tidy_orders(_raw(spark, sf_dir)))
    publish_table(revenue, view)
    publish_table(revenue, view)
    return spark.table(view)


def q_merge_latest_table(spark, sf_dir):
    """D1 into a bucketed table: three batches of updates, one of them merged twice."""
    name = f"{scratch_database(spark, 'merge')}.orders"
    with kept(_norm(spark, sf_dir)) as rows:
        part = F.pmod(F.xxhash64("order_id", "updated_at"), F.lit(3))
        for k in (0, 1, 2, 1):
            merge_latest(rows.filter(part == k), name, buckets=8)
    return spark.table(name)


def q_stored_counts(spark, sf_dir):
    """Q7: the rows that an append and a month write report, beside the rows that the files' footers hold."""
    path, name = scratch_path(spark, "counted-months"), f"{scratch_database(spark, 'counted')}.orders"
    create_table_if_missing(spark, name)
    with kept(_conformed(spark, sf_dir)) as rows:
        appended = append_table(rows, name)
        dated = rows.filter("updated_at IS NOT NULL").withColumn("month", month_of(F.col("updated_at")))
        written = write_parquet_by_month(dated, path)
    reported = {"append": appended, "months": written}
    stored = {"append": table_location(spark, name), "months": path}
    counts = [footer_count(spark, stored[k], "stored_rows").select(F.lit(k).alias("sink"), F.lit(reported[k]).cast("bigint").alias("reported_rows"), "stored_rows") for k in reported]
    return counts[0].unionByName(counts[1])


# --- jobs ---------------------------------------------------------------------------------------


def q_job_load_orders(spark, sf_dir):
    """W1 on the gate-passing raw rows (text columns), stored as a catalog source."""
    name = _stored(passes_gate(_raw(spark, sf_dir)), "orders_source")
    db = scratch_database(spark, "load")
    target = f"{db}.orders"
    jobs.load_orders(spark, scan_catalog(spark, name), target)
    return spark.table(target)


def q_city_extract(spark, sf_dir):
    """W2 on all dated orders; the partitioned dataset read back."""
    path = scratch_path(spark, "orders-kolkata")
    jobs.extract_city(spark, _dated(spark, sf_dir), path)
    return spark.read.parquet(path)


def q_job_city_revenue(spark, sf_dir):
    """Raw CSV landing files -> tidy append -> published city revenue."""
    path = _land_raw_csv(spark, sf_dir)
    db = scratch_database(spark, "tidy")
    jobs.city_revenue_job(spark, read_raw_csv(spark, path), f"{db}.orders_tidy", f"{db}.city_wise_revenue")
    return spark.table(f"{db}.city_wise_revenue")


def q_job_load_orders_batches(spark, sf_dir):
    """W1 as batches: two runs, the first repeated under its id, the second replaced as one unit."""
    source = scan_catalog(spark, _stored(passes_gate(_raw(spark, sf_dir)), "orders_source"))
    target = f"{scratch_database(spark, 'batches')}.orders"
    half = F.pmod(F.xxhash64("order_id"), F.lit(2))
    run = uuid.uuid4().hex[:12]
    for which, on_known in ((0, "refuse"), (0, "skip"), (1, "refuse"), (1, "replace")):
        jobs.load_orders(spark, source.filter(half == which), target, run_id=f"{run}-{which}", on_known=on_known)
    return batch_rows(spark, target)


def q_job_city_revenue_rerun(spark, sf_dir):
    """W3 run twice under one id: the rows and the revenue of one run."""
    source = read_raw_csv(spark, _land_raw_csv(spark, sf_dir))
    db, run = scratch_database(spark, "rerun"), uuid.uuid4().hex[:12]
    for _ in range(2):
        jobs.city_revenue_job(spark, source, f"{db}.orders_tidy", f"{db}.city_wise_revenue", run_id=run)
    return spark.table(f"{db}.city_wise_revenue")


def q_job_city_revenue_incremental(spark, sf_dir):
    """W3 in two deliveries, the revenue of the second added to that of the first."""
    source = read_raw_csv(spark, _land_raw_csv(spark, sf_dir))
    db, part = scratch_database(spark, "increment"), F.pmod(F.xxhash64("customer_id"), F.lit(2))
    for which in (0, 1):
        jobs.city_revenue_job(spark, source.filter(part == which), f"{db}.orders_tidy", f"{db}.city_wise_revenue", incremental=True)
    return spark.table(f"{db}.city_wise_revenue")


QUERIES: dict[str, Query] = {
    "scan_csv_strings": q_scan_csv_strings,
    "scan_catalog": q_scan_catalog,
    "register_csv_inferred": q_register_csv_inferred,
    "register_parquet_partitions": q_register_parquet_partitions,
    "register_csv_recrawled": q_register_csv_recrawled,
    "register_partitions_diff": q_register_partitions_diff,
    "generate_orders": q_generate_orders,
    "normalize_orders": q_normalize_orders,
    "tidy_orders": q_tidy_orders,
    "invalid_rows": q_invalid_rows,
    "invalid_month_rows": q_invalid_month_rows,
    "dedup_latest": q_dedup_latest,
    "city_revenue": q_city_revenue,
    "city_month_distribution": q_city_month_distribution,
    "row_count": q_row_count,
    "exists_probe": q_exists_probe,
    "quality_report": q_quality_report,
    "constraint_violations": q_constraint_violations,
    "duplicate_keys": q_duplicate_keys,
    "sink_csv_roundtrip": q_sink_csv_roundtrip,
    "sink_parquet_roundtrip": q_sink_parquet_roundtrip,
    "sink_parquet_by_month": q_sink_parquet_by_month,
    "sink_table_append": q_sink_table_append,
    "create_table_if_missing": q_create_table_if_missing,
    "ctas_replace": q_ctas_replace,
    "city_revenue_table": q_city_revenue_table,
    "merge_latest_table": q_merge_latest_table,
    "stored_counts": q_stored_counts,
    "job_load_orders": q_job_load_orders,
    "job_load_orders_batches": q_job_load_orders_batches,
    "city_extract": q_city_extract,
    "job_city_revenue": q_job_city_revenue,
    "job_city_revenue_rerun": q_job_city_revenue_rerun,
    "job_city_revenue_incremental": q_job_city_revenue_incremental,
}
