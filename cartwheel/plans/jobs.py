"""The three jobs (W1, W2, W3) as functions over DataFrames.

Each job: source DataFrame -> pure transforms -> quality gate -> sink ->
small result record. Only gates, counts and writes run Spark jobs, and no job
collects more than one summary row to the driver.

Lineage and retries: the load job stages its de-duplicated rows as a Parquet
table under ``spark.checkpoint.dir`` (shared storage) and appends from it, so
the shuffle runs once and a lost executor never forces a recompute of the
de-duplication; its gates read counts observed during that write, and the
staging table is dropped at the end. The extract job stages the city's rows
the same way, so its source is read once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_of, year_month_of
from ..operators.aggregates import REVENUE_COLUMNS, city_revenue_parts, finish_revenue, merge_revenue_parts
from ..operators.conform import normalize_orders, tidy_orders
from ..operators.dedup import dedup_latest
from ..operators.filters import keep_equal
from ..operators.quality import gate_month, refuse_failures, report_columns, require_columns
from ..schema import EXTRACT_CITY, EXTRACT_COLUMNS, GENERATOR_ROWS, GENERATOR_SEED, KEY_COLUMN, ORDER_COLUMNS, TABLE_COLUMNS, TEXT_BOUNDS
from ..sinks.batches import KnownBatch, append_batch, create_batch_table
from ..sinks.files import write_dataset, write_parquet_by_month
from ..sinks.tables import append_table, create_table_if_missing, ctas_replace, publish_table, published_table
from ..sinks.versions import Watch, columns_ddl
from ..sources.files import read_raw_csv
from ..sources.generate import generate_orders
from .journal import Journal
from .params import check_location, check_table_name
from .reuse import kept, staged


@dataclass
class JobResult:
    """What a job did: ``status`` is ``written`` or ``empty``."""

    status: str
    rows_written: int
    target: str
    details: dict = field(default_factory=dict)


def conform_orders(source: DataFrame) -> DataFrame:
    """W1 transform: typed columns, then one row per order (latest update)."""
    return dedup_latest(normalize_orders(source))


def load_orders(
    spark: SparkSession,
    source: DataFrame,
    target_table: str,
    key_check: bool = True,
    keep_staging: bool = False,
    run_id: str | None = None,
    on_known: str = "skip",
    watch: Watch = lambda step: None,
) -> JobResult:
    """Conform, de-duplicate, gate, then append to ``target_table``.

    Refuses the whole batch (``QualityError``) when any required value is
    missing or unparseable, or a text is longer than the table's bound; an
    empty source writes nothing and succeeds. The
    target table is created (typed, text bounds) if missing. Keys already in
    the table refuse the batch, as a primary key would, unless ``key_check``
    is off; two loads at the same time can both pass that check.

    The conformed batch is staged once as a managed Parquet table in a
    scratch database under ``spark.checkpoint.dir``. The gate's counts and the
    key's bounds are observed during that write; the key check and the append
    read the staged copy. The staging database is dropped (files included) when
    the job ends, unless ``keep_staging``.

    With ``run_id`` the run can be repeated: the target is a batch table, the
    rows are the batch of that id (``on_known`` says what becomes of an id
    that the table holds), and a run that was killed goes on from its last
    finished step when it is called again. ``watch`` is told each step.
    """
    check_table_name(target_table)
    require_columns(source, ORDER_COLUMNS, "source")
    if run_id is not None:
        return _load_run(Journal(spark, f"load-{target_table}", run_id, watch), source, target_table, key_check, on_known)
    obs = Observation(f"load_{uuid.uuid4().hex[:8]}")
    bounds = [F.min(KEY_COLUMN).alias("lo"), F.max(KEY_COLUMN).alias("hi")]
    observed = conform_orders(source).observe(obs, *report_columns(bounds=TEXT_BOUNDS), *bounds)
    with staged(observed, "load_staging", drop=not keep_staging) as batch:
        report = {"row_count": 0, **obs.get}
        lo, hi = report.pop("lo", None), report.pop("hi", None)
        refuse_failures(report, target_table)
        if report["row_count"] == 0:
            return JobResult("empty", 0, target_table, {"report": report})
        create_table_if_missing(spark, target_table, key_filter=KEY_COLUMN if key_check else None)
        # No NULL key passes the gate, and the de-duplication leaves one row per key.
        known = {"null_keys": 0, "repeated_keys": 0, "lo": lo, "hi": hi}
        key = KEY_COLUMN if key_check else None
        written = append_table(batch, target_table, key=key, stage=False, known=known)
        return JobResult("written", written, target_table, {"report": report})


def _load_run(journal: Journal, source: DataFrame, target_table: str, key_check: bool, on_known: str) -> JobResult:
    """W1 in steps: stage, gate, create, append, clean up."""
    spark = journal.spark
    if on_known == "replace" and journal.finished("append") is not None:
        journal.forget()  # a finished run of this id: the new rows take its place
    if on_known == "refuse" and journal.finished("append") is not None:
        raise KnownBatch(f"run {journal.run_id} has loaded {target_table}; nothing was written")

    def counted(rows: DataFrame) -> tuple[DataFrame, Callable[[], dict]]:
        obs = Observation(f"load_{uuid.uuid4().hex[:8]}")
        bounds = [F.min(KEY_COLUMN).alias("lo"), F.max(KEY_COLUMN).alias("hi")]
        return rows.observe(obs, *report_columns(bounds=TEXT_BOUNDS), *bounds), lambda: {"row_count": 0, **obs.get}

    done = journal.finished("append")
    if done is not None:
        journal.close("stage")
        return JobResult(done["status"], done["rows"], target_table, {"report": done["report"], "repeated": True})
    batch, report = journal.stored("stage", lambda: conform_orders(source), counted)
    lo, hi = report.pop("lo", None), report.pop("hi", None)
    refuse_failures(report, target_table)
    if report["row_count"] == 0:
        journal.forget()
        return JobResult("empty", 0, target_table, {"report": report})
    journal.step("create", lambda: {"created": create_batch_table(spark, target_table)})

    def append() -> dict:
        known = {"null_keys": 0, "repeated_keys": 0, "lo": lo, "hi": hi}
        key = KEY_COLUMN if key_check else None
        how = "replace" if on_known == "replace" else "skip"
        found = append_batch(batch, target_table, journal.run_id, how, key=key, known=known, watch=journal.watch)
        return {"status": "written", "rows": found.rows, "batch": found.status, "report": report}

    result = journal.step("append", append)
    journal.close("stage")
    return JobResult("written", result["rows"], target_table, {"report": report, "batch": result["batch"]})


def city_rows(orders: DataFrame, city: str = EXTRACT_CITY, with_year: bool = False) -> DataFrame:
    """W2 transform: one city (exact case) with the update month appended.

    The month has no year by default, as in the original job, so the same
    month of different years shares a partition; ``with_year`` makes it
    ``yyyymm`` instead.
    """
    require_columns(orders, EXTRACT_COLUMNS, "orders table")
    month = year_month_of if with_year else month_of
    return keep_equal(orders, "city", city).withColumn("month", month(F.col("updated_at")))


def extract_city(
    spark: SparkSession,
    orders: DataFrame,
    output_path: str,
    city: str = EXTRACT_CITY,
    keep: str = "stage",
    with_year: bool = False,
    partition_overwrite: str = "static",
    schemes: Sequence[str] | None = None,
    run_id: str | None = None,
    watch: Watch = lambda step: None,
) -> JobResult:
    """One city's orders to Parquet partitioned by month (static overwrite).

    Any NULL month refuses the write. An empty extract writes nothing, since
    an empty partitioned write leaves no readable dataset. ``keep`` (C1)
    decides how the city's rows serve both the gate and the write: the
    default ``stage`` reads the source once into a scratch Parquet table on
    shared storage (dropped afterwards), cutting the lineage, so a lost
    executor or a source that changes in between cannot make the written
    rows differ from the checked ones; ``none``
    reads the source twice (the gate pass then reads only ``city`` and
    ``updated_at``). ``partition_overwrite="dynamic"`` replaces only the
    months present in this run instead of the whole dataset. With ``schemes``
    (W4) the output location must start with one of them. A hot month is split
    over several tasks only where adaptive execution is on. With ``run_id`` a
    run that was killed goes on from its last finished step when it is called
    again with the same id; the rows are then staged whatever ``keep`` says.
    """
    if schemes is not None:
        check_location(output_path, schemes)
    rows = city_rows(orders, city, with_year)
    if run_id is not None:
        return _extract_run(Journal(spark, "extract", run_id, watch), rows, output_path, partition_overwrite)
    with kept(rows, keep) as city_orders:
        return _extract(city_orders, output_path, partition_overwrite)


def _extract(rows: DataFrame, output_path: str, partition_overwrite: str = "static") -> JobResult:
    report = gate_month(rows.select("month"))
    if report["row_count"] == 0:
        return JobResult("empty", 0, output_path, {"report": report})
    written = write_parquet_by_month(rows, output_path, partition_overwrite=partition_overwrite)
    return JobResult("written", written, output_path, {"report": report})


def _extract_run(journal: Journal, rows: DataFrame, output_path: str, partition_overwrite: str) -> JobResult:
    """W2 in steps: stage, gate and write, clean up. A write that was cut off overwrites what it left."""
    done = journal.finished("write")
    if done is None:
        staged_rows, _ = journal.stored("stage", lambda: rows, lambda df: (df, dict))
        done = journal.step("write", lambda: asdict(_extract(staged_rows, output_path, partition_overwrite)))
    journal.close("stage")
    return JobResult(**done)


def tidy_load(spark: SparkSession, source: DataFrame, target_table: str) -> JobResult:
    """W3 task 1: tidy the raw rows and append them to ``target_table``.

    No de-duplication and no gate, like the CSV load it mirrors; re-running it
    appends the batch again.
    """
    check_table_name(target_table)
    return _append_tidy(spark, tidy_orders(source), target_table)


def _append_tidy(spark: SparkSession, tidy: DataFrame, target_table: str) -> JobResult:
    if not spark.catalog.tableExists(target_table):
        spark.catalog.createTable(target_table, source="parquet", schema=tidy.schema)
    written = append_table(tidy, target_table)
    return JobResult("written", written, target_table)


def refresh_city_revenue(
    spark: SparkSession, orders_table: str, view: str, batch: DataFrame | None = None
) -> JobResult:
    """W3 task 2 (K5): rebuild the per-city revenue and repoint ``view`` at it.

    By default the summary is recomputed from the whole ``orders_table``, as
    the original does. With ``batch`` (the rows just appended) and a previous
    summary published by this function, the new summary is the previous
    parts plus the batch's parts: the work is O(batch) instead of O(table).
    It is used only if it covers as many rows as ``orders_table`` holds;
    otherwise (a crash after an append, say) the summary is rebuilt in full,
    and ``details["mode"]`` says so. The backing table keeps ``amount_count``; the view shows the
    four public columns.
    """
    check_table_name(orders_table)
    previous = published_table(spark, view) if batch is not None else None
    mode = "full"
    if previous is not None and "amount_count" in spark.table(previous).columns:
        parts = merge_revenue_parts(
            spark.table(previous).select("city", "order_count", "total_revenue", "amount_count"),
            city_revenue_parts(batch),
        )
        # The parts count every row: they cover the table only if nothing was
        # appended without a publish (a crash between the two) in the meantime.
        covered = parts.agg(F.coalesce(F.sum("order_count"), F.lit(0)).alias("n")).first()["n"]
        if covered == spark.table(orders_table).count():
            mode = "incremental"
    if mode == "full":
        parts = city_revenue_parts(spark.table(orders_table))
    table, rows = publish_table(finish_revenue(parts, keep_parts=True), view, REVENUE_COLUMNS)
    return JobResult("written", rows, view, {"table": table, "mode": mode})


def city_revenue_job(
    spark: SparkSession,
    source: DataFrame,
    orders_table: str,
    view: str,
    incremental: bool = False,
    run_id: str | None = None,
    on_known: str = "skip",
    watch: Watch = lambda step: None,
) -> tuple[JobResult, JobResult]:
    """The tidy load, then the revenue table, which runs only if the load succeeded.

    With ``incremental`` the revenue is updated from the loaded batch alone
    (see ``refresh_city_revenue``); the tidied batch is staged once and both
    the append and the revenue update read that copy. With ``run_id`` the rows
    are the batch of that id in a batch table, so that a repeated run leaves
    the rows of one (``on_known``: ``skip`` keeps them, ``replace`` takes the
    new ones, ``refuse`` raises), and a run that was killed goes on from its
    last finished step.
    """
    if run_id is not None:
        return _revenue_run(Journal(spark, f"revenue-{orders_table}", run_id, watch), source, orders_table, view, incremental, on_known)
    if not incremental:
        loaded = tidy_load(spark, source, orders_table)
        return loaded, refresh_city_revenue(spark, orders_table, view)
    with staged(tidy_orders(source), "tidy_batch") as batch:
        loaded = _append_tidy(spark, batch, orders_table)
        return loaded, refresh_city_revenue(spark, orders_table, view, batch=batch)


def _revenue_run(journal: Journal, source: DataFrame, orders_table: str, view: str, incremental: bool, on_known: str) -> tuple[JobResult, JobResult]:
    """W3 in steps: stage the tidy rows, append the batch, publish the revenue, clean up."""
    spark = journal.spark
    done = journal.finished("publish")
    if done is not None and on_known == "refuse":
        raise KnownBatch(f"run {journal.run_id} has loaded {orders_table}; nothing was written")
    if done is not None and on_known == "replace":
        journal.forget()
        done = None
    if done is None:
        batch, _ = journal.stored("stage", lambda: tidy_orders(source), lambda df: (df, dict))
        journal.step("create", lambda: {"created": create_batch_table(spark, orders_table, columns_ddl(batch))})

        def append() -> dict:
            found = append_batch(batch, orders_table, journal.run_id, "replace" if on_known == "replace" else "skip", watch=journal.watch)
            return asdict(found)

        found = journal.step("append", append)
        # The parts of a replaced batch are not known any more: the revenue is then built anew.
        added = batch if incremental and found["status"] == "appended" else None
        journal.step("publish", lambda: asdict(refresh_city_revenue(spark, orders_table, view, batch=added)))
    journal.close("stage")
    found, published = journal.finished("append"), journal.finished("publish")
    details = {"batch": found["status"] if done is None else "skipped"}
    return JobResult("written", found["rows"], orders_table, details), JobResult(**published)


def seed_orders(
    spark: SparkSession,
    output_path: str,
    fmt: str = "csv",
    n: int = GENERATOR_ROWS,
    seed: int = GENERATOR_SEED,
    table: str | None = None,
    num_partitions: int | None = None,
) -> JobResult:
    """Synthetic raw orders as landing files, and optionally a typed table.

    S8 draws the rows in parallel; K8 writes them as ``csv`` or ``parquet``
    (nothing for ``n = 0``); with ``table`` K4 replaces that table with the
    conformed rows, so re-running gives the same table. The files are read
    back for the table, so the draws run once.
    """
    if table:
        check_table_name(table)
    written = write_dataset(
        generate_orders(spark, n, seed, num_partitions), output_path, fmt, mode="overwrite"
    )
    details: dict = {"format": fmt}
    if table and written:
        landed = spark.read.parquet(output_path) if fmt.lower() == "parquet" else read_raw_csv(spark, output_path)
        details["table_rows"] = ctas_replace(normalize_orders(landed), table, TABLE_COLUMNS, KEY_COLUMN)
    return JobResult("written" if written else "empty", written, output_path, details)
