"""Catalog table sinks (K1, K3, K4, K5).

The relational target of the loads is a catalog table: Parquet files in the
warehouse (or the database location), written in parallel by every task and
committed once. Rules Spark tables do not keep are enforced as gates:

* ``VARCHAR(n)`` bounds and decimal overflow: enforced by Spark on insert.
* NOT NULL: dropped by Parquet tables, so the loads gate on it first.
* PRIMARY KEY: not supported, so ``append_table(key=...)`` refuses a batch
  whose keys repeat or already exist in the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import QualityError, constraint_violations, duplicate_keys
from ..plans.params import check_identifier, check_table_name, split_table_name
from ..plans.reuse import kept
from ..schema import TABLE_COLUMNS
from ..storage import delete_path
from .versions import Watch, columns_ddl, drop_old_versions, new_version, point_to, write_version

#: Batches of up to this many rows are looked for by their keys; the list travels with the query.
FEW_KEYS = 1000

_TARGET_PROPERTY = "cartwheel.published_table"
_PREVIOUS_PROPERTY = "cartwheel.previous_table"


def table_ddl(name: str, columns=TABLE_COLUMNS, using: str = "parquet", key_filter: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for the typed orders table.

    With ``key_filter`` every file written to the table carries a Bloom filter
    of that column for each row group, which the key check uses.
    """
    check_table_name(name)
    body = ",\n  ".join(f"{col} {kind}" for col, kind, _ in columns)
    options = f"\nOPTIONS ({bloom_option(key_filter)})" if key_filter else ""
    return f"CREATE TABLE IF NOT EXISTS {name} (\n  {body}\n) USING {using}{options}"


def bloom_option(key: str) -> str:
    return f"'parquet.bloom.filter.enabled#{check_identifier(key, 'key')}' 'true'"


def create_table_if_missing(spark: SparkSession, name: str, columns=TABLE_COLUMNS, key_filter: str | None = None) -> bool:
    """K3: create the schema and the typed table when absent; True if created.

    ``key_filter`` names the column of which files keep Bloom filters.
    """
    schema, _ = split_table_name(name)
    if schema:
        check_identifier(schema, "schema")
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    existed = spark.catalog.tableExists(name)
    spark.sql(table_ddl(name, columns, key_filter=key_filter))
    return not existed


def _in_table_order(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    target = [f.name for f in spark.table(name).schema.fields]
    missing = [c for c in target if c not in df.columns]
    if missing:
        raise ValueError(f"the rows lack table columns: {', '.join(missing)}")
    return df.select(*target)


def check_new_keys(
    df: DataFrame, spark: SparkSession, name: str, key: str, prune_by_range: bool = True, known: dict | None = None, table: DataFrame | None = None
) -> dict:
    """Refuse a batch whose ``key`` is NULL, repeats, or is already in ``name``.

    The batch alone is reduced to one row per key to count NULL and repeated
    keys. The table's key column (only that column is read) is then streamed
    past the batch's keys in a left semi join: Spark broadcasts the batch, the
    right side, when its size estimate allows, and the table is not shuffled;
    a large batch gets a shuffle join.

    With ``prune_by_range`` the table is read only between the batch's
    smallest and largest key: the bounds reach the Parquet scan, which skips
    every row group whose statistics lie outside. The test stays exact (a key
    outside the range cannot match). A batch of up to ``FEW_KEYS`` keys, such
    as a late correction, is looked for by its keys: the list reaches the scan
    and its row groups are skipped by their Bloom filters where the table keeps
    them (``create_table_if_missing(key_filter=...)``), whatever the order of
    the keys; what is left is compared exactly. Pass a staged or cheap ``df``: it is read
    twice. A batch just de-duplicated by ``key`` needs no count of repeats:
    ``known`` then gives its ``null_keys``, ``repeated_keys``, ``lo`` and ``hi``. ``table`` gives
    the rows of ``name`` that count, if not all do. The check and a later insert are two steps, so two loads at once
    can both pass.
    """
    if known is None:
        copies = df.groupBy(key).agg(F.count(F.lit(1)).alias("__copies"))
        report = copies.agg(
            F.count_if(F.col(key).isNull()).alias("null_keys"),
            F.count_if(F.col(key).isNotNull() & (F.col("__copies") > 1)).alias("repeated_keys"),
            F.min(key).alias("lo"),
            F.max(key).alias("hi"),
        ).first().asDict()
    else:
        report = dict(known)
    lo, hi = report.pop("lo"), report.pop("hi")
    existing = (spark.table(name) if table is None else table).select(F.col(key).alias("__existing"))
    few = _few_keys(df, key) if table is None else None
    if few is not None:
        hits = rows_with_keys(spark, name, key, few).select(F.col(key).alias("__existing"))
    else:
        if prune_by_range and lo is not None:
            existing = existing.filter(F.col("__existing").between(F.lit(lo), F.lit(hi)))
        keys = df.select(F.col(key).alias("__key"))
        hits = existing.join(keys, F.col("__existing") == F.col("__key"), "left_semi")
    report["existing_keys"] = hits.agg(F.count_distinct("__existing").alias("n")).first()["n"]
    if report["null_keys"]:
        raise QualityError(f"NULL {key} in the batch; nothing was written")
    if report["repeated_keys"]:
        raise QualityError(f"{report['repeated_keys']} duplicate {key} value(s) in the batch; nothing was written")
    if report["existing_keys"]:
        raise QualityError(f"{report['existing_keys']} {key} value(s) already present in {name}; nothing was written")
    return report


def _few_keys(df: DataFrame, key: str) -> list | None:
    """The keys of a batch of up to ``FEW_KEYS`` rows; None for a larger one."""
    found = [r[0] for r in df.select(key).limit(FEW_KEYS + 1).collect()]  # bounded
    return [k for k in found if k is not None] if len(found) <= FEW_KEYS else None


def rows_with_keys(spark: SparkSession, name: str, key: str, keys: Sequence) -> DataFrame:
    """The rows of a table whose ``key`` is one of a short list, read through the files' statistics and Bloom filters.

    The list is pushed into the scan whole; the session of its own in which
    that is switched on shares the catalog.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(max(10, len(keys))))
    table = own.table(f"{spark.catalog.currentDatabase()}.{name}" if "." not in name else name)
    return table.filter(F.col(key).isin(list(keys))) if keys else table.limit(0)


def append_table(df: DataFrame, name: str, key: str | None = None, stage: bool = True, known: dict | None = None) -> int:
    """K1: append rows to an existing table, by column name; rows written.

    Spark commits the whole insert at once for a catalog table. With ``key``
    the batch is refused like a primary-key violation would refuse it; the
    batch is then first staged once on shared storage (``stage``), so the
    key checks and the insert read the same rows and the batch's plan runs
    once. Pass ``stage=False`` for a batch that is already a stored table;
    ``known`` is passed on to ``check_new_keys``.
    """
    spark = df.sparkSession
    check_table_name(name)
    if key is None:
        return _insert(df, spark, name)
    with kept(df, "stage" if stage else "none") as rows:
        check_new_keys(rows, spark, name, key, known=known)
        return _insert(rows, spark, name)


def _insert(df: DataFrame, spark: SparkSession, name: str) -> int:
    obs = Observation(f"append_{uuid.uuid4().hex[:8]}")
    _in_table_order(df, spark, name).observe(obs, F.count(F.lit(1)).alias("rows")).write.insertInto(name)
    return int(obs.get.get("rows", 0))


def ctas_replace(df: DataFrame, name: str, columns=None, key: str | None = None, watch: Watch = lambda step: None) -> int:
    """K4: recreate ``name`` from ``df`` (re-runnable); rows written.

    The rows go to a version folder of their own; then the table's pointer is
    set to it (see :mod:`cartwheel.sinks.versions`). A failing query, or a
    crash before the swap, leaves the old table as it is; no file is moved.
    With ``columns`` (as in ``TABLE_COLUMNS``) the table has those types and
    text bounds, and before the swap its NOT NULL rules (Q5) and, with
    ``key``, its key (Q6) are checked. Readers that opened the old rows can
    finish: the version before the current one stays. ``watch`` is told each
    step.
    """
    check_table_name(name)
    spark = df.sparkSession
    folder = new_version(spark, name)
    body = columns_ddl(df) if columns is None else ", ".join(f"{col} {kind}" for col, kind, _ in columns)
    try:
        watch("write")
        rows = write_version(df, folder, None if columns is None else body)
        watch("written")
        if columns is not None:
            _check_stored(spark.read.parquet(folder), columns, key, name)
    except Exception:
        delete_path(spark, folder)
        raise
    point_to(spark, name, folder, body, watch)
    drop_old_versions(spark, name)
    return rows


def _check_stored(stored: DataFrame, columns, key: str | None, name: str) -> None:
    required = [col for col, _, not_null in columns if not_null]
    broken = constraint_violations(stored, required, {}).filter("violations > 0").collect()  # a row per column
    if broken:
        raise QualityError(f"{name}: " + ", ".join(f"null_{r['column_name']}={r['violations']}" for r in broken) + "; nothing was replaced")
    if key and not duplicate_keys(stored, key).isEmpty():
        raise QualityError(f"{name}: {key} repeats; nothing was replaced")


def publish_table(df: DataFrame, view: str, columns: Sequence[str] | None = None) -> tuple[str, int]:
    """K5: materialise ``df`` as a new table and repoint ``view`` at it.

    Readers of ``view`` see the old rows until the view is replaced and the
    new rows right after; there is no moment with no view, unlike drop then
    create. The table the view used before is kept, so readers that opened it
    can finish; the one before that is dropped. With
    ``columns`` the view shows only those (the table may keep more, such as
    the parts an incremental refresh needs). Returns the new table's name and
    its row count.
    """
    spark = df.sparkSession
    schema, base = split_table_name(view)
    check_identifier(base, "view")
    version = f"{base}__v{uuid.uuid4().hex[:12]}"
    table = f"{schema}.{version}" if schema else version
    previous, oldest = _view_target(spark, view), _view_target(spark, view, _PREVIOUS_PROPERTY)
    # The name is fresh, so the rows are written under it at once.
    obs = Observation(f"publish_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format("parquet").saveAsTable(table)
    rows = int(obs.get.get("rows", 0))
    shown = ", ".join(check_identifier(c, "column") for c in columns) if columns else "*"
    try:
        spark.sql(
            f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{_TARGET_PROPERTY}' = '{table}', "
            f"'{_PREVIOUS_PROPERTY}' = '{previous or ''}') AS SELECT {shown} FROM {table}"
        )
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise
    if oldest and oldest not in (table, previous):
        spark.sql(f"DROP TABLE IF EXISTS {oldest}")
    return table, rows


def published_table(spark: SparkSession, view: str) -> str | None:
    """The table behind a view made by ``publish_table`` (None if there is none)."""
    return _view_target(spark, view)


def _view_target(spark: SparkSession, view: str, which: str = _TARGET_PROPERTY) -> str | None:
    """The table a published view points at (or pointed at), from the view's own properties."""
    if not spark.catalog.tableExists(view):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {view}").collect()
    props = {r["key"]: r["value"] for r in rows}
    return props.get(which) or None
