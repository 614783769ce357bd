"""Appends that can be repeated: a table of batches and its ledger.

A *batch table* is partitioned by ``batch_id``, and every batch is a folder of
its own. A batch is written first and becomes part of the table in one catalog
operation, which adds its partition or points it to another folder, so readers
see all rows of a batch or none. The table's partitions say which batches
count; the *ledger*, a table beside it, says when, how many rows and where:

* a known batch id is refused, skipped, or replaced as one unit;
* a crash before the commit leaves the table as it was, one after it has the
  batch in the table, and the ledger is completed by the next append;
* the folder of a replaced batch stays for readers that opened it, until
  ``drop_replaced_batches``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import QualityError
from ..plans.params import check_table_name
from ..schema import TABLE_COLUMNS
from ..storage import delete_path, list_folders, read_text, table_location, write_text
from .versions import Watch, write_version

BATCH = "batch_id"
ON_KNOWN = ("refuse", "skip", "replace")
_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_-]{0,99}")
_LEDGER = f"{BATCH} STRING, rows BIGINT, folder STRING, appended_at TIMESTAMP"


class KnownBatch(QualityError):
    """The batch id is already in the table; nothing was written."""


@dataclass(frozen=True)
class BatchResult:
    """``status`` is ``appended``, ``replaced`` or ``skipped``; ``rows`` are the batch's rows now in the table."""

    status: str
    rows: int


def check_batch_id(batch_id: str) -> str:
    """A batch id becomes a folder name and part of a statement."""
    if not isinstance(batch_id, str) or not _ID.fullmatch(batch_id):
        raise ValueError(f"a batch id has letters, digits, '_' and '-', at most 100, got {batch_id!r}")
    return batch_id


def ledger_name(name: str) -> str:
    return f"{check_table_name(name)}__ledger"


def create_batch_table(spark: SparkSession, name: str, columns: Sequence[tuple[str, str, bool]] | str = TABLE_COLUMNS) -> bool:
    """Create a batch table and its ledger where they are missing; True if the table is new.

    ``columns`` is a list as in ``TABLE_COLUMNS``, or the text of a column list.
    """
    check_table_name(name)
    body = columns if isinstance(columns, str) else ", ".join(f"{c} {kind}" for c, kind, _ in columns)
    existed = spark.catalog.tableExists(name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({body}, {BATCH} STRING) USING parquet PARTITIONED BY ({BATCH})")
    if not any(c.name == BATCH and c.isPartition for c in spark.catalog.listColumns(name)):
        raise ValueError(f"{name} is no batch table: it is not partitioned by {BATCH}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ledger_name(name)} ({_LEDGER}) USING parquet")
    return not existed


def known_batches(spark: SparkSession, name: str) -> set[str]:
    """The ids of the batches that the table holds, from its partitions."""
    return {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def append_batch(
    df: DataFrame,
    name: str,
    batch_id: str,
    on_known: str = "refuse",
    key: str | None = None,
    known: dict | None = None,
    watch: Watch = lambda step: None,
) -> BatchResult:
    """Append ``df`` to the batch table ``name`` as ``batch_id``, as one unit.

    For an id that the table holds, ``refuse`` raises ``KnownBatch``, ``skip``
    leaves the table as it is, and ``replace`` puts the new rows in place of
    the old ones in one step. With ``key`` the batch's keys are checked (K1,
    Q6) against all other batches; pass stored rows then, which are read twice,
    and ``known`` as for ``check_new_keys``. Types and text bounds of the table
    are enforced. ``watch`` is told each step. Two appends of one id at the
    same time: the second to add its partition fails and leaves nothing.
    """
    from .tables import check_new_keys  # that module uses this one's steps

    if on_known not in ON_KNOWN:
        raise ValueError(f"on_known must be one of {', '.join(ON_KNOWN)}")
    check_batch_id(batch_id)
    spark = df.sparkSession
    present = batch_id in known_batches(spark, name)
    if present and on_known == "refuse":
        raise KnownBatch(f"batch {batch_id} is already in {name}; nothing was written")
    if present and on_known == "skip":
        _complete_ledger(spark, name, batch_id)
        return BatchResult("skipped", _rows_of(spark, name, batch_id))
    columns = [f for f in spark.table(name).schema.fields if f.name != BATCH]
    if key is not None:
        others = spark.table(name).filter(F.col(BATCH) != batch_id)
        check_new_keys(df, spark, name, key, known=known, table=others)
    ddl = _declared(spark, name, [f.name for f in columns])
    folder = f"{table_location(spark, name).rstrip('/')}/_batches/{batch_id}/{uuid.uuid4().hex[:12]}"
    watch("write")
    rows = write_version(df, folder, ddl)
    write_text(spark, f"{folder}/_rows", str(rows))  # found again if the ledger's row is lost
    watch("commit")
    if present:
        spark.sql(f"ALTER TABLE {name} PARTITION ({BATCH} = '{batch_id}') SET LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {name} ADD PARTITION ({BATCH} = '{batch_id}') LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    watch("committed")
    _complete_ledger(spark, name, batch_id)
    watch("noted")
    return BatchResult("replaced" if present else "appended", rows)


def _declared(spark: SparkSession, name: str, names: list[str]) -> str:
    """The column list of a table as declared, with its text bounds."""
    kinds = {r["col_name"]: r["data_type"] for r in reversed(spark.sql(f"DESCRIBE TABLE {name}").collect())}
    return ", ".join(f"`{c}` {kinds[c]}" for c in names)


def batch_folder(spark: SparkSession, name: str, batch_id: str) -> str:
    """The folder that the table reads for a batch."""
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({BATCH} = '{check_batch_id(batch_id)}')").collect():
        if row["col_name"] == "Location":  # the partition's comes before the table's
            return row["data_type"]
    raise ValueError(f"{name} has no batch {batch_id}")


def _complete_ledger(spark: SparkSession, name: str, batch_id: str) -> None:
    """Note this batch, and any that the ledger has never heard of, unless their folders are noted."""
    noted = {(r[BATCH], r["folder"]) for r in spark.table(ledger_name(name)).select(BATCH, "folder").collect()}  # a row an append
    unheard = known_batches(spark, name) - {b for b, _ in noted}
    found = [(b, batch_folder(spark, name, b)) for b in sorted({batch_id} | unheard)]
    rows = [(b, int(read_text(spark, f"{f}/_rows") or 0), f) for b, f in found if (b, f) not in noted]
    if rows:
        new = spark.createDataFrame(rows, f"{BATCH} string, rows bigint, folder string").withColumn("appended_at", F.current_timestamp())
        new.coalesce(1).write.insertInto(ledger_name(name))


def _rows_of(spark: SparkSession, name: str, batch_id: str) -> int:
    return int(read_text(spark, f"{batch_folder(spark, name, batch_id)}/_rows") or 0)


def batch_ledger(spark: SparkSession, name: str) -> DataFrame:
    """``batch_id, rows, folder, appended_at, current``: every append and replacement, and whether it is the table's.

    The catalog is asked once for each batch.
    """
    now = spark.createDataFrame(_present(spark, name), f"{BATCH} string, folder string").withColumn("current", F.lit(True))
    notes = spark.table(ledger_name(name))
    return notes.join(F.broadcast(now), [BATCH, "folder"], "left").select(*notes.columns, F.coalesce("current", F.lit(False)).alias("current"))


def _present(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    return [(b, batch_folder(spark, name, b)) for b in sorted(known_batches(spark, name))]


def drop_replaced_batches(spark: SparkSession, name: str) -> int:
    """Delete the folders of replaced batches and of appends that never committed; how many went.

    Run it when no append is under way and no reader uses older rows.
    """
    used = {f.split(":", 1)[-1].replace("//", "/") for _, f in _present(spark, name)}
    gone = 0
    for batch in list_folders(spark, f"{table_location(spark, name).rstrip('/')}/_batches"):
        for folder in list_folders(spark, batch):
            if folder.split(":", 1)[-1].replace("//", "/") not in used:
                delete_path(spark, folder)
                gone += 1
    return gone


def batch_rows(spark: SparkSession, name: str) -> DataFrame:
    """All rows of the batch table, without the batch id."""
    return spark.table(name).drop(BATCH)


__all__ = [
    "BATCH",
    "BatchResult",
    "KnownBatch",
    "append_batch",
    "batch_ledger",
    "batch_rows",
    "check_batch_id",
    "create_batch_table",
    "drop_replaced_batches",
    "known_batches",
    "ledger_name",
]
