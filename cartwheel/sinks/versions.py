"""Table contents as versioned folders behind one pointer (K4).

Every replacement writes a folder of its own and then changes the folder that
the catalog names for the table, in one catalog operation. No file is moved or
renamed, which matters on an object store, where a rename is a copy. A crash
before the swap leaves the old rows, a crash after it the new ones, and never
no table. The folder before the current one stays, so readers that opened it
can finish; older ones go with the next replacement.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..plans.params import check_table_name, split_table_name
from ..storage import database_location, delete_path, list_folders, table_location

_PREVIOUS = "cartwheel.previous_version"

#: Called before and after each step of a swap, with the step's name; tests use it to stop there.
Watch = Callable[[str], None]


def versions_folder(spark: SparkSession, name: str) -> str:
    _, base = split_table_name(name)
    return f"{database_location(spark, name)}/{base}__versions"


def new_version(spark: SparkSession, name: str) -> str:
    """A fresh folder name for the next contents of ``name``; nothing is created."""
    return f"{versions_folder(spark, name)}/v-{uuid.uuid4().hex[:16]}"


def write_version(df: DataFrame, folder: str, columns_ddl: str | None = None) -> int:
    """Write ``df`` to ``folder`` as Parquet; rows written.

    With ``columns_ddl`` the rows pass through a table definition with those
    columns, so that types and text bounds are enforced as on any insert; the
    definition is dropped again, the files stay.
    """
    spark = df.sparkSession
    obs = Observation(f"version_{uuid.uuid4().hex[:8]}")
    if columns_ddl is None:
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
        return int(obs.get.get("rows", 0))
    checked = f"cw_checked_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE TABLE {checked} ({columns_ddl}) USING parquet LOCATION '{folder}'")
    try:
        names = spark.table(checked).columns
        missing = [c for c in names if c not in df.columns]
        if missing:
            raise ValueError(f"the rows lack table columns: {', '.join(missing)}")
        df.select(*names).observe(obs, F.count(F.lit(1)).alias("rows")).write.insertInto(checked)
        return int(obs.get.get("rows", 0))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {checked}")


def point_to(spark: SparkSession, name: str, folder: str, columns_ddl: str, watch: Watch = lambda step: None, more: str = "") -> None:
    """Make ``folder`` the contents of ``name``: one catalog operation if the table's columns stay as they are.

    If they change, the definition is dropped and created anew around the new
    folder, since the session catalog cannot change columns and folder at
    once; between the two there is no table, and running the replacement again
    repairs it. Files stay in either case.
    """
    check_table_name(name)
    columns = f"({columns_ddl}) USING parquet {more} LOCATION '{folder}'"
    if not spark.catalog.tableExists(name):
        watch("create")
        spark.sql(f"CREATE TABLE {name} {columns} TBLPROPERTIES ('{_PREVIOUS}' = '')")
        watch("created")
        return
    before = table_location(spark, name)
    probe = f"cw_probe_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE TABLE {probe} {columns}")
    try:
        same = _shape(spark, probe) == _shape(spark, name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {probe}")
    if same:
        # Written first: if the swap does not come, the current folder is named and kept.
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_PREVIOUS}' = '{before}')")
        watch("swap")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        watch("swapped")
        return
    if spark.catalog.getTable(name).tableType != "EXTERNAL":
        raise ValueError(f"{name} is a managed table with other columns: dropping it would delete its files first")
    watch("drop")
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} {columns} TBLPROPERTIES ('{_PREVIOUS}' = '{before}')")
    watch("created")


def _shape(spark: SparkSession, name: str) -> list[tuple]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    plain = [(r["col_name"], r["data_type"]) for r in rows]
    end = next(i for i, r in enumerate(plain) if r[0].startswith("# Detailed"))
    buckets = [r for r in plain[end:] if r[0] in ("Num Buckets", "Bucket Columns", "Sort Columns")]
    return [r for r in plain[:end] if r[0]] + buckets


def drop_old_versions(spark: SparkSession, name: str) -> int:
    """Delete the version folders of ``name`` that are older than it and not its last readers'; how many went.

    Folders newer than the current one may belong to a replacement under way.
    """
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    current, previous = _bare(table_location(spark, name)), _bare(props.get(_PREVIOUS, ""))
    folders = list_folders(spark, versions_folder(spark, name))
    at = next((i for i, f in enumerate(folders) if _bare(f) == current), 0)
    old = [f for f in folders[:at] if _bare(f) != previous]
    for folder in old:
        delete_path(spark, folder)
    return len(old)


def _bare(path: str) -> str:
    """A path without scheme, to compare two spellings of one folder."""
    return "/" + path.split(":", 1)[-1].strip("/")


def columns_ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)
