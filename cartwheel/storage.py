"""Small file-system steps on the storage that Spark itself uses.

Folders, entries and names only; rows are always read and written by Spark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .plans.params import split_table_name


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def delete_path(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _path(spark, path)
    return fs.delete(hadoop, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _path(spark, path)
    return fs.exists(hadoop)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Full names of the folders right under ``path``, the oldest first; none if it does not exist."""
    hadoop, fs = _path(spark, path)
    if not fs.exists(hadoop):
        return []
    found = [(s.getModificationTime(), s.getPath().toString()) for s in fs.listStatus(hadoop) if s.isDirectory()]
    return [name for _, name in sorted(found)]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written beside, then renamed."""
    hadoop, fs = _path(spark, path)
    beside, _ = _path(spark, path + ".part")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(beside, hadoop):
        fs.delete(hadoop, False)
        if not fs.rename(beside, hadoop):
            raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if it is not there."""
    hadoop, fs = _path(spark, path)
    if not fs.exists(hadoop):
        return None
    source = fs.open(hadoop)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def table_location(spark: SparkSession, name: str) -> str:
    """The folder that the catalog names for a table."""
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        if row["col_name"] == "Location":
            return row["data_type"]
    raise ValueError(f"{name} has no location")


def database_location(spark: SparkSession, name: str) -> str:
    """The folder of the database that a table name belongs to."""
    schema, _ = split_table_name(name, spark.catalog.currentDatabase())
    return spark.catalog.getDatabase(schema).locationUri.rstrip("/")
