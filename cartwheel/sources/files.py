"""File sources and catalog registration.

Each function returns a lazy DataFrame; the scan is split into
``spark.sql.files.maxPartitionBytes`` chunks, projections and filters reach
the reader (CSV prunes columns while parsing, Parquet prunes columns, pushes
filters into row groups and prunes ``month=`` directories).
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.params import check_table_name
from ..storage import list_folders, table_location

# Raw CSV as the loads expect it: a header row, every field text, whitespace
# and case kept exactly as written.
CSV_READ_OPTIONS: dict[str, str] = {
    "header": "true",
    "inferSchema": "false",
    # Check every file's header against the column names instead of binding
    # columns by position.
    "enforceSchema": "false",
    "mode": "PERMISSIVE",
}


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or directory with a header, all columns as strings.

    Columns are named from the first file's header, so extra columns and any
    order are fine, as long as all files agree: a file whose header differs
    fails the read. The jobs select by name and report missing columns.
    """
    return spark.read.options(**CSV_READ_OPTIONS).csv(path)


def register_csv_table(
    spark: SparkSession,
    name: str,
    path: str,
    infer: bool = True,
    timestamps_without_zone: bool = True,
    merge: bool = False,
    files: str | None = None,
) -> DataFrame:
    """Register CSV files as a catalog table with an inferred schema.

    Inference is one extra distributed pass over all the files at registration.
    With ``infer=False`` every column is text, which the loads accept just as
    well, and no pass is made. Registering a name again replaces its
    definition and infers anew (the files are untouched). With ``merge`` the
    new crawl's schema is merged with the registered one instead: types are
    widened by :func:`wider`, columns that are new come last, and columns the
    files lack stay and read as NULL. CSV files are read by position, so the
    shared columns must begin both headers in one order; else the crawl is
    refused. ``files`` names the part of ``path`` that this crawl looks at,
    such as the folder of a new delivery; the table reads all of ``path``,
    folders inside included.

    With ``timestamps_without_zone`` timestamp columns are inferred as
    ``TIMESTAMP_NTZ``, so the stored type, and every later read, keeps the
    wall clock written in the files whatever the session time zone. The
    inference runs in a session of its own: no setting of this one changes,
    and two threads do not disturb each other.
    """
    check_table_name(name)
    found = csv_schema(spark, path if files is None else files, infer, timestamps_without_zone)
    if merge and spark.catalog.tableExists(name):
        found = merge_schemas(spark.table(name).schema, found)
    _drop_external(spark, name)
    spark.catalog.createTable(name, path=path, source="csv", schema=found, header="true", recursiveFileLookup=str(files is not None).lower())
    return spark.table(name)


def csv_schema(spark: SparkSession, path: str, infer: bool = True, timestamps_without_zone: bool = True) -> T.StructType:
    """The columns of CSV files by their header, with inferred types or all text."""
    own = spark.newSession()  # settings of its own, catalog and context shared
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.caseSensitive", spark.conf.get("spark.sql.caseSensitive"))
    kind = "TIMESTAMP_NTZ" if timestamps_without_zone else spark.conf.get("spark.sql.timestampType", "TIMESTAMP_LTZ")
    own.conf.set("spark.sql.timestampType", kind)
    return own.read.options(header="true", inferSchema=str(infer).lower()).csv(path).schema


#: Whole numbers and decimals in the order in which each holds the one before.
_WHOLE = (T.IntegerType(), T.LongType())


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both as they were written.

    Equal types stay. Whole numbers widen to ``bigint``, then to a decimal with
    room for them; a number and a ``double`` to ``double``, except that a
    ``bigint`` or decimal of more than 15 digits would lose some: that is text.
    A date and a timestamp without zone widen to the timestamp. A column seen
    without any value (``void``) takes the other's type. All else is text.
    """
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if a in _WHOLE and b in _WHOLE:
        return T.LongType()
    kinds = {type(a), type(b)}
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    exact = [_as_decimal(x) for x in (a, b)]
    if all(exact):
        scale = max(x.scale for x in exact)
        digits = max(x.precision - x.scale for x in exact) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    if T.DoubleType in kinds:
        other = next((x for x in exact if x), None)
        if other is not None and other.precision <= 15:
            return T.DoubleType()
    return T.StringType()


def _as_decimal(x: T.DataType) -> T.DecimalType | None:
    if isinstance(x, T.DecimalType):
        return x
    return {T.IntegerType: T.DecimalType(10, 0), T.LongType: T.DecimalType(19, 0)}.get(type(x))


def merge_schemas(known: T.StructType, found: T.StructType) -> T.StructType:
    """The schema that reads the files of two crawls by position: shared columns widened, new ones last."""
    shared = min(len(known), len(found))
    for i in range(shared):
        if known[i].name != found[i].name:
            raise ValueError(f"column {i + 1} is {known[i].name} in the table and {found[i].name} in the files; the shared columns must come first, in one order")
    both = [T.StructField(k.name, wider(k.dataType, f.dataType)) for k, f in zip(known.fields[:shared], found.fields[:shared], strict=True)]
    longer = known if len(known) > shared else found
    return T.StructType([*both, *(T.StructField(f.name, f.dataType) for f in longer.fields[shared:])])


def _drop_external(spark: SparkSession, name: str) -> None:
    """Forget an external table's definition; a managed table, whose files would go, is refused."""
    if not spark.catalog.tableExists(name):
        return
    if spark.catalog.getTable(name).tableType != "EXTERNAL":
        raise ValueError(f"{name} exists and is no external table")
    spark.sql(f"DROP TABLE {name}")


def register_parquet_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Register a (partitioned) Parquet dataset and find its partitions.

    Partition columns come from the ``col=value`` directories; until
    ``recoverPartitions`` runs, a partitioned external table reads as empty.
    Registering a name again for the same folder and columns alters only the
    partitions that came or went (:func:`refresh_parquet_partitions`); for
    others it replaces the definition. The files are untouched.
    """
    check_table_name(name)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "EXTERNAL":
        found = spark.read.parquet(path).schema
        if _bare(table_location(spark, name)) == _bare(path) and spark.table(name).schema == found:
            refresh_parquet_partitions(spark, name)
            return spark.table(name)
    _drop_external(spark, name)
    spark.catalog.createTable(name, path=path, source="parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)


class PartitionDiff(NamedTuple):
    """Partitions that a crawl added to the catalog and dropped from it, as ``column=value`` paths."""

    added: tuple[str, ...]
    dropped: tuple[str, ...]


def _bare(path: str) -> str:
    return "/" + path.split(":", 1)[-1].strip("/")


def refresh_parquet_partitions(spark: SparkSession, name: str) -> PartitionDiff:
    """S5 on a registered table: bring the catalog's partitions in line with the folders, touching only what differs.

    Folder names are listed level by level, files are not read, and only the
    partitions that came or went are altered. A folder whose value has
    disappeared takes its partition with it; the rows of unchanged partitions
    are not looked at.
    """
    check_table_name(name)
    columns = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if not columns:
        spark.catalog.refreshTable(name)
        return PartitionDiff((), ())
    location = table_location(spark, name).rstrip("/")
    found = [""]
    for column in columns:
        found = [f"{at}/{folder.rsplit('/', 1)[1]}" for at in found for folder in list_folders(spark, location + at) if folder.rsplit("/", 1)[1].startswith(f"{column}=")]
    found = {f.lstrip("/") for f in found}
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    added, dropped = sorted(found - known), sorted(known - found)
    for verb, paths in (("ADD IF NOT EXISTS", added), ("DROP IF EXISTS", dropped)):
        for lo in range(0, len(paths), 100):
            specs = [f"PARTITION ({_spec(p)})" for p in paths[lo : lo + 100]]
            spark.sql(f"ALTER TABLE {name} {verb} " + (" " if verb.startswith("ADD") else ", ").join(specs))
    spark.catalog.refreshTable(name)
    return PartitionDiff(tuple(added), tuple(dropped))


def _spec(path: str) -> str:
    """``month=1/city=Pune`` as the inside of a PARTITION clause; folder names escape special characters."""
    parts = [p.split("=", 1) for p in path.split("/")]
    values = {c: "null" if v == "__HIVE_DEFAULT_PARTITION__" else "'" + _quote(unquote(v)) + "'" for c, v in parts}
    return ", ".join(f"`{c}` = {v}" for c, v in values.items())


def footer_count(spark: SparkSession, path: str | Sequence[str], name: str = "row_count") -> DataFrame:
    """The rows of Parquet files from their footers, as a one-row DataFrame.

    The count is pushed into the scan (``PushedAggregation: [COUNT(*)]``): no
    row group is read. The newer Parquet reader that can do this is switched
    on in a session of its own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    paths = [path] if isinstance(path, str) else list(path)
    return own.read.parquet(*paths).agg(F.count(F.lit(1)).alias(name))


def _quote(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
