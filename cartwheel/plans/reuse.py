"""Keep one DataFrame for several actions.

``kept(df, "stage")`` computes the rows once and writes them as a Parquet
table in a scratch database under ``spark.checkpoint.dir`` (shared storage),
cutting the lineage; the database is dropped when the block ends. Later
actions read that columnar copy (and only the columns they need); a lost
executor costs nothing but a re-read, and a source that changes meanwhile (a
live database) cannot make the rows written differ from the rows checked.
``kept(df, "none")`` runs every action on the plan itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from ..session import scratch_database

KEEP_MODES = ("stage", "none")


@contextmanager
def kept(df: DataFrame, mode: str = "stage") -> Iterator[DataFrame]:
    if mode not in KEEP_MODES:
        raise ValueError(f"keep must be one of {', '.join(KEEP_MODES)}")
    if mode == "none":
        yield df
    else:
        with staged(df) as rows:
            yield rows


@contextmanager
def staged(df: DataFrame, name: str = "staged", drop: bool = True) -> Iterator[DataFrame]:
    """Write ``df`` once as a Parquet table under the scratch root; drop it at the end
    (unless ``drop`` is false, to look at the rows afterwards)."""
    spark = df.sparkSession
    db = scratch_database(spark, name)
    table = f"{db}.rows"
    try:
        df.write.format("parquet").saveAsTable(table)
        yield spark.table(table)
    finally:
        if drop:
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
