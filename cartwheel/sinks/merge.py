"""Latest update per key kept in a stored table, without shuffling its history (D1 into a table).

The table is bucketed by its key: every bucket is a file (or a few) with the
keys of one hash range. A batch of updates is reduced to one row per key (D1),
dealt into the same buckets and joined bucket by bucket: the history is read
where it lies, and only the batch crosses the network. The result is the next
version of the table, written bucket by bucket, and the table's pointer is set
to it (:mod:`cartwheel.sinks.versions`).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import dedup_latest
from ..plans.params import check_identifier, check_table_name
from ..schema import KEY_COLUMN
from ..storage import delete_path
from .versions import Watch, columns_ddl, drop_old_versions, new_version, point_to

BUCKETS = 64


def merged_latest(history: DataFrame, batch: DataFrame, key: str = KEY_COLUMN, order_by: Sequence[str] = ("updated_at",), buckets: int = BUCKETS) -> DataFrame:
    """One row per key of both sides: the greatest by (``order_by``, other columns), as D1 picks it.

    ``history`` must hold one row per key already; ``batch`` may hold several.
    A NULL key is a key like any other. Equal rows on both sides are one.
    ``buckets`` is the history's number of buckets: the batch is dealt into as
    many partitions, so that the join takes the history as it lies.
    """
    names = history.columns
    ordered = [*order_by, *[c for c in names if c != key and c not in order_by]]
    boxed = lambda df, box: df.select(F.col(key).alias(f"{box}_key"), F.struct(*ordered).alias(box))
    # A literal beside the key would spoil the bucketing, so NULL keys are joined apart: at most one row a side.
    old, new = boxed(history, "old"), boxed(dedup_latest(batch.select(*names), key, order_by), "new")
    dealt = new.filter("new_key IS NOT NULL").repartition(buckets, "new_key")
    known = old.filter("old_key IS NOT NULL").join(dealt.hint("merge"), F.col("old_key") == F.col("new_key"), "full_outer")
    rows = known.select(F.coalesce("old_key", "new_key").alias(key), F.greatest("old", "new").alias("row"))
    none = old.filter("old_key IS NULL").select("old").unionByName(new.filter("new_key IS NULL").select(F.col("new").alias("old")))
    none = none.agg(F.max("old").alias("row")).filter("row IS NOT NULL").select(F.lit(None).cast(history.schema[key].dataType).alias(key), "row")
    picked = rows.unionByName(none)
    return picked.select(*[F.col(c) if c == key else F.col(f"row.{c}").alias(c) for c in names])


def merge_latest(
    batch: DataFrame, name: str, key: str = KEY_COLUMN, order_by: Sequence[str] = ("updated_at",), buckets: int = BUCKETS, watch: Watch = lambda step: None
) -> int:
    """Put the updates of ``batch`` into the bucketed table ``name``; its rows afterwards.

    The table is created, with ``buckets`` buckets, if it is missing, and keeps
    its number of buckets after that. A crash leaves the old rows or the new;
    a batch that is merged twice changes nothing.
    """
    check_table_name(name)
    check_identifier(key, "key")
    spark = batch.sparkSession
    if spark.catalog.tableExists(name):
        buckets = _buckets(spark, name, key)
        rows = merged_latest(spark.table(name), batch, key, order_by, buckets)
    else:
        rows = dedup_latest(batch, key, order_by)
    folder = new_version(spark, name)
    fresh = f"{name}__merge_{uuid.uuid4().hex[:10]}"
    obs = Observation(f"merge_{uuid.uuid4().hex[:8]}")
    try:
        watch("write")
        spread = rows if spark.catalog.tableExists(name) else rows.repartition(buckets, key)
        spread.observe(obs, F.count(F.lit(1)).alias("rows")).write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", folder).saveAsTable(fresh)
        body = columns_ddl(spark.table(fresh))
        spark.sql(f"DROP TABLE {fresh}")  # the definition; the files stay
        watch("written")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        delete_path(spark, folder)
        raise
    point_to(spark, name, folder, body, watch, more=f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS")
    drop_old_versions(spark, name)
    return int(obs.get.get("rows", 0))


def _buckets(spark: SparkSession, name: str, key: str) -> int:
    found = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if found.get("Bucket Columns", "").strip("[]`") != key:
        raise ValueError(f"{name} is not bucketed by {key}")
    return int(found["Num Buckets"])
