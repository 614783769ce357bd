"""Session settings and the shared scratch folder.

Jobs that write intermediate tables (round trips, staged tables) place them
under the folder the cluster names in ``spark.checkpoint.dir``. A job never
picks a machine-local folder on a cluster; only a local-mode session without
that setting (tests, a laptop) uses a folder in its own warehouse.
``release_scratch`` deletes what a session's runs have left there.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

#: Scratch of this process not yet released: paths, and databases.
_PATHS: list[str] = []
_DATABASES: list[str] = []

# Runtime SQL settings the jobs rely on. They are per-session and safe to set
# on a session someone else built.
SQL_SETTINGS: dict[str, str] = {
    # Adaptive execution: coalesce small shuffle partitions, split skewed ones,
    # and rebalance partitioned writes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Static overwrite of partitioned datasets, as the extract job expects.
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(
    master: str | None = None,
    app_name: str = "cartwheel",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create or get a session with the settings the jobs assume.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (about 128-256 MB of shuffle data per partition); AQE coalesces the
    rest. Locally a partition per core is right.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SQL_SETTINGS)
    settings["spark.sql.session.timeZone"] = "UTC"
    settings["spark.ui.enabled"] = "false"
    settings["spark.ui.showConsoleProgress"] = "false"
    # Remove checkpoint files of DataFrames that are no longer referenced.
    settings["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_sql_settings(spark)
    return spark


def apply_sql_settings(spark: SparkSession) -> None:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate data: ``spark.checkpoint.dir``.

    Read from the session first. Only a local-mode session with no setting
    uses a folder of its warehouse, which is then also made the checkpoint dir.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a SparkContext (remote clients)
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir().rstrip("/")
        return configured.rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS, object store) "
            "for intermediate tables"
        )
    local = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if sc is None:
        return local
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def durable_root(spark: SparkSession) -> str:
    """The shared folder itself, which a later session finds again.

    ``scratch_root`` is a folder of this session's own inside it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured.rstrip("/") if configured else scratch_root(spark).rsplit("/", 1)[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the scratch root for one run of ``name``."""
    root = scratch_root(spark)
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    _PATHS.append(path)
    return path


def scratch_database(spark: SparkSession, name: str) -> str:
    """Create a fresh database whose tables live under the scratch root."""
    db = f"cw_{name}_{uuid.uuid4().hex[:10]}"
    location = scratch_path(spark, f"db-{name}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{location}'")
    _DATABASES.append(db)
    return db


def release_scratch(spark: SparkSession) -> int:
    """Drop every scratch database and delete every scratch path made so far; how many there were.

    Call it when no DataFrame that reads them is in use any more: a query's
    result often reads its scratch tables.
    """
    count = len(_PATHS) + len(_DATABASES)
    while _DATABASES:
        spark.sql(f"DROP DATABASE IF EXISTS `{_DATABASES.pop()}` CASCADE")
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    while _PATHS:
        path = spark._jvm.org.apache.hadoop.fs.Path(_PATHS.pop())
        path.getFileSystem(conf).delete(path, True)
    return count


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so a path can be used by local tools in tests."""
    if path.startswith("file://"):
        return path[len("file://") :]
    if path.startswith("file:"):
        return path[len("file:") :]
    return os.fspath(path)
