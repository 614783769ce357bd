"""Intermediate tables of the corpus operators.

Lineage is cut with Parquet tables under the shared folder that the session
names in ``spark.checkpoint.dir`` (see :func:`cartwheel.session.scratch_root`),
so a lost executor costs a re-read and never a recomputation from the start.
"""

from __future__ import annotations

from types import ModuleType

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

#: Spark then deletes an execution's shuffle files at its end, not when the driver's garbage is collected.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A batch of whole texts stands in memory on both sides of the pipe to Python: its bytes are bounded, not only its rows.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BATCH_BYTES = 4 << 20


class Scratch:
    """A folder of intermediate tables for one call of one operator.

    ``table`` writes a DataFrame and returns it as read back; ``drop`` deletes
    tables that no later step reads. Tables that the returned DataFrame still
    reads stay until the session's scratch folder is cleaned.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)
        self.names: set[str] = set()

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back; the shuffle files of the write go when it ends, batches for Python are small."""
        path = f"{self.root}/{name}"
        self.names.add(name)
        conf = self.spark.conf
        before = {CLEAN_SHUFFLES: conf.get(CLEAN_SHUFFLES, "false"), BATCH_BYTES: conf.get(BATCH_BYTES)}
        conf.set(CLEAN_SHUFFLES, "true")
        conf.set(BATCH_BYTES, _smaller_batch(before[BATCH_BYTES]))
        try:
            df.write.parquet(path)
        finally:
            for key, value in before.items():
                conf.set(key, value)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_others(self, *kept: str) -> None:
        """Delete all tables but these."""
        self.drop(*(self.names - set(kept)))

    def drop(self, *names: str) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        for name in names:
            path = hadoop(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)
            self.names.discard(name)


def _smaller_batch(size: str) -> str:
    """The session's batch size, or ours where it has none (0 or less) or a larger one."""
    own = int(size) if size.lstrip("-").isdigit() else 0
    return size if 0 < own <= MOST_BATCH_BYTES else str(MOST_BATCH_BYTES)


def worker_state() -> dict:
    """A dict that lives as long as a Python worker: caches outlast a task there.

    The functions of this package travel to the executors by value, so their
    module globals are new in every task.
    """
    import sys

    module = sys.modules.setdefault("_cartwheel_worker_state", ModuleType("_cartwheel_worker_state"))
    return module.__dict__
