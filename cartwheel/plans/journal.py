"""A step journal, so that a job that was killed goes on from its last finished step.

A run of a job has an id. Its folder under the shared storage holds the staged
batch and one small entry for each finished step with what the step returned.
A restarted run of the same id skips the steps that have an entry. Steps are
written so that one that was cut off half-way can be run again: staging
overwrites its folder, an append is one batch of the run's id (see
:mod:`cartwheel.sinks.batches`), a replacement swaps a pointer.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import durable_root
from ..sinks.batches import check_batch_id
from ..sinks.versions import Watch
from ..storage import delete_path, read_text, write_text


class Journal:
    """The finished steps of one run; ``step`` runs what is not finished."""

    def __init__(self, spark: SparkSession, job: str, run_id: str, watch: Watch = lambda step: None, root: str | None = None):
        self.spark = spark
        self.run_id = check_batch_id(run_id)
        self.folder = f"{root or durable_root(spark)}/_runs/{job}-{run_id}"
        self.watch = watch

    def _entry(self, name: str) -> str:
        return f"{self.folder}/steps/{name}.json"

    def finished(self, name: str) -> dict | None:
        """What a finished step returned; None if it is not finished."""
        text = read_text(self.spark, self._entry(name))
        return None if text is None else json.loads(text)

    def step(self, name: str, work: Callable[[], dict]) -> dict:
        """Run ``work`` unless its entry is there; its result, which must be plain JSON, is the entry."""
        entry = self.finished(name)
        if entry is not None:
            return entry
        self.watch(f"{name}:begin")
        result = work()
        self.watch(f"{name}:done")
        write_text(self.spark, self._entry(name), json.dumps(result))
        self.watch(f"{name}:noted")
        return result

    def stored(self, name: str, df: Callable[[], DataFrame], counts: Callable[[DataFrame], tuple[DataFrame, Callable[[], dict]]]) -> tuple[DataFrame, dict]:
        """A step that writes rows to the run's folder; the rows as stored, and the counts observed meanwhile."""
        path = f"{self.folder}/{name}"

        def write() -> dict:
            observed, read = counts(df())
            observed.write.mode("overwrite").parquet(path)
            return {"schema": observed.schema.json(), "counts": read()}

        entry = self.step(name, write)
        from pyspark.sql.types import StructType

        return self.spark.read.schema(StructType.fromJson(json.loads(entry["schema"]))).parquet(path), entry["counts"]

    def close(self, *stored: str) -> None:
        """Delete the run's stored rows; its entries stay, so that the id is known as done."""
        for name in stored:
            delete_path(self.spark, f"{self.folder}/{name}")

    def forget(self) -> None:
        """Delete the run with its entries: the next run of this id begins anew."""
        delete_path(self.spark, self.folder)
