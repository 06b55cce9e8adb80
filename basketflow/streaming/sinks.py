"""Sinks whose repeated batches replace rather than add."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import file_system
from ..sources.files import append_version, next_generation


def generation_of(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The generation of a checkpoint: above everything in the table when it first starts.

    It is kept beside the checkpoint, so a restart continues it and a new checkpoint, whose batch
    numbers begin at 0 again, still outranks what older ones wrote.
    """
    note = f"{checkpoint.rstrip('/')}.generation"
    system, target = file_system(spark, note)
    if system.exists(target):
        names = [s.getPath().getName() for s in system.listStatus(target)]
        return int(names[0])
    generation = next_generation(spark, path)
    system.mkdirs(file_system(spark, f"{note}/{generation}")[1])
    return generation


def versioned_sink(path: str, generation: int = 0) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer: a replayed batch overwrites its own folders, an empty one writes
    nothing. The batch is kept while it is counted and written, so its plan, state included, runs
    once, and in one job: looking for a first row would take the state's partitions a few at a time."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.count():
                append_version(batch, path, batch_id, generation)
        finally:
            batch.unpersist()

    return write
