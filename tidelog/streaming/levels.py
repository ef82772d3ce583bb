"""Batches of a stream as written runs that are merged as they come, like the digits of a counter.

Batch ``n`` is written to ``level=0/at=n``. When ``fan`` runs of a level are full, they are merged into one
run of the next, so a reader meets fewer than ``2 * fan`` runs a level however long the stream has run. What
a merge has read is dropped when the next batch begins, as only then Spark has committed the batch
that merged: a batch that is run again finds all it needs and writes the same runs anew. Readers may
meet a row both in a run and in the run it was merged into, so they take the newest row of a key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidelog.session import drop_tables

#: Runs merged into one of the next level.
FAN = 8


def _merges(batch_id: int, fan: int) -> list[tuple[str, list[str]]]:
    """(run, runs it is merged from) for every merge that is due after a batch, lower levels first."""
    due, size, level = [], fan, 1
    while (batch_id + 1) % size == 0:
        first, part = batch_id + 1 - size, size // fan
        parts = [f"level={level - 1}/at={first + k * part}" for k in range(fan)]
        due.append((f"level={level}/at={first}", parts))
        size, level = size * fan, level + 1
    return due


def store(batch: DataFrame, folder: str, batch_id: int, newest: Callable[[DataFrame], DataFrame], fan: int = FAN) -> None:
    """Write a batch as a run and do the merges that are due; ``newest`` keeps one row per key."""
    spark = batch.sparkSession
    if batch_id:
        drop_tables(spark, [f"{folder}/{p}" for _, parts in _merges(batch_id - 1, fan) for p in parts])
    batch.write.mode("overwrite").parquet(f"{folder}/level=0/at={batch_id}")
    for run, parts in _merges(batch_id, fan):
        # Written with the batch's schema, so an empty run needs no file of its own to be read.
        read = spark.read.schema(batch.schema).parquet(*[f"{folder}/{p}" for p in parts])
        newest(read).select(*batch.columns).write.mode("overwrite").parquet(f"{folder}/{run}")


def runs(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """All rows of all runs."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
