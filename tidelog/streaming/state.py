"""Stateful streams: executed GTID set, resume by GTID set, continuous apply."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tidelog.operators import gtid
from tidelog.operators.changes import latest_images
from tidelog.operators.scan import by_width
from tidelog.session import new_folder
from tidelog.streaming import levels
from tidelog.streaming.feeds import finish

# Gnos per state key: a busy server id is spread over many keys, and the
# interval list of a key can never hold more than this many entries.
STATE_RANGE = 1 << 16


def add_gnos(intervals: list[tuple[int, int]], gnos: Sequence[int]) -> list[tuple[int, int]]:
    """Interval list with single gnos added, sorted and coalesced."""
    merged: list[tuple[int, int]] = []
    for start, stop in sorted([*intervals, *((g, g + 1) for g in gnos)]):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(stop, merged[-1][1]))
        else:
            merged.append((start, stop))
    return merged


class ExecutedRanges(StatefulProcessor):
    """Keeps the interval list of one (sid, gno range) and emits it when it changes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.intervals = handle.getListState("intervals", "start bigint, stop bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = [(int(s), int(e)) for s, e in self.intervals.get()] if self.intervals.exists() else []
        new: list[int] = []
        for frame in rows:
            new.extend(frame["gno"].tolist())
        merged = add_gnos(held, new)
        if merged != held:
            self.intervals.put(merged)
            yield pd.DataFrame(
                {
                    "sid": key[0],
                    "gno_range": key[1],
                    "intervals": [[{"start": s, "stop": e} for s, e in merged]],
                }
            )

    def close(self) -> None:
        pass


RANGE_SCHEMA = "sid string, gno_range bigint, intervals array<struct<start:bigint,stop:bigint>>"


def executed_set_stream(transactions: DataFrame, state_range: int = STATE_RANGE) -> DataFrame:
    """Changed (sid, gno range) interval lists per micro-batch (update mode).

    The newest list of each range, merged by ``gtid.normalize``, is the set.
    """
    keyed = transactions.withColumn("gno_range", by_width("gno", state_range))
    return (
        keyed.select("sid", "gno_range", "gno")
        .groupBy("sid", "gno_range")
        .transformWithStateInPandas(
            statefulProcessor=ExecutedRanges(),
            outputStructType=StructType.fromDDL(RANGE_SCHEMA),
            outputMode="Update",
            timeMode="None",
        )
    )


def run_executed_set(
    transactions: DataFrame,
    state_range: int = STATE_RANGE,
    sink: str | None = None,
    checkpoint: str | None = None,
    stepwise: bool = False,
) -> DataFrame:
    """Drain a transaction stream into its executed set.

    Batches are stored as runs that are merged as they come (``levels``). Called again with the
    same ``sink`` and ``checkpoint`` it goes on where it stopped.
    """
    spark = transactions.sparkSession
    lists = sink or new_folder(spark, "executed-set")

    def newest(versions: DataFrame) -> DataFrame:
        last = F.max_by(F.struct("intervals", "batch_id"), "batch_id").alias("last")
        return versions.groupBy("sid", "gno_range").agg(last).select("sid", "gno_range", "last.*")

    def store(batch: DataFrame, batch_id: int) -> None:
        levels.store(batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")), lists, batch_id, newest)

    writer = (
        executed_set_stream(transactions, state_range)
        .writeStream.foreachBatch(store)
        .outputMode("update")
        .option("checkpointLocation", checkpoint or new_folder(spark, "executed-set-checkpoint"))
    )
    with _rocksdb(spark):
        finish(writer, stepwise)
    stored = levels.runs(spark, lists, f"{RANGE_SCHEMA}, batch_id bigint")
    return gtid.normalize(newest(stored).select("sid", F.inline("intervals")))


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """The state store that ``transformWithState`` asks for; other streams of the session keep theirs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Server ids whose own bounds are told to the scan of the set; beyond, one pair of bounds is told for all.
PRUNE_SIDS = 64


def _within_reach(executed: DataFrame, batch: DataFrame) -> DataFrame:
    """Intervals that can hold a gno of the batch: a filter on bounds that file statistics answer."""
    span = [F.min("gno").alias("low"), F.max("gno").alias("high")]
    # At most PRUNE_SIDS + 1 rows reach the driver, and only to choose what to read.
    by_sid = batch.filter(F.col("sid").isNotNull() & F.col("gno").isNotNull()).groupBy("sid").agg(*span)
    found = by_sid.limit(PRUNE_SIDS + 1).collect()
    if not found:
        return executed.filter(F.lit(False))
    if len(found) > PRUNE_SIDS:
        whole = batch.agg(*span).first()
        return executed.filter((F.col("start") <= whole.high) & (F.col("stop") > whole.low))
    reach = [(F.col("sid") == r.sid) & (F.col("start") <= r.high) & (F.col("stop") > r.low) for r in found]
    return executed.filter(reduce(lambda x, y: x | y, reach))


def indexed_set(executed: DataFrame, folder: str) -> DataFrame:
    """The normalized set, written once in (sid, start) order, so that bounds prune files and row groups."""
    spark = executed.sparkSession
    ordered = gtid.normalize(executed).repartitionByRange("sid", "start").sortWithinPartitions("sid", "start")
    ordered.write.parquet(folder)
    return spark.read.schema(ordered.schema).parquet(folder)


def run_resume(
    transactions: DataFrame,
    executed: DataFrame,
    sink: str | None = None,
    checkpoint: str | None = None,
    stepwise: bool = False,
) -> DataFrame:
    """Deliver only transactions that are not in the given set.

    Each micro-batch uses the batch anti join, which is linear in the batch and
    the part of the set it can meet, so neither side has to fit a broadcast. The set is
    normalized and ordered once, before the stream starts, and a batch reads only what lies
    between its own bounds. Called again with the same ``sink`` and ``checkpoint``
    it goes on where it stopped.
    """
    spark = transactions.sparkSession
    sink = sink or new_folder(spark, "resumed")
    executed = indexed_set(executed, new_folder(spark, "executed"))

    def keep_new(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        near = _within_reach(executed, batch)
        gtid.not_in_set(batch, near).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        batch.unpersist()

    writer = transactions.writeStream.foreachBatch(keep_new).option(
        "checkpointLocation", checkpoint or new_folder(spark, "resumed-checkpoint")
    )
    finish(writer, stepwise)
    return spark.read.schema(transactions.schema).option("recursiveFileLookup", "true").parquet(sink)


def run_apply(
    changes: DataFrame,
    base: DataFrame,
    keys: Sequence[str],
    order: str,
    sink: str | None = None,
    checkpoint: str | None = None,
    stepwise: bool = False,
) -> DataFrame:
    """Upsert a change stream into a table.

    A micro-batch stores one last change per key, so its cost follows the batch
    and not the table, and a batch that is run again overwrites itself. Batches are merged
    as they come (``levels``), so what a reader meets stays bounded by the keys changed. Readers
    merge base and runs by ``order`` (``merged_state``); storing that result as the next base
    empties them. Deletes stay as markers until then, which makes late and repeated changes safe. Called again with the same ``sink``
    and ``checkpoint`` it goes on where it stopped.
    """
    spark = changes.sparkSession
    values = [c for c in base.columns if c not in keys]
    cols = [*keys, order, "op", *values]
    deltas = sink or new_folder(spark, "applied")

    def newest(rows: DataFrame) -> DataFrame:
        return latest_images(rows, list(keys), [order]).select(*cols)

    def store(batch: DataFrame, batch_id: int) -> None:
        levels.store(newest(batch.select(*cols)), deltas, batch_id, newest)

    writer = changes.writeStream.foreachBatch(store).option(
        "checkpointLocation", checkpoint or new_folder(spark, "applied-checkpoint")
    )
    finish(writer, stepwise)
    return merged_state(base, levels.runs(spark, deltas, changes.select(*cols).schema), keys, order)


def merged_state(base: DataFrame, deltas: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Base rows with the stored changes on top, deleted keys dropped."""
    values = [c for c in base.columns if c not in keys]
    # A base row is older than any change, whatever the order's type and values.
    none = F.lit(None).cast(dict(deltas.dtypes)[order])
    versions = base.withColumns({order: none, "op": F.lit("I"), "__change": F.lit(False)})
    versions = versions.unionByName(deltas.withColumn("__change", F.lit(True)))
    last = latest_images(versions, list(keys), ["__change", order])
    return last.filter(F.col("op") != "D").select(*keys, *values)
