"""Transactions inside a log: assignment, rollup, positions, commit lag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.scan import (
    SEGMENT,
    by_width,
    last_known,
    ordered_scan,
    running_max,
    running_sum,
)


def assign_transactions(
    log: DataFrame,
    source_keys: Sequence[str],
    order: str,
    opens: Column,
    closes: Column,
    identity: str,
    width: int = SEGMENT,
) -> DataFrame:
    """Give each event the identity of the transaction it belongs to.

    A transaction opens at its GTID event and closes after its XID / COMMIT;
    events between a close and the next open belong to none.
    """
    scanned = ordered_scan(
        log,
        source_keys,
        [order],
        by_width(order, width),
        __open=last_known(F.when(opens, F.struct(F.col(order).alias("at"), identity))),
        __closed=running_max(F.when(closes, F.col(order)), inclusive=False),
        tx_ordinal=running_sum(opens.cast("bigint")),
    )
    alive = F.col("__closed").isNull() | (F.col("__open")["at"] > F.col("__closed"))
    return scanned.withColumn("tx_id", F.when(alive, F.col("__open")[identity])).drop(
        "__open", "__closed"
    )


def tx_rollup(assigned: DataFrame, keys: Sequence[str], order: str, is_row: Column) -> DataFrame:
    """Events, row events, bytes and extent of each transaction."""
    return (
        assigned.filter(F.col("tx_id").isNotNull())
        .groupBy(*keys, "tx_id")
        .agg(
            F.count("*").alias("events"),
            F.count_if(is_row).alias("row_events"),
            F.sum("event_size").alias("bytes"),
            F.min(order).alias("first_pos"),
            F.max(order).alias("last_pos"),
        )
    )


def top_transactions(rollup: DataFrame, k: int, *ties: str) -> DataFrame:
    return rollup.orderBy(F.col("bytes").desc(), *ties).limit(k)


def next_position(
    log: DataFrame,
    source_keys: Sequence[str],
    order: str,
    width: int = SEGMENT,
) -> DataFrame:
    """Where a reader that has handled this event would go on.

    ``log`` has ``file, log_pos, rotate_file, rotate_pos``: a rotate replaces
    name and offset, any other event moves the offset when its log_pos is set.
    """
    target = F.when(
        F.col("rotate_file").isNotNull(),
        F.struct(F.col("rotate_file").alias("file"), F.col("rotate_pos").alias("pos")),
    ).when(F.col("log_pos") > 0, F.struct(F.col("file"), F.col("log_pos").alias("pos")))
    scanned = ordered_scan(
        log, source_keys, [order], by_width(order, width), __next=last_known(target)
    )
    return scanned.select(
        *log.columns, F.col("__next.file").alias("next_file"), F.col("__next.pos").alias("next_pos")
    )


def commit_lag(gtid_events: DataFrame) -> DataFrame:
    """Microseconds between the original and the local commit; 0 stands for unknown."""
    local = F.nullif(F.col("immediate_commit_us"), F.lit(0))
    origin = F.nullif(F.col("original_commit_us"), F.lit(0))
    return gtid_events.withColumn("lag_us", local - origin)
