"""Row events: binding to the table map in force, orphans, log union."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.scan import SEGMENT, by_width, last_known, ordered_scan, running_max


def bind_table_maps(
    log: DataFrame,
    file_keys: Sequence[str],
    order: str,
    is_map: Column,
    ends_statement: Column,
    payload: str,
    width: int = SEGMENT,
) -> DataFrame:
    """Add ``table_map``: the payload of the map each row event refers to.

    That is the last map with the same table id in the same file, unless a
    statement ended after it: a row event flagged as the end of its statement
    drops all maps after itself. Comparing the two positions replaces any
    grouping by statement, so a statement of any size is spread over segments.
    """
    seen = F.when(is_map, F.struct(F.col(order).alias("at"), F.col(payload).alias("map")))
    bound = ordered_scan(
        log,
        file_keys,
        [order],
        by_width(order, width),
        __ended=running_max(F.when(ends_statement, F.col(order)), inclusive=False),
        __map=last_known(seen).per("table_id"),
    )
    alive = F.col("__ended").isNull() | (F.col("__map")["at"] > F.col("__ended"))
    return bound.withColumn("table_map", F.when(alive, F.col("__map")["map"])).drop(
        "__ended", "__map"
    )


def orphans(bound: DataFrame) -> DataFrame:
    """Row events without a table map: set aside, the rest goes on."""
    return bound.filter(F.col("table_map").isNull()).withColumn(
        "error", F.lit("no table map for this table id")
    )


def union_logs(**logs: DataFrame) -> DataFrame:
    """Several logs as one; the keyword becomes the ``source`` column."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in logs.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)
