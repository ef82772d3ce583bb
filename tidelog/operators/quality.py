"""Filters, flags and validity of log events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators import mariadb

HEADER_SIZE = 19

# Event header flag bits.
IN_USE, FORCED_ROTATE, THREAD_SPECIFIC, SUPPRESS_USE = 0x1, 0x2, 0x4, 0x8
UPDATE_TABLE_MAP_VERSION, ARTIFICIAL, RELAY_LOG, IGNORABLE = 0x10, 0x20, 0x40, 0x80
NO_FILTER, MTS_ISOLATE = 0x100, 0x200


def since(df: DataFrame, start: str, ts_col: str = "ts") -> DataFrame:
    """Events at or after ``start``; header times are whole seconds."""
    kind = dict(df.dtypes)[ts_col]
    return df.filter(F.date_trunc("second", F.col(ts_col)).cast(kind) >= F.lit(start).cast(kind))


def of_type(df: DataFrame, *types: int) -> DataFrame:
    return df.filter(F.col("event_type").isin(*types))


def flag(mask: int, col: str = "flags") -> Column:
    return F.col(col).bitwiseAND(F.lit(mask)) != 0


def has_flag(df: DataFrame, mask: int) -> DataFrame:
    return df.filter(flag(mask))


def mariadb_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_ddl": flag(mariadb.DDL),
            "is_standalone": flag(mariadb.STANDALONE),
            "is_group_commit": flag(mariadb.GROUP_COMMIT),
        }
    )


def invalid_reason(event_size: Column, raw_length: Column) -> Column:
    return (
        F.when(event_size < HEADER_SIZE, "event size below header size")
        .when(raw_length < HEADER_SIZE, "event shorter than its header")
        .when(raw_length != event_size, "event length differs from its size")
    )


def validate(log_events: DataFrame) -> DataFrame:
    """Add ``error`` where the frame contradicts its header (expects ``raw_length``)."""
    return log_events.withColumn(
        "error", invalid_reason(F.col("event_size"), F.col("raw_length"))
    )


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without and with an ``error``."""
    return df.filter(F.col("error").isNull()).drop("error"), df.filter(F.col("error").isNotNull())
