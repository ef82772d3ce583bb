"""Stream sources and plain stream operators: drain, inject, filter, de-duplicate, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tidelog.operators.quality import since
from tidelog.session import new_folder


def table_stream(
    spark: SparkSession, folder: str, name: str, schema: StructType, max_files: int = 100
) -> DataFrame:
    """Parquet files of one table in a folder as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", f"{name}.parquet")
        .option("maxFilesPerTrigger", max_files)
        .parquet(folder)
    )


def finish(writer: DataStreamWriter, stepwise: bool = False) -> StreamingQuery:
    """Run a stream over everything available, then stop.

    A source of log files with a limit per batch fixes the end of an available-now run at its first
    limit; ``stepwise`` runs batch after batch until nothing is left.
    """
    if not stepwise:
        started = writer.trigger(availableNow=True).start()
        started.awaitTermination()
        return started
    started = writer.trigger(processingTime="0 seconds").start()
    try:
        started.processAllAvailable()
    finally:
        started.stop()
    return started


def drain(
    stream: DataFrame,
    label: str = "drain",
    sink: str | None = None,
    checkpoint: str | None = None,
    stepwise: bool = False,
) -> DataFrame:
    """Process everything available now into Parquet, stop, and read the result.

    With the same sink and checkpoint a later call goes on where this one stopped.
    """
    spark = stream.sparkSession
    sink = sink or new_folder(spark, label)
    checkpoint = checkpoint or new_folder(spark, f"{label}-checkpoint")
    writer = (
        stream.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    finish(writer, stepwise)
    return spark.read.schema(stream.schema).parquet(sink)


def inject(stream: DataFrame, extra: DataFrame) -> DataFrame:
    """Events of a second feed mixed into the first."""
    return stream.unionByName(extra)


def stream_since(stream: DataFrame, start: str, ts_col: str = "ts") -> DataFrame:
    """Start-time filter in front of any state."""
    return since(stream, start, ts_col)


def dedup_stream(transactions: DataFrame, ts_col: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Drop GTIDs delivered again after a reconnect within ``delay``."""
    return transactions.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(["sid", "gno"])


def activity(
    changes: DataFrame,
    window: str | None = None,
    slide: str | None = None,
    session_gap: str | None = None,
    ts_col: str = "ts",
    delay: str = "1 hour",
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Changes per tumbling, sliding or session window of event time.

    Late rows are dropped once the watermark passed their window; batch input
    ignores the watermark.
    """
    span = (
        F.session_window(ts_col, session_gap)
        if session_gap
        else F.window(ts_col, window, slide) if slide else F.window(ts_col, window)
    )
    return (
        changes.withWatermark(ts_col, delay)
        .groupBy(span.alias("span"), *by)
        .agg(F.count("*").alias("n"))
        .select(F.col("span.start").alias("start"), F.col("span.end").alias("end"), *by, "n")
    )
