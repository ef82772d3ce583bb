"""Streaming queries: each drains what is available and returns the final table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import gtid, images
from tidelog.plans import views as v
from tidelog.plans.archive import archive
from tidelog.plans.archive_queries import _ORDERS, ORDERS_SPEC, _orders_out, _type_counts, _ALL_EDGES
from tidelog.plans.gtid_queries import _islands
from tidelog.plans.registry import query
from tidelog.plans.views import with_views
from tidelog.session import new_folder, settle, table
from tidelog.sources import binlog, sinks
from tidelog.streaming import feeds, state


def _events_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    raw = feeds.table_stream(spark, sf, "events", schema)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def _files_stream(df, label, pieces=4, later=None):
    """A table as several stream files, so that a drain runs over several batches.

    ``later`` rows come in files, and so in batches, behind all others.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.repartition(pieces).write.parquet(folder)
    if later is not None:
        later.repartition(pieces).write.mode("append").parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query("stream_binlog", f"SELECT event_type, n FROM ({_type_counts(_ALL_EDGES)})")
def stream_binlog(spark, sf):
    log = binlog.stream_binlog(spark, archive(spark, sf))
    drained = feeds.drain(log.select("event_type", "start_pos"), "stream-binlog")
    return drained.groupBy("event_type").agg(F.count("*").alias("n"))


@query("stream_bind_maps", _ORDERS)
def stream_bind_maps(spark, sf):
    # Batches end at statement boundaries, so binding needs no state.
    log = binlog.stream_binlog(spark, archive(spark, sf))
    changes = images.typed_changes(images.row_changes(log), "shop", "orders", ORDERS_SPEC)
    return feeds.drain(changes.filter(F.col("op") == "I").select(*_orders_out()), "stream-bind")


@query("stream_drain", "SELECT count(*) AS n FROM events")
def stream_drain(spark, sf):
    drained = feeds.drain(_events_stream(spark, sf).select("event_id"), "stream-drain")
    return drained.agg(F.count("*").alias("n"))


@query(
    "stream_union_inject",
    "SELECT event_id, event_type FROM events UNION ALL SELECT o_orderkey, 'order' FROM orders",
)
def stream_union_inject(spark, sf):
    orders = feeds.table_stream(spark, sf, "orders", table(spark, sf, "orders").schema)
    extra = orders.select(F.col("o_orderkey").alias("event_id"), F.lit("order").alias("event_type"))
    both = feeds.inject(_events_stream(spark, sf).select("event_id", "event_type"), extra)
    return feeds.drain(both, "stream-inject")


@query(
    "stream_start_time",
    "SELECT event_id FROM events WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-10 12:00:00'",
)
def stream_start_time(spark, sf):
    late = feeds.stream_since(_events_stream(spark, sf), "2024-01-10 12:00:00")
    return feeds.drain(late.select("event_id"), "stream-since")


@query("stream_dedup", with_views("gtids_all", "SELECT sid, gno, count(*) AS n FROM gtids_all GROUP BY sid, gno"))
def stream_dedup(spark, sf):
    gtids = v.gtids_all(spark, sf)
    # Seconds follow the event order; repeats carry the time of the first delivery
    # and come in later batches.
    timed = gtids.withColumn("ts", F.timestamp_seconds(F.col("event_id") + 1_704_067_200))
    stream = _files_stream(timed, "dedup-in", 2, later=timed.filter(F.col("event_id") % 3 == 0))
    once = feeds.drain(feeds.dedup_stream(stream, delay="365 days").select("sid", "gno"), "stream-dedup")
    return once.groupBy("sid", "gno").agg(F.count("*").alias("n"))


@query("stream_gtid_state", with_views("gtids_all gtids_mysql", _islands("gtids_mysql")))
def stream_gtid_state(spark, sf):
    transactions = v.gtids_mysql(v.gtids_all(spark, sf)).select("sid", "gno")
    return state.run_executed_set(_files_stream(transactions, "gtid-in"))


@query(
    "stream_resume_gtid",
    with_views(
        "gtids_all gtids_mysql_b",
        """SELECT event_id, sid, gno FROM gtids_all a
           WHERE NOT EXISTS (SELECT 1 FROM gtids_mysql_b b WHERE a.sid = b.sid AND a.gno = b.gno)""",
    ),
)
def stream_resume_gtid(spark, sf):
    gtids = v.gtids_all(spark, sf)
    executed = settle(gtid.executed_set(v.gtids_mysql_b(gtids).select("sid", "gno")), "executed")
    return state.run_resume(_files_stream(gtids, "resume-in", 2), executed)


@query(
    "stream_apply",
    with_views(
        "change_log",
        """, l AS (SELECT pk, op, value FROM change_log QUALIFY row_number() OVER (PARTITION BY pk ORDER BY seq DESC) = 1)
        SELECT coalesce(c.c_custkey, l.pk) AS pk, CASE WHEN l.op IS NULL THEN c.c_acctbal ELSE l.value END AS value
        FROM customer c FULL JOIN l ON c.c_custkey = l.pk WHERE l.op IS NULL OR l.op <> 'D'""",
    ),
)
def stream_apply(spark, sf):
    base = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("pk"), F.col("c_acctbal").alias("value")
    )
    changes = v.change_log(spark, sf).select("pk", "seq", "op", "value")
    return state.run_apply(_files_stream(changes, "apply-in", 3), base, ["pk"], "seq")


@query(
    "sink_foreach_batch",
    "SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY event_type",
)
def sink_foreach_batch(spark, sf):
    folder = new_folder(spark, "callback")

    def on_batch(batch, batch_id):
        counts = batch.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("user_id").alias("users"))
        counts.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    sinks.for_each_batch(
        _events_stream(spark, sf), on_batch, new_folder(spark, "callback-checkpoint")
    ).awaitTermination()
    parts = spark.read.option("recursiveFileLookup", "true").parquet(folder)
    return parts.groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("users").alias("users"))


# -- event-time windows ---------------------------------------------------------------


def _windowed(spark, sf, output="update", **how):
    counted = feeds.activity(_events_stream(spark, sf), by=("event_type",), **how)
    folder, check = new_folder(spark, "windows"), new_folder(spark, "windows-checkpoint")

    # A batch stores the windows it changed; the last version of each is the final one.
    def store(batch, batch_id):
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{folder}/b={batch_id}")

    started = (
        counted.writeStream.foreachBatch(store).outputMode(output).option("checkpointLocation", check)
        .trigger(availableNow=True).start()
    )
    started.awaitTermination()
    versions = spark.read.option("recursiveFileLookup", "true").parquet(folder)
    final = versions.groupBy("start", "end", "event_type").agg(F.max_by("n", "batch_id").alias("n"))
    return final.select(
        F.unix_seconds("start").alias("start_s"), F.unix_seconds("end").alias("end_s"), "event_type", "n"
    )


@query(
    "win_tumbling",
    """SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS start_s, CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 + 3600 AS end_s, event_type, count(*) AS n
       FROM events GROUP BY ALL""",
)
def win_tumbling(spark, sf):
    return _windowed(spark, sf, window="1 hour")


@query(
    "win_sliding",
    """SELECT (CAST(floor(epoch(ts) / 1800) AS BIGINT) - i.n) * 1800 AS start_s, (CAST(floor(epoch(ts) / 1800) AS BIGINT) - i.n) * 1800 + 3600 AS end_s, event_type, count(*) AS n
       FROM events, (SELECT unnest([0, 1]) AS n) i GROUP BY ALL""",
)
def win_sliding(spark, sf):
    return _windowed(spark, sf, window="1 hour", slide="30 minutes")


@query(
    "win_session",
    """, s AS (SELECT event_type, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w <= 1200000000 THEN 0 ELSE 1 END AS fresh
              FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY event_type ORDER BY t ROWS UNBOUNDED PRECEDING) AS grp FROM s)
    SELECT event_type, CAST(floor(min(t) / 1000000) AS BIGINT) AS start_s, CAST(floor((max(t) + 1200000000) / 1000000) AS BIGINT) AS end_s, count(*) AS n
    FROM g GROUP BY event_type, grp""".replace(", s AS", "WITH s AS", 1),
)
def win_session(spark, sf):
    # Sessions cannot be emitted in update mode, and append mode would hold back
    # those still open when the drain ends.
    return _windowed(spark, sf, "complete", session_gap="20 minutes")
