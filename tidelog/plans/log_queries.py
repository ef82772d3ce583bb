"""Queries over the event log: replay, order, transactions, filters, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import changes, position, quality, rows, transactions
from tidelog.operators.scan import following, ordered_scan
from tidelog.plans import views as v
from tidelog.plans.registry import query
from tidelog.plans.views import with_views
from tidelog.session import table

# -- changes ------------------------------------------------------------------


@query(
    "replay_latest_state",
    with_views(
        "change_log",
        """SELECT pk, seq, op, value, props FROM change_log
           QUALIFY row_number() OVER (PARTITION BY pk ORDER BY seq DESC) = 1 AND op <> 'D'""",
    ),
)
def replay(spark, sf):
    log = v.change_log(spark, sf).select("pk", "seq", "op", "value", "props")
    return changes.replay(log, ["pk"], ["seq"])


@query(
    "merge_apply",
    with_views(
        "change_log",
        """, l AS (SELECT pk, op, value FROM change_log QUALIFY row_number() OVER (PARTITION BY pk ORDER BY seq DESC) = 1)
        SELECT coalesce(c.c_custkey, l.pk) AS pk, CASE WHEN l.op IS NULL THEN c.c_acctbal ELSE l.value END AS value
        FROM customer c FULL JOIN l ON c.c_custkey = l.pk WHERE l.op IS NULL OR l.op <> 'D'""",
    ),
)
def merge_apply(spark, sf):
    base = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("pk"), F.col("c_acctbal").alias("value")
    )
    return changes.merge_changes(base, v.change_log(spark, sf), ["pk"], ["seq"])


@query(
    "pair_update_images",
    with_views(
        "change_log",
        """SELECT seq, CAST(i.n AS BIGINT) AS change_no, op,
             CASE WHEN op <> 'I' THEN value + i.n END AS "before",
             CASE WHEN op <> 'D' THEN value * 2 + i.n END AS "after"
           FROM change_log, (SELECT unnest([0, 1, 2]) AS n) i""",
    ),
)
def pair_images(spark, sf):
    # Three changes per event; updates carry two images each.
    op = F.col("op")
    per_change = F.when(op == "U", 2).otherwise(1)
    log = v.change_log(spark, sf).withColumn(
        "image_idx", F.explode(F.sequence(F.lit(0), 3 * per_change - 1))
    )
    idx = F.col("image_idx")
    n = F.when(op == "U", F.floor(idx / 2)).otherwise(idx)
    kind = (
        F.when(op == "I", "WriteAI")
        .when(op == "D", "DeleteBI")
        .when(idx % 2 == 0, "UpdateBI")
        .otherwise("UpdateAI")
    )
    image = F.when(kind.isin("UpdateBI", "DeleteBI"), F.col("value") + n).otherwise(
        F.col("value") * 2 + n
    )
    images = log.select("seq", "image_idx", kind.alias("kind"), image.alias("image"))
    return changes.pair_images(images, ["seq"], "image")


@query(
    "skipped_columns",
    with_views(
        "change_log",
        """SELECT seq, c AS skipped FROM change_log, (SELECT unnest(range(0, 6)) AS c)
           WHERE (CAST(floor(value) AS BIGINT) >> c) & 1 = 0""",
    ),
)
def skipped(spark, sf):
    bits = F.floor("value").cast("bigint")
    present = F.filter(F.sequence(F.lit(0), F.lit(5)), lambda i: F.getbit(bits, i) == 1)
    every = v.change_log(spark, sf).select(
        "seq", F.explode(changes.skipped_columns(present, F.lit(6))).alias("skipped")
    )
    return every.withColumn("skipped", F.col("skipped").cast("bigint"))


@query(
    "fill_minimal_image",
    with_views(
        "change_log",
        """, m AS (SELECT seq, pk, CASE WHEN seq % 5 = 1 THEN NULL WHEN seq % 3 = 0 THEN NULL ELSE value END AS value,
                  seq % 3 = 0 AS skipped FROM change_log),
        g AS (SELECT *, sum(CASE WHEN skipped THEN 0 ELSE 1 END) OVER (PARTITION BY pk ORDER BY seq ROWS UNBOUNDED PRECEDING) AS grp FROM m)
        SELECT seq, pk, first_value(value) OVER (PARTITION BY pk, grp ORDER BY seq) AS value_filled FROM g""",
    ),
)
def fill_minimal(spark, sf):
    seq = F.col("seq")
    minimal = v.change_log(spark, sf).select(
        "seq",
        "pk",
        F.when((seq % 5 != 1) & (seq % 3 != 0), F.col("value")).alias("value"),
        (seq % 3 == 0).alias("skipped"),
    )
    filled = changes.fill_minimal(minimal, ["pk"], "seq", "value", "skipped")
    return filled.select("seq", "pk", "value_filled")


_CUBE = """, c AS (SELECT 't' || CAST(pk % 3 AS VARCHAR) AS tbl, op, CAST(hour(ts) AS BIGINT) AS hr FROM change_log)
SELECT tbl, op, hr, count(*) AS n FROM c GROUP BY """


def _facts(spark, sf):
    return v.change_log(spark, sf).select(
        F.concat(F.lit("t"), (F.col("pk") % 3).cast("string")).alias("tbl"),
        "op",
        F.hour("ts").cast("bigint").alias("hr"),
    )


@query("change_cube", with_views("change_log", _CUBE + "CUBE (tbl, op, hr)"))
def change_cube(spark, sf):
    return changes.change_cube(_facts(spark, sf), ["tbl", "op", "hr"])


@query("change_rollup", with_views("change_log", _CUBE + "ROLLUP (tbl, op, hr)"))
def change_rollup(spark, sf):
    return changes.change_rollup(_facts(spark, sf), ["tbl", "op", "hr"])


@query(
    "schema_drift",
    with_views(
        "map_events",
        """, m AS (SELECT event_id, table_id, 'v' || CAST(version % 4 AS VARCHAR) || CASE WHEN table_id = 1 THEN '+c' ELSE '' END AS signature
                   FROM map_events WHERE event_type = 19),
        l AS (SELECT *, lag(signature) OVER (PARTITION BY table_id ORDER BY event_id) AS prev_signature FROM m)
        SELECT event_id, table_id, signature, prev_signature FROM l WHERE signature <> prev_signature""",
    ),
)
def schema_drift(spark, sf):
    maps = v.map_events(spark, sf).filter(F.col("event_type") == 19).select(
        "event_id", "table_id", "version"
    )
    signature = F.concat(
        F.lit("v"),
        (F.col("version") % 4).cast("string"),
        F.when(F.col("table_id") == 1, "+c").otherwise(""),
    )
    return changes.schema_drift(maps, ["table_id"], "event_id", signature).drop("version")


# -- table-map binding --------------------------------------------------------

_BIND = """, e AS (SELECT *, coalesce(sum(CASE WHEN stmt_end AND event_type = 30 THEN 1 ELSE 0 END) OVER (
               PARTITION BY file_no ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS epoch FROM map_events),
b AS (SELECT *, last_value(CASE WHEN event_type = 19 THEN event_id END IGNORE NULLS) OVER (
               PARTITION BY file_no, epoch, table_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS map_id FROM e)
"""


def _bound(spark, sf):
    log = v.map_events(spark, sf)
    return rows.bind_table_maps(
        log,
        ["file_no"],
        "event_id",
        is_map=F.col("event_type") == 19,
        ends_statement=(F.col("event_type") == 30) & F.col("stmt_end"),
        payload="event_id",
    ).filter(F.col("event_type") == 30)


@query(
    "asof_table_map",
    with_views(
        "map_events",
        _BIND + "SELECT event_id, file_no, table_id, map_id FROM b WHERE event_type = 30 AND map_id IS NOT NULL",
    ),
)
def asof_table_map(spark, sf):
    bound = _bound(spark, sf).filter(F.col("table_map").isNotNull())
    return bound.select("event_id", "file_no", "table_id", F.col("table_map").alias("map_id"))


@query(
    "orphan_row_events",
    with_views(
        "map_events",
        _BIND + "SELECT event_id, file_no, table_id FROM b WHERE event_type = 30 AND map_id IS NULL",
    ),
)
def orphan_row_events(spark, sf):
    return rows.orphans(_bound(spark, sf)).select("event_id", "file_no", "table_id")


# -- positions ----------------------------------------------------------------


@query(
    "order_by_position",
    with_views(
        "log_positions",
        """SELECT event_id, file, pos, CAST(split_part(file, '.', 2) AS BIGINT) AS file_seq,
                  lead(event_id) OVER (ORDER BY split_part(file, '.', 1), CAST(split_part(file, '.', 2) AS BIGINT), pos) AS next_event
           FROM log_positions""",
    ),
)
def order_by_position(spark, sf):
    # The successor in log order proves the order without relying on output order.
    located = position.with_position(v.log_positions(spark, sf), "file", "pos")
    chained = ordered_scan(
        located,
        ["file_base"],
        ["file_seq", "pos"],
        [F.col("file_seq"), F.floor(F.col("pos") / (1 << 26))],
        next_event=following("event_id"),
    )
    ordered = position.order_by_position(chained, "file", "pos")
    return ordered.select("event_id", "file", "pos", "file_seq", "next_event")


@query(
    "position_compare",
    with_views(
        "log_positions",
        """, t AS (SELECT event_id, file, pos,
              CASE event_id % 6 WHEN 0 THEN 'mysql-bin.999999' WHEN 1 THEN 'mysql-bin.1000000' WHEN 2 THEN ''
                   WHEN 3 THEN 'zlog.1' WHEN 4 THEN 'plain' ELSE 'mysql-bin.x' END AS other FROM log_positions)
        SELECT event_id, CASE event_id % 6
            WHEN 2 THEN 1 WHEN 3 THEN -1 WHEN 4 THEN -1 WHEN 5 THEN NULL
            WHEN 0 THEN CASE WHEN CAST(split_part(file, '.', 2) AS BIGINT) <> 999999 THEN sign(CAST(split_part(file, '.', 2) AS BIGINT) - 999999) ELSE sign(pos - 260) END
            ELSE CASE WHEN CAST(split_part(file, '.', 2) AS BIGINT) <> 1000000 THEN sign(CAST(split_part(file, '.', 2) AS BIGINT) - 1000000) ELSE sign(pos - 260) END
          END AS cmp FROM t""",
    ),
)
def position_compare(spark, sf):
    kind = F.col("event_id") % 6
    other = (
        F.when(kind == 0, "mysql-bin.999999")
        .when(kind == 1, "mysql-bin.1000000")
        .when(kind == 2, "")
        .when(kind == 3, "zlog.1")
        .when(kind == 4, "plain")
        .otherwise("mysql-bin.x")
    )
    cmp = position.position_compare(
        position.position(F.col("file"), F.col("pos")), position.position(other, F.lit(260))
    )
    return v.log_positions(spark, sf).select("event_id", cmp.alias("cmp"))


@query(
    "next_position",
    with_views(
        "log_positions",
        """, l AS (SELECT event_id, file, CASE WHEN event_id % 10 = 0 THEN 0 ELSE pos + 64 END AS log_pos,
             CASE WHEN event_id % 100 = 99 THEN 'mysql-bin.' || CAST(999996 + CAST(floor(event_id / 100) AS BIGINT) AS VARCHAR) END AS rotate_file
             FROM log_positions)
        SELECT event_id,
          last_value(CASE WHEN rotate_file IS NOT NULL THEN rotate_file WHEN log_pos > 0 THEN file END IGNORE NULLS) OVER w AS next_file,
          last_value(CASE WHEN rotate_file IS NOT NULL THEN 4 WHEN log_pos > 0 THEN log_pos END IGNORE NULLS) OVER w AS next_pos
        FROM l WINDOW w AS (ORDER BY event_id ROWS UNBOUNDED PRECEDING)""",
    ),
)
def next_position(spark, sf):
    eid = F.col("event_id")
    successor = F.concat(F.lit("mysql-bin."), (F.lit(999996) + v.div("event_id", 100)).cast("string"))
    rotates = eid % 100 == 99
    log = v.log_positions(spark, sf).select(
        "event_id",
        F.lit("server-1").alias("source"),
        "file",
        F.when(eid % 10 == 0, 0).otherwise(F.col("pos") + 64).cast("bigint").alias("log_pos"),
        F.when(rotates, successor).alias("rotate_file"),
        F.when(rotates, F.lit(4)).cast("bigint").alias("rotate_pos"),
    )
    return transactions.next_position(log, ["source"], "event_id").select(
        "event_id", "next_file", "next_pos"
    )


@query(
    "log_union",
    with_views(
        "log_positions",
        """SELECT 'a' AS source, event_id, file, pos FROM log_positions
           UNION ALL SELECT 'b', event_id, replace(file, 'mysql', 'other'), pos + 8 FROM log_positions""",
    ),
)
def log_union(spark, sf):
    a = v.log_positions(spark, sf)
    b = a.withColumns({"file": F.replace("file", F.lit("mysql"), F.lit("other")), "pos": F.col("pos") + 8})
    both = rows.union_logs(a=a, b=b)
    return position.order_by_position(both, "file", "pos")


# -- transactions -------------------------------------------------------------

_TX = """, t AS (SELECT *, last_value(gno IGNORE NULLS) OVER w AS tx_id,
               CAST(sum(CASE WHEN kind = 'GTID' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS tx_ordinal
        FROM tx_events WINDOW w AS (PARTITION BY file_no ORDER BY event_id ROWS UNBOUNDED PRECEDING))
"""


def _assigned(spark, sf):
    kind = F.col("kind")
    return transactions.assign_transactions(
        v.tx_events(spark, sf), ["file_no"], "event_id", kind == "GTID", kind == "XID", "gno"
    )


@query("tx_assign", with_views("tx_events", _TX + "SELECT event_id, file_no, kind, tx_id, tx_ordinal FROM t"))
def tx_assign(spark, sf):
    return _assigned(spark, sf).select("event_id", "file_no", "kind", "tx_id", "tx_ordinal")


_ROLLUP = """SELECT file_no, tx_id, count(*) AS events, count(*) FILTER (WHERE kind = 'ROWS') AS row_events,
CAST(sum(event_size) AS BIGINT) AS bytes, min(event_id) AS first_pos, max(event_id) AS last_pos FROM t GROUP BY file_no, tx_id"""


def _rolled(spark, sf):
    return transactions.tx_rollup(
        _assigned(spark, sf), ["file_no"], "event_id", F.col("kind") == "ROWS"
    )


@query("tx_rollup", with_views("tx_events", _TX + _ROLLUP))
def tx_rollup(spark, sf):
    return _rolled(spark, sf)


@query(
    "topk_transactions",
    with_views("tx_events", _TX + _ROLLUP + " ORDER BY bytes DESC, file_no, tx_id LIMIT 20"),
)
def topk_transactions(spark, sf):
    return transactions.top_transactions(_rolled(spark, sf), 20, "file_no", "tx_id")


@query(
    "commit_lag",
    """, g AS (SELECT event_id, CASE WHEN event_id % 19 = 0 THEN 0 ELSE epoch_us(ts) END AS immediate_commit_us,
           CASE WHEN event_id % 17 = 0 THEN 0 ELSE epoch_us(ts) - (user_id % 100) * 1000 END AS original_commit_us FROM events)
    SELECT event_id, nullif(immediate_commit_us, 0) - nullif(original_commit_us, 0) AS lag_us FROM g""".replace(
        ", g AS", "WITH g AS", 1
    ),
)
def commit_lag(spark, sf):
    us, eid = F.unix_micros(F.col("ts").cast("timestamp")), F.col("event_id")
    gtids = table(spark, sf, "events").select(
        "event_id",
        F.when(eid % 19 == 0, 0).otherwise(us).alias("immediate_commit_us"),
        F.when(eid % 17 == 0, 0)
        .otherwise(us - (F.col("user_id") % 100) * 1000)
        .alias("original_commit_us"),
    )
    return transactions.commit_lag(gtids).select("event_id", "lag_us")


# -- filters and validity -----------------------------------------------------


@query(
    "filter_start_time",
    """SELECT event_id, event_type FROM events
       WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-15 06:00:00'""",
)
def filter_start_time(spark, sf):
    return quality.since(table(spark, sf, "events"), "2024-01-15 06:00:00").select(
        "event_id", "event_type"
    )


_TYPED = """(SELECT event_id, user_id, 16 + event_id % 20 AS event_type, event_id % 1024 AS flags FROM events)"""


def _typed(spark, sf):
    eid = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id", "user_id", (16 + eid % 20).alias("event_type"), (eid % 1024).alias("flags")
    )


@query("filter_event_type", f"SELECT * FROM {_TYPED} WHERE event_type IN (19, 30, 31, 32)")
def filter_event_type(spark, sf):
    return quality.of_type(_typed(spark, sf), 19, 30, 31, 32)


@query(
    "filter_flags",
    f"SELECT event_id, flags FROM {_TYPED} WHERE (flags & 32) <> 0 AND (flags & 128) = 0",
)
def filter_flags(spark, sf):
    artificial = quality.has_flag(_typed(spark, sf), quality.ARTIFICIAL)
    return artificial.filter(~quality.flag(quality.IGNORABLE)).select("event_id", "flags")


@query(
    "mariadb_flags",
    """SELECT event_id, event_id % 64 AS flags, (event_id % 64) & 32 <> 0 AS is_ddl, (event_id % 64) & 1 <> 0 AS is_standalone,
       (event_id % 64) & 2 <> 0 AS is_group_commit FROM events""",
)
def mariadb_flags(spark, sf):
    flags = table(spark, sf, "events").select("event_id", (F.col("event_id") % 64).alias("flags"))
    return quality.mariadb_flags(flags)


_FRAMES = """(SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 12 ELSE 19 + length(props) END AS event_size,
 CASE WHEN event_id % 89 = 0 THEN 18 + length(props) ELSE 19 + length(props) END AS raw_length FROM events)"""
_VALID = f"""SELECT event_id, CASE WHEN event_size < 19 THEN 'event size below header size' WHEN raw_length < 19 THEN 'event shorter than its header'
 WHEN raw_length <> event_size THEN 'event length differs from its size' END AS error FROM {_FRAMES}"""


def _validated(spark, sf):
    size, eid = 19 + F.length("props"), F.col("event_id")
    frames = table(spark, sf, "events").select(
        "event_id",
        F.when(eid % 97 == 0, 12).otherwise(size).alias("event_size"),
        F.when(eid % 89 == 0, size - 1).otherwise(size).alias("raw_length"),
    )
    return quality.validate(frames)


@query(
    "validity_check",
    f"""SELECT coalesce(error, 'valid') AS verdict, count(*) AS n FROM ({_VALID}) GROUP BY 1""",
)
def validity_check(spark, sf):
    verdict = F.coalesce("error", F.lit("valid")).alias("verdict")
    return _validated(spark, sf).groupBy(verdict).agg(F.count("*").alias("n"))


@query("quarantine_bad_events", f"SELECT event_id, error FROM ({_VALID}) WHERE error IS NOT NULL")
def quarantine(spark, sf):
    _, bad = quality.split_quarantine(_validated(spark, sf))
    return bad.select("event_id", "error")
