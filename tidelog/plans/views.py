"""Views that give the driver tables the shape of a change log.

Each view exists twice: a DataFrame for the engine and a CTE for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.scan import by_width, ordered_scan, row_index
from tidelog.session import settle, table

CTE: dict[str, str] = {}


def with_views(names: str, body: str) -> str:
    """Oracle text: ``body`` preceded by the named CTEs (in dependency order)."""
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in names.split()) + "\n" + body.lstrip()


def div(col: str | Column, n: int) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.floor(col / F.lit(n)).cast("bigint")


CTE["change_log"] = """
SELECT event_id AS seq, user_id AS pk, ts,
       CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'I' ELSE 'U' END AS op,
       value, props
FROM events"""


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("pk"),
        "ts",
        F.when(kind == "error", "D").when(kind == "signup", "I").otherwise("U").alias("op"),
        "value",
        "props",
    )


CTE["log_positions"] = """
SELECT event_id, 'mysql-bin.' || CAST(999995 + CAST(floor(event_id / 100) AS BIGINT) AS VARCHAR) AS file,
       4 + (event_id % 100) * 64 AS pos
FROM events"""


def log_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.lit(999995) + div("event_id", 100)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("mysql-bin."), seq.cast("string")).alias("file"),
        (4 + (F.col("event_id") % 100) * 64).alias("pos"),
    )


CTE["gtids_all"] = """
SELECT event_id, sid, row_number() OVER (PARTITION BY sid ORDER BY event_id) AS gno
FROM (SELECT event_id,
             substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' ||
             substr(h, 17, 4) || '-' || substr(h, 21, 12) AS sid
      FROM (SELECT event_id, md5(CAST(user_id % 4 AS VARCHAR)) AS h FROM events))"""
CTE["gtids_mysql"] = "SELECT * FROM gtids_all WHERE gno % 11 <> 0"
CTE["gtids_mysql_b"] = "SELECT * FROM gtids_all WHERE gno % 7 <> 0"
# Sets cut from the log, one per thousand events; their relation depends on the set.
CTE["chunk_a"] = """
SELECT CAST(floor(event_id / 1000) AS BIGINT) AS set_id, sid, gno FROM gtids_mysql
WHERE NOT (CAST(floor(event_id / 1000) AS BIGINT) % 3 = 1 AND gno % 5 = 0)"""
CTE["chunk_b"] = """
SELECT CAST(floor(event_id / 1000) AS BIGINT) AS set_id, sid, gno FROM gtids_mysql
WHERE NOT (CAST(floor(event_id / 1000) AS BIGINT) % 3 = 2 AND gno % 5 = 0)"""


def hex_uuid(h: Column) -> Column:
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(h, i, n) for i, n in cuts])


def gtids_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    sid = hex_uuid(F.md5((F.col("user_id") % 4).cast("string")))
    marked = table(spark, sf_dir, "events").select("event_id", sid.alias("sid"))
    numbered = ordered_scan(marked, ["sid"], ["event_id"], by_width("event_id"), gno=row_index())
    return settle(numbered, "gtids")


def gtids_mysql(gtids: DataFrame) -> DataFrame:
    return gtids.filter(F.col("gno") % 11 != 0)


def gtids_mysql_b(gtids: DataFrame) -> DataFrame:
    return gtids.filter(F.col("gno") % 7 != 0)


def _chunk(gtids: DataFrame, thinned: int) -> DataFrame:
    set_id = div("event_id", 1000)
    return (
        gtids_mysql(gtids)
        .filter(~((set_id % 3 == thinned) & (F.col("gno") % 5 == 0)))
        .select(set_id.alias("set_id"), "sid", "gno")
    )


def chunk_a(gtids: DataFrame) -> DataFrame:
    return _chunk(gtids, 1)


def chunk_b(gtids: DataFrame) -> DataFrame:
    return _chunk(gtids, 2)


CTE["gtids_mariadb"] = """
SELECT event_id, user_id % 3 AS domain_id, user_id % 5 AS server_id,
       CASE WHEN event_id % 13 = 0 THEN event_id - 5 ELSE event_id END AS seq
FROM events"""


def gtids_mariadb(spark: SparkSession, sf_dir: str) -> DataFrame:
    eid = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id") % 3).alias("domain_id"),
        (F.col("user_id") % 5).alias("server_id"),
        F.when(eid % 13 == 0, eid - 5).otherwise(eid).alias("seq"),
    )


CTE["tx_events"] = """
SELECT event_id, CAST(floor(event_id / 500) AS BIGINT) AS file_no,
       CASE event_id % 5 WHEN 0 THEN 'GTID' WHEN 4 THEN 'XID' ELSE 'ROWS' END AS kind,
       CASE WHEN event_id % 5 = 0 THEN CAST(floor(event_id / 5) AS BIGINT) END AS gno,
       19 + length(props) AS event_size
FROM events"""


def tx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    eid = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        div("event_id", 500).alias("file_no"),
        F.when(eid % 5 == 0, "GTID").when(eid % 5 == 4, "XID").otherwise("ROWS").alias("kind"),
        F.when(eid % 5 == 0, div("event_id", 5)).alias("gno"),
        (19 + F.length("props")).cast("bigint").alias("event_size"),
    )


CTE["map_events"] = """
SELECT event_id, CAST(floor(event_id / 500) AS BIGINT) AS file_no,
       CASE WHEN event_id % 4 = 0 THEN 19 ELSE 30 END AS event_type,
       event_id % 8 = 7 AS stmt_end,
       CASE WHEN event_id % 4 = 0 THEN CAST(floor(event_id / 4) AS BIGINT) % 3
            ELSE event_id % 3 END AS table_id,
       CAST(floor(event_id / 1000) AS BIGINT) AS version
FROM events"""


def map_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    eid = F.col("event_id")
    is_map = eid % 4 == 0
    return table(spark, sf_dir, "events").select(
        "event_id",
        div("event_id", 500).alias("file_no"),
        F.when(is_map, 19).otherwise(30).alias("event_type"),
        (eid % 8 == 7).alias("stmt_end"),
        F.when(is_map, div("event_id", 4) % 3).otherwise(eid % 3).alias("table_id"),
        div("event_id", 1000).alias("version"),
    )
