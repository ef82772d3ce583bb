"""Queries over the fixture archive: scan, framing, table maps, row images, sinks."""

from __future__ import annotations

import zlib

import pandas as pd
import zstandard
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import columns as ct
from tidelog.functions.binary import to_le
from tidelog.operators import catalog, events, images
from tidelog.plans import archive as ar
from tidelog.plans import encode as enc
from tidelog.plans.archive import archive
from tidelog.plans.decode_queries import _log, eid
from tidelog.plans.registry import query
from tidelog.session import table
from tidelog.sources import binlog, compressed, sinks

ORDERS_SPEC = [
    images.ColumnSpec("o_orderkey", 0, ct.LONGLONG),
    images.ColumnSpec("o_custkey", 1, ct.LONG, unsigned=True),
    images.ColumnSpec("o_orderstatus", 2, ct.STRING, 247 * 256 + 1),
    images.ColumnSpec("o_totalprice", 3, ct.NEWDECIMAL, 12 * 256 + 2),
    images.ColumnSpec("o_orderdate", 4, ct.DATETIME2, 0),
    images.ColumnSpec("o_orderpriority", 5, ct.VARCHAR, 60),
    images.ColumnSpec("o_attrs", 6, ct.JSON, 4),
]


def _changes(log):
    return images.typed_changes(images.row_changes(log), "shop", "orders", ORDERS_SPEC)


def _row_events(spark, sf):
    """Row events only; the reader has bound them to their table maps."""
    return binlog.read_binlog(spark, archive(spark, sf), event_types=events.ROWS)


def _orders_out(side: str = "after"):
    c = F.col(side)
    return [
        c["o_orderkey"].alias("o_orderkey"),
        c["o_custkey"].alias("o_custkey"),
        F.element_at(F.array(F.lit("F"), F.lit("O"), F.lit("P")), c["o_orderstatus"].cast("int")).alias("o_orderstatus"),
        c["o_totalprice"].cast("string").alias("o_totalprice"),
        c["o_orderdate"].alias("o_orderdate"),
        c["o_orderpriority"].alias("o_orderpriority"),
        F.get_json_object(c["o_attrs"], "$.k").cast("bigint").alias("k"),
    ]


_ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority, o_custkey % 1000 AS k FROM orders"""


@query("scan_binlog_archive", _ORDERS)
def scan_binlog_archive(spark, sf):
    changes = _changes(_row_events(spark, sf))
    return changes.filter(F.col("op") == "I").select(*_orders_out())


_FILES = "(SELECT CAST(floor(o_orderkey / 2000) AS BIGINT) AS file_no, count(*) AS n FROM orders GROUP BY 1)"


def _type_counts(edges: str) -> str:
    return f"""WITH f AS (SELECT count(*) AS files FROM {_FILES}), g AS (SELECT count(DISTINCT CAST(floor(o_orderkey / 10) AS BIGINT)) AS g,
      count(*) FILTER (WHERE o_orderkey % 10 = 1) AS u, count(*) FILTER (WHERE o_orderkey % 10 = 2) AS d FROM orders)
    SELECT event_type, n FROM (
      {edges} UNION ALL
      SELECT 33 AS event_type, g AS n FROM g UNION ALL SELECT 2, g FROM g UNION ALL SELECT 19, g + u + d FROM g UNION ALL SELECT 30, g FROM g
      UNION ALL SELECT 31, u FROM g UNION ALL SELECT 32, d FROM g UNION ALL SELECT 16, g FROM g) WHERE n > 0"""


_EDGES = "SELECT 15 AS event_type, files AS n FROM f UNION ALL SELECT 4, files FROM f"
_ALL_EDGES = _EDGES + " UNION ALL SELECT 35, files FROM f UNION ALL SELECT 14, files FROM f UNION ALL SELECT 50, files FROM f"


@query("scan_from_offset", _type_counts(_EDGES))
def scan_from_offset(spark, sf):
    # The first four events of a file have the same sizes everywhere.
    sizes = [len(ar.format_body()), 8 + 16 + 8 + 16, 8, 2]
    first_tx = 4 + sum(s + 23 for s in sizes)
    log = binlog.read_binlog(spark, archive(spark, sf), start_pos=first_tx)
    return log.groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "scan_raw_mode",
    f"SELECT event_type, event_type IN (4, 15) AS typed, n FROM ({_type_counts(_ALL_EDGES)})",
)
def scan_raw_mode(spark, sf):
    log = binlog.raw_mode(binlog.read_binlog(spark, archive(spark, sf), headers_only=True))
    return log.groupBy("event_type", "typed").agg(F.count("*").alias("n"))


@query(
    "scan_generic_events",
    f"SELECT t.event_type, t.body, count(*) AS n FROM {_FILES}, (VALUES (14, '0300000061626301'), (50, 'CAFE')) t(event_type, body) GROUP BY ALL",
)
def scan_generic_events(spark, sf):
    opaque = events.generic_events(binlog.read_binlog(spark, archive(spark, sf)))
    return opaque.groupBy("event_type", F.hex("body").alias("body")).agg(F.count("*").alias("n"))


@query(
    "archive_checksums",
    f"SELECT true AS checksum_ok, CAST(sum(n) AS BIGINT) AS n FROM ({_type_counts(_ALL_EDGES)})",
)
def archive_checksums(spark, sf):
    log = events.verify_checksum(binlog.read_binlog(spark, archive(spark, sf)))
    return log.groupBy("checksum_ok").agg(F.count("*").alias("n"))


@query(
    "archive_previous_gtids",
    f"SELECT '{ar.SID}' AS sid, 1 AS start, file_no * 200 + 1 AS stop FROM {_FILES}",
)
def archive_previous_gtids(spark, sf):
    log = binlog.read_binlog(spark, archive(spark, sf))
    return events.events(log, "previous_gtids").select("sid", "start", "stop")


@query(
    "evt_table_map",
    """WITH g AS (SELECT count(DISTINCT CAST(floor(o_orderkey / 10) AS BIGINT)) + count(*) FILTER (WHERE o_orderkey % 10 IN (1, 2)) AS n FROM orders)
    SELECT t.*, g.n FROM g, (VALUES (0, 'o_orderkey', 8, 0, false, false, NULL, 0), (1, 'o_custkey', 3, 0, true, false, NULL, NULL),
      (2, 'o_orderstatus', 254, 63233, NULL, false, 'F,O,P', NULL), (3, 'o_totalprice', 246, 3074, false, true, NULL, NULL),
      (4, 'o_orderdate', 18, 0, NULL, true, NULL, NULL), (5, 'o_orderpriority', 15, 60, NULL, true, NULL, NULL),
      (6, 'o_attrs', 245, 4, NULL, true, NULL, NULL)) t(ordinal, name, type, meta, unsigned, nullable, labels, pk_ord)""",
)
def evt_table_map(spark, sf):
    maps = images.table_maps(binlog.read_binlog(spark, archive(spark, sf), event_types=[19]))
    columns = catalog.column_catalog(maps, [*events.LOG_KEY, "schema_name", "table_name"])
    shown = F.when(F.col("labels").isNotNull(), F.array_join("labels", ",")).alias("labels")
    keys = ["ordinal", "name", "type", "meta", "unsigned", "nullable", shown, "pk_ord"]
    return columns.groupBy(*keys).agg(F.count("*").alias("n"))


@query(
    "row_images",
    """SELECT o_orderkey AS o_orderkey, 'WriteAI' AS kind, CAST(o_totalprice AS DECIMAL(12,2))::VARCHAR AS price, 0 AS n_skipped, o_orderkey % 10 AS image_idx FROM orders
       UNION ALL SELECT o_orderkey, 'UpdateBI', NULL, 6, 0 FROM orders WHERE o_orderkey % 10 = 1
       UNION ALL SELECT NULL, 'UpdateAI', CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 1 AS DECIMAL(12,2))::VARCHAR, 5, 1 FROM orders WHERE o_orderkey % 10 = 1
       UNION ALL SELECT o_orderkey, 'DeleteBI', CAST(o_totalprice AS DECIMAL(12,2))::VARCHAR, 0, 0 FROM orders WHERE o_orderkey % 10 = 2""",
)
def row_images(spark, sf):
    found = images.row_images(_row_events(spark, sf))
    cell = lambda i: images.cell_value(F.col("cells")[i], ORDERS_SPEC[i])
    return found.select(
        cell(0).alias("o_orderkey"),
        "kind",
        cell(3).cast("string").alias("price"),
        F.size("skipped").alias("n_skipped"),
        "image_idx",
    )


@query(
    "row_changes",
    """SELECT 'I' AS op, o_orderkey AS key_before_or_after, '' AS skipped, count(*) AS n FROM orders GROUP BY o_orderkey
       UNION ALL SELECT 'U', o_orderkey, '0,1,4,5,6', 1 FROM orders WHERE o_orderkey % 10 = 1
       UNION ALL SELECT 'D', o_orderkey, NULL, 1 FROM orders WHERE o_orderkey % 10 = 2""",
)
def row_changes(spark, sf):
    changes = _changes(_row_events(spark, sf))
    key = F.coalesce(F.col("before.o_orderkey"), F.col("after.o_orderkey"))
    skipped = F.when(F.col("op") != "D", F.array_join("skipped_after", ","))
    return changes.groupBy("op", key.alias("key_before_or_after"), skipped.alias("skipped")).agg(F.count("*").alias("n"))


@query(
    "rows_header_only",
    """SELECT 30 AS event_type, 108 AS table_id, 1 AS row_flags, true AS stmt_end, 7 AS n_cols, count(DISTINCT CAST(floor(o_orderkey / 10) AS BIGINT)) AS n FROM orders
       UNION ALL SELECT 31, 108, 1, true, 7, count(*) FROM orders WHERE o_orderkey % 10 = 1
       UNION ALL SELECT 32, 108, 1, true, 7, count(*) FROM orders WHERE o_orderkey % 10 = 2""",
)
def rows_header_only(spark, sf):
    heads = images.row_images(_row_events(spark, sf), header_only=True)
    return heads.groupBy("event_type", "table_id", "row_flags", "stmt_end", "n_cols").agg(F.count("*").alias("n"))


@query(
    "archive_replay",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 1 THEN 'P' ELSE o_orderstatus END AS o_orderstatus,
        CAST(CAST(CAST(o_totalprice AS DECIMAL(12,2)) + CASE WHEN o_orderkey % 10 = 1 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS VARCHAR) AS o_totalprice,
        o_orderpriority FROM orders WHERE o_orderkey % 10 <> 2""",
)
def archive_replay(spark, sf):
    """Files to current table state; minimal images only overwrite what they carry."""
    changes = _changes(_row_events(spark, sf))
    at = F.struct("file_base", "file_seq", "start_pos", "change_no")
    names = ["o_orderstatus", "o_totalprice", "o_orderpriority"]
    ordinal = {s.name: s.ordinal for s in ORDERS_SPEC}
    written = {
        n: (F.col("op") != "D") & ~F.array_contains("skipped_after", ordinal[n]) for n in names
    }
    rows = changes.select(
        F.coalesce(F.col("before.o_orderkey"), F.col("after.o_orderkey")).alias("o_orderkey"),
        "op",
        at.alias("at"),
        *[F.col("after")[n].alias(n) for n in names],
        *[written[n].alias(f"w_{n}") for n in names],
    )
    state = rows.groupBy("o_orderkey").agg(
        F.max_by("op", "at").alias("op"),
        *[
            F.max_by(F.struct(F.col(n).alias("v")), F.when(F.col(f"w_{n}"), F.col("at"))).alias(n)
            for n in names
        ],
    )
    label = F.element_at(F.array(F.lit("F"), F.lit("O"), F.lit("P")), F.col("o_orderstatus.v").cast("int"))
    return state.filter(F.col("op") != "D").select(
        "o_orderkey",
        label.alias("o_orderstatus"),
        F.col("o_totalprice.v").cast("string").alias("o_totalprice"),
        F.col("o_orderpriority.v").alias("o_orderpriority"),
    )


# -- compressed events -------------------------------------------------------------


def _zstd_batch(plain: pd.Series) -> pd.Series:
    squeeze = zstandard.ZstdCompressor()
    return plain.map(lambda b: squeeze.compress(bytes(b)))


def _deflate_batch(plain: pd.Series) -> pd.Series:
    # Algorithm byte: one length byte follows; its value is not needed to inflate.
    return plain.map(lambda b: b"\x01\x00" + zlib.compress(bytes(b)))


# Catalyst takes a Python function for cheap and writes it, with all it is computed from, into each
# place that reads its result. Marked as not repeatable it stays one column.
_zstd = F.pandas_udf(_zstd_batch, T.BinaryType()).asNondeterministic()
_deflate = F.pandas_udf(_deflate_batch, T.BinaryType()).asNondeterministic()


def _as_log(df, event_type, body):
    """Rows to a log of one event type, keyed by the group number."""
    return df.select(
        F.lit("srv1").alias("source"), F.lit("mem.000001").alias("file"), F.lit("mem").alias("file_base"),
        F.lit(1).cast("bigint").alias("file_seq"), F.col("g").alias("start_pos"), F.lit(0).alias("inner_idx"),
        F.timestamp_seconds(F.lit(ar.T0)).alias("ts"), F.lit(event_type).alias("event_type"),
        F.lit(1).cast("bigint").alias("server_id"), F.lit(0).cast("bigint").alias("event_size"),
        F.lit(0).cast("bigint").alias("log_pos"), F.lit(0).alias("flags"), F.lit(0).alias("checksum_alg"),
        F.lit(6).alias("table_id_size"), ar.const(ar.orders_map()).alias("table_map"),
        F.lit(None).cast("string").alias("error"), body.alias("body"), enc.raw("").alias("raw"),
    )


@query("expand_tx_payload", _ORDERS)
def expand_tx_payload(spark, sf):
    groups = ar.order_groups(spark, sf)
    zero = F.lit(0)
    inner = [
        (33, F.concat(enc.raw("01"), enc.uuid_bytes(F.lit(ar.SID)), to_le(F.col("g") + 1, 8))),
        (19, ar.const(ar.orders_map())),
        (30, ar.write_rows(F.col("inserts"))),
        (16, to_le(F.col("g"), 8)),
    ]
    plain = F.concat(
        *[enc.frame(F.lit(t), b, F.lit(ar.T0), F.lit(1), zero, zero, checksum=False) for t, b in inner]
    )
    packed = groups.select("g", _zstd(plain).alias("z"), F.length(plain).alias("n"))
    head = F.concat(
        enc.raw("0201" + "00" + "0104"), to_le(F.length("z"), 4), enc.raw("0304"), to_le(F.col("n"), 4), enc.raw("00")
    )
    log = _as_log(packed, 40, F.concat(head, F.col("z")))
    changes = _changes(compressed.expand_payloads(log))
    return changes.filter(F.col("op") == "I").select(*_orders_out())


@query(
    "inflate_mariadb",
    _ORDERS.replace("FROM orders", ", 'INSERT ' || CAST(o_orderkey - o_orderkey % 10 AS VARCHAR) AS query FROM orders"),
)
def inflate_mariadb(spark, sf):
    groups = ar.order_groups(spark, sf)
    rows = groups.select("g", _deflate(F.col("inserts")).alias("z"))
    row_log = _as_log(rows, 166, ar.rows_body(1, 1, "7F", F.col("z")))
    sql = enc.utf8(F.concat(F.lit("INSERT "), (F.col("g") * 10).cast("string")))
    texts = groups.select("g", _deflate(sql).alias("z"))
    head = enc.raw("0000000000000000" + "04" + "0000" + "0300" + "010203" + b"shop".hex() + "00")
    query_log = _as_log(texts, 165, F.concat(head, F.col("z")))
    log = compressed.inflate_bodies(row_log.unionByName(query_log))
    queries = events.events(log, "query_events").select("start_pos", "query")
    changes = _changes(log).select("start_pos", *_orders_out())
    return changes.join(queries, "start_pos").drop("start_pos")


# -- sinks ---------------------------------------------------------------------------


@query(
    "dump_text",
    """SELECT event_id, '=== XIDEvent ===' || chr(10) || 'Date: ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || chr(10) || 'Log position: ' || CAST(4 + event_id * 64 + 31 AS VARCHAR) || chr(10)
        || 'Event size: 31' || chr(10) || chr(10) || 'XID: ' || CAST(event_id AS VARCHAR) || chr(10) || chr(10) AS text FROM events
       UNION ALL SELECT event_id, '=== IntVarEvent ===' || chr(10) || 'Date: ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || chr(10) || 'Log position: ' || CAST(4 + event_id * 64 + 32 AS VARCHAR) || chr(10)
        || 'Event size: 32' || chr(10) || chr(10) || 'Type: 2' || chr(10) || 'Value: ' || CAST(user_id AS VARCHAR) || chr(10) || chr(10) FROM events
       UNION ALL SELECT event_id, '=== UserVarEvent ===' || chr(10) || 'Date: ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || chr(10) || 'Log position: ' || CAST(4 + event_id * 64 + 25 AS VARCHAR) || chr(10)
        || 'Event size: 25' || chr(10) || chr(10) || 'Body: CAFE' || chr(10) || chr(10) FROM events""",
)
def dump_text(spark, sf):
    xid = _log(spark, sf, 16, to_le(eid(), 8))
    intvar = _log(spark, sf, 5, F.concat(enc.raw("02"), to_le(F.col("user_id"), 8)))
    opaque = _log(spark, sf, 14, enc.raw("CAFE"))
    return sinks.dump_text(xid.unionByName(intvar).unionByName(opaque)).select("event_id", "text")


@query(
    "json_decode",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS s, (event_id % 3 = 0) AS b, event_id * 100003 AS n FROM events""",
)
def json_decode(spark, sf):
    # {"b": true/false, "k": int16, "n": int64, "s": string} as a binary document.
    k = F.get_json_object("props", "$.k").cast("bigint")
    s = F.concat(to_le(F.length("event_type"), 1), enc.utf8(F.col("event_type")))
    # 4 keys: 4 + 4*4 key entries + 4*3 value entries = 32, then names, then values.
    doc = F.concat(
        enc.raw("00" + "0400"), to_le(F.length(s) + 32 + 4 + 8, 2),
        *[enc.raw(f"{32 + i:02x}00" + "0100") for i in range(4)],
        enc.raw("04"), to_le(F.when(eid() % 3 == 0, 1).otherwise(2), 2),
        enc.raw("05"), to_le(k, 2),
        enc.raw("09" + "2400"), enc.raw("0C" + "2C00"),
        enc.raw(b"bkns".hex()), to_le(eid() * 100003, 8), s,
    )
    image = F.concat(enc.raw("00"), to_le(F.length(doc), 2), doc)
    docs = table(spark, sf, "events").select(eid().alias("g"), image.alias("image"))
    one_json = b"\x01" + bytes(7) + b"\x01d\0\x01t\0\x01\xf5\x01\x02\x01"
    body = F.concat(enc.raw("01" + "00" * 5 + "0100" + "0200" + "01" + "01"), F.col("image"))
    log = _as_log(docs, 30, body).withColumn("table_map", ar.const(one_json))
    spec = [images.ColumnSpec("doc", 0, ct.JSON, 2)]
    typed = images.typed_changes(images.row_changes(log), "d", "t", spec)
    fields = F.from_json(F.col("after.doc"), "b boolean, k bigint, n bigint, s string").alias("j")
    return typed.select(F.col("start_pos").alias("event_id"), fields).select("event_id", "j.*")


@query(
    "json_diff_apply",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN '{"k":' || CAST(user_id AS VARCHAR) || '}' WHEN 1 THEN '{"k":' || json_extract_string(props, '$.k') || ',"z":"n"}'
        ELSE '{"z":[1,' || CAST(user_id AS VARCHAR) || ']}' END AS doc FROM events""",
)
def json_diff_apply(spark, sf):
    from tidelog.operators.jsondiff import apply_json_diffs

    def diff(op, path, value):
        return F.struct(F.lit(op).alias("op"), F.lit(path).alias("path"), value.alias("value"))

    user, none = F.col("user_id").cast("string"), F.lit(None).cast("string")
    kind = eid() % 3
    diffs = (
        F.when(kind == 0, F.array(diff("replace", "$.k", user)))
        .when(kind == 1, F.array(diff("insert", "$.z", F.lit('"n"'))))
        .otherwise(
            F.array(diff("remove", "$.k", none), diff("insert", "$.z", F.lit("[1]")), diff("insert", "$.z[1]", user))
        )
    )
    docs = table(spark, sf, "events").select("event_id", F.col("props").alias("doc"), diffs.alias("diffs"))
    return apply_json_diffs(docs, "doc", "diffs").select("event_id", "doc")
