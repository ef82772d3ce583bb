"""Event families: one DataFrame per body layout, all native expressions.

``events(log, family)`` filters by type code and projects the body. Position
arguments are 1-based byte positions in the body.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.binary import be_int, le_int, lenenc_int, text, uuid_text

HEADER_SIZE = 19

# Event type codes (fixed values of the log format).
TYPE_NAMES = {
    0: "UnknownEvent", 1: "StartEventV3", 2: "QueryEvent", 3: "StopEvent", 4: "RotateEvent",
    5: "IntVarEvent", 6: "LoadEvent", 7: "SlaveEvent", 8: "CreateFileEvent", 9: "AppendBlockEvent",
    10: "ExecLoadEvent", 11: "DeleteFileEvent", 12: "NewLoadEvent", 13: "RandEvent",
    14: "UserVarEvent", 15: "FormatDescriptionEvent", 16: "XIDEvent", 17: "BeginLoadQueryEvent",
    18: "ExecuteLoadQueryEvent", 19: "TableMapEvent", 20: "WriteRowsEventV0",
    21: "UpdateRowsEventV0", 22: "DeleteRowsEventV0", 23: "WriteRowsEventV1",
    24: "UpdateRowsEventV1", 25: "DeleteRowsEventV1", 26: "IncidentEvent", 27: "HeartbeatEvent",
    28: "IgnorableEvent", 29: "RowsQueryEvent", 30: "WriteRowsEventV2", 31: "UpdateRowsEventV2",
    32: "DeleteRowsEventV2", 33: "GTIDEvent", 34: "AnonymousGTIDEvent", 35: "PreviousGTIDsEvent",
    36: "TransactionContextEvent", 37: "ViewChangeEvent", 38: "XAPrepareLogEvent",
    39: "PartialUpdateRowsEvent", 40: "TransactionPayloadEvent", 41: "HeartbeatLogEventV2",
    160: "MariadbAnnotateRowsEvent", 161: "MariadbBinLogCheckPointEvent", 162: "MariadbGTIDEvent",
    163: "MariadbGTIDListEvent", 164: "MariadbStartEncryptionEvent",
    165: "MariadbQueryCompressedEvent", 166: "MariadbWriteRowsCompressedEventV1",
    167: "MariadbUpdateRowsCompressedEventV1", 168: "MariadbDeleteRowsCompressedEventV1",
}

FORMAT, ROTATE, QUERY, XID, TABLE_MAP, PAYLOAD = 15, 4, 2, 16, 19, 40
ROWS = (20, 21, 22, 23, 24, 25, 30, 31, 32, 39, 166, 167, 168)
COMPRESSED = (165, 166, 167, 168)
# Types whose body has a typed layout here; all others stay opaque bytes.
TYPED = (2, 4, 5, 9, 15, 16, 17, 18, 19, 29, 33, 34, 35, 40, 160, 161, 162, 163, *ROWS, 165)


def type_name(event_type: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair])
    return F.coalesce(F.element_at(names, event_type), F.lit("UnknownEvent"))


def header(raw: Column) -> list[Column]:
    """The 19 header bytes of an event, little-endian."""
    return [
        F.timestamp_seconds(le_int(raw, 1, 4)).alias("ts"),
        be_int(raw, 5, 1).cast("int").alias("event_type"),
        le_int(raw, 6, 4).alias("server_id"),
        le_int(raw, 10, 4).alias("event_size"),
        le_int(raw, 14, 4).alias("log_pos"),
        le_int(raw, 18, 2).cast("int").alias("flags"),
    ]


def rest(body: Column, pos: int | Column) -> Column:
    pos = pos if isinstance(pos, Column) else F.lit(pos)
    return F.substring(body, pos.cast("int"), F.length(body))


# -- server versions in format events ------------------------------------------


def version_product(version: Column) -> Column:
    def part(i: int) -> Column:
        found = F.regexp_extract(version, r"^(\d+)\.(\d+)\.(\d+)", i)
        return F.coalesce(found.try_cast("bigint"), F.lit(0))

    return (part(1) * 256 + part(2)) * 256 + part(3)


def has_checksum_field(version: Column) -> Column:
    """Format events tell the checksum algorithm from 5.6.1 (MariaDB: 5.3.0) on."""
    product = version_product(version)
    mysql, maria = (5 * 256 + 6) * 256 + 1, (5 * 256 + 3) * 256
    return F.when(F.lower(version).contains("mariadb"), product >= maria).otherwise(product >= mysql)


# -- families -------------------------------------------------------------------

def _format(b: Column) -> dict[str, Column]:
    size = F.length(b)
    version = F.rtrim(text(F.substring(b, 3, 50)), F.lit("\x00"))
    aware = has_checksum_field(version)
    n_types = size - 57 - F.when(aware, 5).otherwise(0)
    codes = F.when(n_types > 0, F.sequence(F.lit(1), n_types)).otherwise(F.array().cast("array<int>"))
    return {
        "version": le_int(b, 1, 2),
        "server_version": version,
        "create_ts": le_int(b, 53, 4),
        "header_length": be_int(b, 57, 1),
        "log_checksum_alg": F.when(aware, be_int(b, size - 4, 1)).otherwise(F.lit(255)),
        "post_header_lengths": F.transform(codes, lambda i: be_int(b, 57 + i, 1)),
        "error": F.when(be_int(b, 57, 1) != HEADER_SIZE, "unexpected header length"),
    }


def _rotate(b: Column) -> dict[str, Column]:
    return {"position": le_int(b, 1, 8), "next_file": text(rest(b, 9))}


def _query(b: Column) -> dict[str, Column]:
    schema_len, status_len = be_int(b, 9, 1), le_int(b, 12, 2)
    at = (status_len + 14).cast("int")
    return {
        "proxy_id": le_int(b, 1, 4),
        "exec_time": le_int(b, 5, 4),
        "error_code": le_int(b, 10, 2),
        "status_vars": F.substring(b, F.lit(14), status_len.cast("int")),
        "schema_name": text(F.substring(b, at, schema_len.cast("int"))),
        "query": text(rest(b, at + schema_len + 1)),
    }


def _xid(b: Column) -> dict[str, Column]:
    return {"xid": le_int(b, 1, 8)}


def _gtid(b: Column) -> dict[str, Column]:
    """Fields beyond the gno came with later servers; missing ones stay 0."""
    size, zero = F.length(b), F.lit(0).cast("bigint")
    logical = (size >= 42) & (be_int(b, 26, 1) == 2)
    has_time = logical & (size >= 49)
    immediate_raw = le_int(b, 43, 7)
    split_time = F.getbit(immediate_raw, F.lit(55)) == 1
    immediate = immediate_raw.bitwiseAND((1 << 55) - 1)
    after_time = F.when(split_time, 57).otherwise(50)
    has_length = has_time & (size >= after_time)
    length = lenenc_int(b, after_time)
    after_length = after_time + length["width"]
    has_version = has_length & (size >= after_length + 3)
    version_raw = le_int(b, after_length, 4)
    split_version = F.getbit(version_raw, F.lit(31)) == 1
    undefined = F.when(has_length, F.lit(999999)).otherwise(0)
    original_time = F.when(split_time, le_int(b, 50, 7)).otherwise(immediate)
    original_version = F.when(split_version, le_int(b, after_length + 4, 4)).otherwise(version_raw)

    def given(present: Column, value: Column, default: Column = zero) -> Column:
        return F.when(present, value).otherwise(default).cast("bigint")

    return {
        "commit_flag": be_int(b, 1, 1),
        "sid": uuid_text(F.substring(b, 2, 16)),
        "gno": le_int(b, 18, 8, signed=True),
        "last_committed": given(logical, le_int(b, 27, 8, True)),
        "sequence_number": given(logical, le_int(b, 35, 8, True)),
        "immediate_commit_us": given(has_time, immediate),
        "original_commit_us": given(has_time, original_time),
        "transaction_length": given(has_length, length["value"]),
        "immediate_version": given(has_version, version_raw.bitwiseAND((1 << 31) - 1), undefined),
        "original_version": given(has_version, original_version, undefined),
    }


def _mariadb_gtid(b: Column) -> dict[str, Column]:
    flags = be_int(b, 13, 1)
    return {
        "domain_id": le_int(b, 9, 4),
        "seq": le_int(b, 1, 8),
        "gtid_flags": flags,
        "is_ddl": flags.bitwiseAND(32) != 0,
        "is_standalone": flags.bitwiseAND(1) != 0,
        "commit_id": F.when(flags.bitwiseAND(2) != 0, le_int(b, 14, 8)),
    }


def _mariadb_gtid_list(b: Column) -> dict[str, Column]:
    count = le_int(b, 1, 4).bitwiseAND((1 << 28) - 1)
    slots = F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )

    def entry(i: Column) -> Column:
        at = 5 + 16 * i
        return F.struct(
            i.alias("ordinal"),
            le_int(b, at, 4).alias("domain_id"),
            le_int(b, at + 4, 4).alias("list_server_id"),
            le_int(b, at + 8, 8).alias("seq"),
        )

    return {"": F.inline(F.transform(slots, entry))}


def _load_block(b: Column) -> dict[str, Column]:
    return {"file_id": le_int(b, 1, 4), "block": rest(b, 5)}


def _load_query(b: Column) -> dict[str, Column]:
    return {
        "proxy_id": le_int(b, 1, 4),
        "exec_time": le_int(b, 5, 4),
        "schema_length": be_int(b, 9, 1),
        "error_code": le_int(b, 10, 2),
        "status_length": le_int(b, 12, 2),
        "file_id": le_int(b, 14, 4),
        "start_pos_in_query": le_int(b, 18, 4),
        "end_pos_in_query": le_int(b, 22, 4),
        "dup_flags": be_int(b, 26, 1),
    }


def _annotation(b: Column) -> dict[str, Column]:
    skip = F.when(F.col("event_type") == 29, 2).otherwise(1)
    return {"info": text(rest(b, skip))}


def _intvar(b: Column) -> dict[str, Column]:
    kind = be_int(b, 1, 1)
    name = F.when(kind == 1, "LAST_INSERT_ID").when(kind == 2, "INSERT_ID").otherwise("INVALID")
    return {"var_type": kind, "var_name": name, "value": le_int(b, 2, 8)}


def _previous_gtids(b: Column) -> dict[str, Column]:
    """Walk the sids (each says how many intervals follow), then open the intervals."""
    n_sids = le_int(b, 1, 8).cast("int")
    none = F.array().cast("array<struct<at:int,n:int>>")
    walk = F.aggregate(
        F.when(n_sids > 0, F.sequence(F.lit(1), n_sids)).otherwise(F.array().cast("array<int>")),
        F.struct(F.lit(9).alias("at"), none.alias("seen")),
        lambda s, _: F.struct(
            (s["at"] + 24 + 16 * le_int(b, s["at"] + 16, 8).cast("int")).alias("at"),
            F.array_append(
                s["seen"],
                F.struct(s["at"].alias("at"), le_int(b, s["at"] + 16, 8).cast("int").alias("n")),
            ).alias("seen"),
        ),
        lambda s: s["seen"],
    )

    def intervals(sid: Column) -> Column:
        slots = F.when(sid["n"] > 0, F.sequence(F.lit(0), sid["n"] - 1)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(
            slots,
            lambda i: F.struct(
                uuid_text(F.substring(b, sid["at"], F.lit(16))).alias("sid"),
                le_int(b, sid["at"] + 24 + 16 * i, 8, True).alias("start"),
                le_int(b, sid["at"] + 32 + 16 * i, 8, True).alias("stop"),
            ),
        )

    return {"": F.inline(F.flatten(F.transform(walk, intervals)))}


FAMILIES: dict[str, tuple[tuple[int, ...], Callable[[Column], dict[str, Column]]]] = {
    "format_events": ((15,), _format),
    "rotate_events": ((4,), _rotate),
    "query_events": ((2, 165), _query),
    "xid_events": ((16,), _xid),
    "gtid_events": ((33, 34), _gtid),
    "previous_gtids": ((35,), _previous_gtids),
    "mariadb_gtid_events": ((162,), _mariadb_gtid),
    "mariadb_gtid_list": ((163,), _mariadb_gtid_list),
    "load_blocks": ((9, 17), _load_block),
    "load_queries": ((18,), _load_query),
    "annotations": ((29, 160, 161), _annotation),
    "intvar_events": ((5,), _intvar),
}

LOG_KEY = ("source", "file_base", "file_seq", "start_pos", "inner_idx")
HEADER = ("ts", "event_type", "server_id", "event_size", "log_pos", "flags")


def events(log: DataFrame, family: str) -> DataFrame:
    """Typed events of one family; the log key and header columns stay in front.

    Compressed query events must have been through ``inflate_bodies``.
    """
    types, layout = FAMILIES[family]
    kept = [c for c in log.columns if c not in ("body", "raw")]
    fields = layout(F.col("body"))
    # A family that opens into several rows has one nameless generator.
    typed = [c.alias(n) if n else c for n, c in fields.items()]
    return log.filter(F.col("event_type").isin(*types)).select(*kept, *typed)


def generic_events(log: DataFrame) -> DataFrame:
    """Events without a typed layout: kept as bytes, never dropped."""
    return log.filter(~F.col("event_type").isin(*TYPED))


def verify_checksum(log: DataFrame) -> DataFrame:
    """Add ``checksum_ok``: CRC32 of everything but the trailer equals the trailer.

    ``raw`` is the whole event; without a checksum (algorithm other than 1) it is NULL.
    """
    return log.withColumn("checksum_ok", checksum_ok(F.col("raw"), F.col("checksum_alg")))


def checksum_ok(raw: Column, checksum_alg: Column) -> Column:
    size = F.length(raw)
    stored = le_int(raw, size - 3, 4)
    actual = F.crc32(F.substring(raw, F.lit(1), size - 4))
    return F.when(checksum_alg == 1, actual == stored)


def body_of(raw: Column, event_type: Column, checksum_alg: Column) -> Column:
    """Bytes between header and checksum trailer; a format event keeps its tail,
    where its own checksum algorithm is told."""
    trailer = F.when((checksum_alg == 1) & (event_type != FORMAT), 4).otherwise(0)
    return F.substring(raw, F.lit(HEADER_SIZE + 1), F.length(raw) - HEADER_SIZE - trailer)


def join_load_data(blocks: DataFrame, executes: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks of one LOAD DATA file in order, next to the statement that used them.

    The file content stays one row per block (``block_no`` gives the order), so
    a file of any size is never assembled in one task.
    """
    return blocks.join(executes, [*keys, "file_id"])
