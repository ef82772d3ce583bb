"""Fixture archives: the orders table as binary-log files in the shared folder.

Per ten orders one transaction: an insert of all ten, a minimal update of the
second and a delete of the third. Spark computes every byte and each file is
streamed to disk in position order by the task that owns it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions.binary import to_le
from tidelog.plans import encode as enc
from tidelog.plans.views import div
from tidelog.session import new_folder, spread_table
from tidelog.sources.binlog import MAGIC, open_fs, qualified

ORDERS_PER_FILE = 2000
PER_TX = 10
SID = "3e11fa47-71ca-11e1-9e33-c80aa9429562"
T0 = 1_704_067_200

# Post-header lengths of event types 1.. as an 8.0 server writes them (fixed values).
POST_HEADER = [
    56, 13, 0, 8, 0, 0, 0, 0, 4, 0, 4, 0, 0, 0, 98, 0, 4, 26, 8, 0, 0, 0, 8, 8, 8, 2, 0, 0, 0, 10,
    10, 10, 42, 42, 0, 18, 52, 0, 10, 40, 0,
]


def lenenc_bytes(data: bytes) -> bytes:
    return bytes([len(data)]) + data


def format_body() -> bytes:
    version = b"8.0.32".ljust(50, b"\0")
    # The checksum algorithm; the frame adds the checksum itself.
    return b"\x04\0" + version + bytes(4) + b"\x13" + bytes(POST_HEADER) + b"\x01"


def orders_map(table_id: int = 108) -> bytes:
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "o_attrs"]
    types = bytes([8, 3, 254, 246, 18, 15, 245])
    metas = bytes([247, 1, 12, 2, 0, 60, 0, 4])
    optional = [
        (1, b"\x40"),
        (2, b"\x2d"),
        (4, b"".join(lenenc_bytes(n.encode()) for n in names)),
        (6, b"\x03" + b"".join(lenenc_bytes(x) for x in (b"F", b"O", b"P"))),
        (8, b"\x00"),
        (10, b"\x2d"),
    ]
    return (
        table_id.to_bytes(6, "little") + b"\x01\0" + b"\x04shop\0" + b"\x06orders\0"
        + bytes([len(types)]) + types + lenenc_bytes(metas) + b"\x78"
        + b"".join(bytes([k]) + lenenc_bytes(v) for k, v in optional)
    )


def const(data: bytes) -> Column:
    return F.unhex(F.lit(data.hex()))


def order_cells(price: Column | None = None, status: Column | None = None) -> dict[str, Column]:
    """Cell bytes per column of an order."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    labels = F.array(F.lit("F"), F.lit("O"), F.lit("P"))
    # {"k": n} with an inline 16-bit number.
    json = F.concat(
        enc.raw("00" + "0100" + "0C00" + "0B00" + "0100" + "05"), to_le(F.col("o_custkey") % 1000, 2), enc.raw("6B")
    )
    return {
        "o_orderkey": to_le(F.col("o_orderkey"), 8),
        "o_custkey": to_le(F.col("o_custkey"), 4),
        "o_orderstatus": to_le(status if status is not None else F.array_position(labels, F.col("o_orderstatus")), 1),
        "o_totalprice": enc.decimal_cell(price if price is not None else cents, 12, 2),
        "o_orderdate": enc.datetime2_cell(F.col("o_orderdate")),
        "o_orderpriority": enc.short_text(F.col("o_orderpriority")),
        "o_attrs": F.concat(to_le(F.length(json), 4), json),
    }


def rows_body(flags: int, version: int, bitmaps: str, images: Column, table_id: int = 108) -> Column:
    extra = "0200" if version == 2 else ""
    head = table_id.to_bytes(6, "little").hex() + flags.to_bytes(2, "little").hex() + extra + "07"
    return F.concat(enc.raw(head + bitmaps), images)


def order_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten orders per row: their insert images, and the update and delete images."""
    full = order_cells()
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    changed = order_cells(price=cents + 100, status=F.lit(3))
    nulls = enc.raw("00")
    insert = F.concat(nulls, *full.values())
    update = F.concat(nulls, full["o_orderkey"], nulls, changed["o_orderstatus"], changed["o_totalprice"])
    key = F.col("o_orderkey")
    orders = spread_table(spark, sf_dir, "orders").withColumn("g", div("o_orderkey", PER_TX))
    # A delete shows the image of the insert, which is made once.
    images = orders.select(
        "g", key.alias("k"), insert.alias("insert"), F.when(key % PER_TX == 1, update).alias("update")
    ).withColumn("delete", F.when(F.col("k") % PER_TX == 2, F.col("insert")))
    joined = F.aggregate(
        F.array_sort(F.collect_list(F.struct("k", "insert"))),
        F.unhex(F.lit("")),
        lambda acc, x: F.concat(acc, x["insert"]),
    )
    return images.groupBy("g").agg(
        joined.alias("inserts"),
        F.max("update").alias("update"),
        F.max("delete").alias("delete"),
    )


def write_rows(images: Column, version: int = 2) -> Column:
    return rows_body(1, version, "7F", images)


def transaction_events(groups: DataFrame) -> DataFrame:
    """Events of each group's transaction: ``g, n, event_type, body``."""
    g = F.col("g")
    gtid = F.concat(
        enc.raw("01"), enc.uuid_bytes(F.lit(SID)), to_le(g + 1, 8), enc.raw("02"), to_le(g, 8), to_le(g + 1, 8)
    )
    begin = enc.raw("0000000000000000" + "04" + "0000" + "0000" + b"shop".hex() + "00" + b"BEGIN".hex())
    the_map = const(orders_map())
    absent = F.lit(None).cast("binary")

    def event(n: int, tp: int, body: Column) -> Column:
        return F.struct(F.lit(n).alias("n"), F.lit(tp).alias("event_type"), body.alias("body"))

    has_update, has_delete = F.col("update").isNotNull(), F.col("delete").isNotNull()
    events = F.array(
        event(0, 33, gtid),
        event(1, 2, begin),
        event(2, 19, the_map),
        event(3, 30, write_rows(F.col("inserts"))),
        event(4, 19, F.when(has_update, the_map).otherwise(absent)),
        event(5, 31, F.when(has_update, rows_body(1, 2, "010C", F.col("update"))).otherwise(absent)),
        event(6, 19, F.when(has_delete, the_map).otherwise(absent)),
        event(7, 32, F.when(has_delete, rows_body(1, 2, "7F", F.col("delete"))).otherwise(absent)),
        event(8, 16, to_le(g, 8)),
    )
    return groups.select("g", F.inline(F.filter(events, lambda e: e["body"].isNotNull())))


def archive_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed events of all files: ``file, start_pos, raw``."""
    per_file = ORDERS_PER_FILE // PER_TX
    groups, file_no = order_groups(spark, sf_dir), div("g", per_file)
    body = transaction_events(groups).withColumn("file_no", file_no)
    last = 10**15

    def event(o: int, tp: int, bytes_: Column) -> Column:
        return F.struct(F.lit(o).cast("bigint").alias("o"), F.lit(tp).alias("event_type"), bytes_.alias("body"))

    executed = F.concat(
        enc.raw("0100000000000000"), enc.uuid_bytes(F.lit(SID)), enc.raw("0100000000000000"),
        to_le(F.lit(1), 8), to_le(F.col("file_no") * per_file + 1, 8),
    )
    successor = F.format_string("binlog.%06d", F.col("file_no") + 1)
    edge = F.array(
        event(-4, 15, const(format_body())),
        event(-3, 35, executed),
        event(-2, 14, enc.raw("0300000061626301")),
        event(-1, 50, enc.raw("CAFE")),
        event(last, 4, F.concat(to_le(F.lit(4), 8), enc.utf8(successor))),
    )
    # Every group has a transaction, so files are known without images.
    edges = groups.select(file_no.alias("file_no")).distinct().select("file_no", F.inline(edge))
    events = body.select("file_no", (F.col("g") * 16 + F.col("n")).alias("o"), "event_type", "body").unionByName(edges)
    # A file holds a fixed number of orders, so this window is bounded.
    before = Window.partitionBy("file_no").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("body") + 23
    placed = events.withColumn("start_pos", F.coalesce(F.sum(size).over(before), F.lit(0)) + 4)
    ts = F.lit(T0) + F.col("file_no") * 60 + F.when(F.col("o") >= 0, F.col("o") % 60).otherwise(0)
    raw = enc.frame(F.col("event_type"), F.col("body"), ts, F.lit(1), F.col("start_pos"), F.lit(0))
    name = F.format_string("binlog.%06d", "file_no")
    headed = placed.select(name.alias("file"), "start_pos", raw.alias("head"))
    return headed.select("file", "start_pos", enc.with_crc(F.col("head")).alias("raw"))


def write_files(events: DataFrame, folder: str) -> None:
    """One file per ``file`` value, frames in ``start_pos`` order."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        current, out, n, done = None, None, 0, []
        # Written aside and moved when complete, so a task that is run again
        # or twice leaves whole files only.
        def close():
            out.close()
            fs.move(f"{root}/_part-{tag}-{current}", f"{root}/{current}")
            done.append({"file": current, "n": n})

        tag = uuid.uuid4().hex
        for batch in batches:
            for name, raw in zip(batch.column("file").to_pylist(), batch.column("raw").to_pylist()):
                if name != current:
                    if out is not None:
                        close()
                    current, n = name, 0
                    out = fs.open_output_stream(f"{root}/_part-{tag}-{name}")
                    out.write(MAGIC)
                out.write(raw)
                n += 1
        if out is not None:
            close()
        schema = pa.schema([("file", pa.string()), ("n", pa.int64())])
        yield pa.RecordBatch.from_pylist(done, schema=schema)

    ordered = events.repartition("file").sortWithinPartitions("file", "start_pos")
    ordered.select("file", "raw").mapInArrow(write, "file string, n bigint").write.format("noop").mode(
        "overwrite"
    ).save()


_written: dict[tuple[str, str], str] = {}


def archive(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the archive of a data set; written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        folder = new_folder(spark, "archive") + "/srv1"
        write_files(archive_events(spark, sf_dir), qualified(spark, folder))
        _written[key] = folder
    return _written[key]
