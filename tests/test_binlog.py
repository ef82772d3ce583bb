"""Reading log files: framing, damage, offsets, binding, images, streams."""

import json
import struct
import tempfile
from pathlib import Path

import pytest
import zstandard
from binlog_writer import Log, lenenc, rows, table_map, text
from pyspark.sql import functions as F

from tidelog.operators import catalog, events, images, quality, rowcodec
from tidelog.sources import binlog, compressed, sinks
from tidelog.streaming import feeds


@pytest.fixture
def folder():
    path = Path(tempfile.mkdtemp(prefix="run-", dir="/tmp")) / "srv"
    path.mkdir()
    return path


INT_MAP = table_map(7, [3, 15], b"\x20\x00")


def int_image(n: int, s: str | None) -> bytes:
    return (b"\x02" if s is None else b"\x00") + struct.pack("<i", n) + (b"" if s is None else text(s))


def simple_log(**kw) -> Log:
    log = Log(**kw)
    log.add(19, INT_MAP)
    log.add(30, rows(7, 2, int_image(1, "a") + int_image(-2, None), [b"\x03"]))
    log.add(16, (99).to_bytes(8, "little"))
    return log


@pytest.mark.parametrize("checksum", [True, False])
def test_rows_and_header(spark, folder, checksum):
    simple_log(checksum=checksum).write(folder / "bin.000001")
    log = binlog.read_binlog(spark, str(folder), verify_checksum=True)
    assert [r.event_type for r in log.orderBy("start_pos").select("event_type").collect()] == [15, 19, 30, 16]
    changes = images.row_changes(log).orderBy("change_no").collect()
    assert [c.op for c in changes] == ["I", "I"]
    assert [bytes(changes[0].after[0]), bytes(changes[0].after[1])] == [struct.pack("<i", 1), b"a"]
    assert changes[1].after[1] is None and changes[1].skipped_after == []
    assert events.events(log, "xid_events").collect()[0].xid == 99
    key = log.select("source", "file_base", "file_seq").distinct().collect()
    assert [tuple(k) for k in key] == [("srv", "bin", 1)]


def test_partial_header_ends_quietly_partial_body_is_an_error(spark, folder):
    log = simple_log()
    (folder / "bin.000001").write_bytes(bytes(log.data) + b"\1\2\3")
    assert binlog.read_binlog(spark, str(folder)).count() == 4
    (folder / "bin.000002").write_bytes(bytes(log.data[:-5]))
    with pytest.raises(Exception, match="cut short"):
        binlog.read_binlog(spark, str(folder)).collect()
    good, bad = quality.split_quarantine(binlog.read_binlog(spark, str(folder), mode="PERMISSIVE"))
    assert good.count() == 7
    assert [r.error for r in bad.collect()] == ["event body cut short"]


def test_not_a_log(spark, folder):
    (folder / "bin.000001").write_bytes(b"hello world")
    with pytest.raises(Exception, match="not a binary log"):
        binlog.read_binlog(spark, str(folder)).collect()


def test_checksum_damage(spark, folder):
    log = simple_log()
    log.data[-6] ^= 1
    log.write(folder / "bin.000001")
    marked = binlog.read_binlog(spark, str(folder), mode="PERMISSIVE", verify_checksum=True)
    assert [r.event_type for r in marked.filter("error = 'checksum mismatch'").collect()] == [16]
    with pytest.raises(Exception, match="checksum mismatch"):
        binlog.read_binlog(spark, str(folder), verify_checksum=True).select("body").collect()
    assert binlog.read_binlog(spark, str(folder)).count() == 4


def test_start_offset_keeps_the_format_event(spark, folder):
    log = Log()
    log.add(19, INT_MAP)
    at = log.add(16, bytes(8))
    log.write(folder / "bin.000001")
    got = binlog.read_binlog(spark, str(folder), start_pos=at).orderBy("start_pos")
    assert [(r.start_pos, r.event_type) for r in got.collect()] == [(4, 15), (at, 16)]
    assert binlog.read_binlog(spark, str(folder), start_pos=0).count() == 3


def test_reader_options_drop_events_but_not_table_maps(spark, folder):
    simple_log().write(folder / "bin.000001")
    bound = binlog.read_binlog(spark, str(folder), event_types=[30]).collect()
    assert [r.event_type for r in bound] == [30] and bytes(bound[0].table_map) == INT_MAP
    assert binlog.read_binlog(spark, str(folder), since=1_700_000_001).count() == 0
    assert binlog.read_binlog(spark, str(folder), since=1_700_000_000).count() == 4


def test_one_read_with_two_filters_keeps_all_rows(spark, folder):
    simple_log().write(folder / "bin.000001")
    read = binlog.read_binlog(spark, str(folder))
    both = read.filter("event_type = 16").unionByName(read.filter("event_type <> 16"))
    assert both.count() == 4


def test_maps_end_with_their_statement(spark, folder):
    log = Log()
    log.add(19, INT_MAP)
    log.add(30, rows(7, 2, int_image(1, "a"), [b"\x03"], flags=0))
    log.add(30, rows(7, 2, int_image(2, "b"), [b"\x03"], flags=1))
    orphan = log.add(30, rows(7, 2, int_image(3, "c"), [b"\x03"]))
    log.write(folder / "bin.000001")
    read = binlog.read_binlog(spark, str(folder))
    assert [r.start_pos for r in images.orphan_events(read).collect()] == [orphan]
    assert images.row_changes(read).count() == 2


def test_update_and_minimal_images(spark, folder):
    log = Log()
    log.add(19, INT_MAP)
    # Before image: key only; after image: text only.
    log.add(31, rows(7, 2, b"\x00" + struct.pack("<i", 5) + b"\x00" + text("new"), [b"\x01", b"\x02"]))
    log.write(folder / "bin.000001")
    row = images.row_changes(binlog.read_binlog(spark, str(folder))).collect()[0]
    assert (row.op, row.skipped_before, row.skipped_after) == ("U", [1], [0])
    kinds = images.row_images(binlog.read_binlog(spark, str(folder))).orderBy("image_idx").collect()
    assert [(k.image_idx, k.kind) for k in kinds] == [(0, "UpdateBI"), (1, "UpdateAI")]


def test_malformed_rows_event_is_set_aside(spark, folder):
    log = Log()
    log.add(19, INT_MAP)
    log.add(30, rows(7, 2, b"\x00\x01\x02", [b"\x03"]))
    log.write(folder / "bin.000001")
    row = images.row_changes(binlog.read_binlog(spark, str(folder))).collect()[0]
    assert row.error == "row image cut short" and row.after is None


def test_enum_set_and_wide_enum(spark, folder):
    types, metas = [254, 254, 254], bytes([247, 1, 247, 2, 248, 3])
    log = Log()
    log.add(19, table_map(9, types, metas))
    log.add(30, rows(9, 3, b"\x00" + b"\x03" + b"\x01\x01" + b"\x05\x00\x00", [b"\x07"]))
    log.write(folder / "bin.000001")
    specs = [images.ColumnSpec("e", 0, 254, 247 * 256 + 1), images.ColumnSpec("w", 1, 254, 247 * 256 + 2), images.ColumnSpec("s", 2, 254, 248 * 256 + 3)]
    typed = images.typed_changes(images.row_changes(binlog.read_binlog(spark, str(folder))), "d", "t", specs)
    assert tuple(typed.select("after.*").collect()[0]) == (3, 257, 5)


def test_optional_metadata(spark, folder):
    optional = (
        b"\x01\x01\x40" + b"\x02\x05\x2d\x01\x3f\x02\x08" + b"\x04" + lenenc(10) + text("ab") + text("cd") + text("ef") + text("")
        + b"\x09\x04\x02\x00\x00\x0a"
    )
    log = Log()
    log.add(19, table_map(3, [3, 8, 15, 252], b"\x20\x00\x02", optional=optional, nulls=b"\x09"))
    log.write(folder / "bin.000001")
    maps = images.table_maps(binlog.read_binlog(spark, str(folder)))
    cols = catalog.column_catalog(maps, ["schema_name"]).orderBy("ordinal").collect()
    assert [c.unsigned for c in cols] == [False, True, None, None]
    assert [c.nullable for c in cols] == [True, False, False, True]
    assert [c.collation for c in cols] == [None, None, 0x2D, 0x3F]
    assert [(c.pk_ord, c.pk_prefix) for c in cols] == [(1, 10), (None, None), (0, 0), (None, None)]
    assert [c.name for c in cols] == ["ab", "cd", "ef", ""]


def test_unsupported_map_types_are_reported(spark, folder):
    log = Log()
    log.add(19, table_map(3, [247], b""))
    log.write(folder / "bin.000001")
    found = images.table_maps(binlog.read_binlog(spark, str(folder))).collect()[0]
    assert "unsupported column type 247" in found.map_error


# -- JSON ------------------------------------------------------------------------


def small_array(values: list[bytes]) -> bytes:
    """Array of inline values, each (type byte + 2 bytes)."""
    return b"\x02" + struct.pack("<HH", len(values), 4 + 3 * len(values)) + b"".join(values)


def test_json_documents():
    value = lambda b: json.loads(rowcodec.dump_json(rowcodec.json_value(b)))
    assert value(small_array([b"\x05\xff\xff", b"\x06\xff\xff", b"\x04\x00\x00", b"\x04\x01\x00", b"\x04\x02\x00"])) == [-1, 65535, None, True, False]
    assert value(b"\x0c\x03abc") == "abc"
    assert value(b"\x0b" + struct.pack("<d", 2.5)) == 2.5
    assert value(b"\x0a" + b"\xff" * 8) == 2**64 - 1
    assert value(b"\x0f\xf6\x04\x04\x02\x8a\x37") == "10.55"
    clock = ((12 << 12 | 34 << 6 | 56) << 24) + 7
    assert value(b"\x0f\x0b\x08" + struct.pack("<q", clock)) == "12:34:56.000007"
    assert value(b"\x0f\x0b\x08" + struct.pack("<q", -clock)) == "-12:34:56.000007"
    day = (((2024 * 13 + 2) << 5 | 29) << 17 | (1 << 12)) << 24
    assert value(b"\x0f\x0c\x08" + struct.pack("<q", day)) == "2024-02-29 01:00:00.000000"
    assert value(b"\x0f\xfc\x01x") is None
    with pytest.raises(ValueError):
        rowcodec.json_value(b"\x00\x01\x00\xff\x00")


def test_empty_and_damaged_json(spark, folder):
    log = Log()
    one = table_map(4, [245], b"\x02")
    log.add(19, one)
    log.add(30, rows(4, 1, b"\x00" + b"\x00\x00", [b"\x01"]))
    log.add(19, one)
    log.add(30, rows(4, 1, b"\x00" + b"\x05\x00" + b"\x00\x01\x00\xff\x00", [b"\x01"]))
    log.write(folder / "bin.000001")
    read = binlog.read_binlog(spark, str(folder))
    rows_ = images.row_changes(read).orderBy("start_pos").collect()
    assert bytes(rows_[0].after[0]) == b"" and rows_[1].error == "JSON container cut short"
    kept = images.row_changes(read, ignore_json_errors=True).orderBy("start_pos").collect()
    assert kept[1].error is None and kept[1].after == [None]


def test_partial_json_update(spark, folder):
    diff = b"\x00" + text("$.a") + lenenc(3) + b"\x05\x07\x00" + b"\x02" + text("$.b")
    before = b"\x00" + struct.pack("<i", 1) + struct.pack("<H", 8) + small_array([b"\x05\x01\x00"])
    after = b"\x01" + b"\x01" + b"\x00" + struct.pack("<H", len(diff)) + diff
    log = Log()
    log.add(19, table_map(4, [3, 245], b"\x02"))
    log.add(39, rows(4, 2, before + after, [b"\x03", b"\x02"]))
    log.write(folder / "bin.000001")
    row = images.row_changes(binlog.read_binlog(spark, str(folder))).collect()[0]
    assert row.error is None and row.json_diffs == [1]
    assert json.loads(row.after[1]) == [{"op": "replace", "path": "$.a", "value": "7"}, {"op": "remove", "path": "$.b"}]


# -- compressed transactions --------------------------------------------------------


def test_payload_with_unknown_compression(spark, folder):
    inner = struct.pack("<IBIIIH", 5, 16, 1, 27, 0, 0) + (3).to_bytes(8, "little")
    packed = zstandard.ZstdCompressor().compress(inner * 2)
    head = b"\x02\x01\x00\x01\x01" + bytes([len(packed) % 256]) + b"\x00"
    log = Log()
    log.add(40, head + packed)
    log.add(40, b"\x02\x01\x05\x00" + b"abc")
    log.write(folder / "bin.000001")
    opened = compressed.expand_payloads(binlog.read_binlog(spark, str(folder)))
    assert sorted((r.event_type, r.inner_idx) for r in opened.filter("error is null").collect()) == [(15, 0), (16, 1), (16, 2)]
    assert "compression type 5" in opened.filter("error is not null").collect()[0].error


# -- streams ----------------------------------------------------------------------------


def test_stream_stops_at_statement_end_and_resumes(spark, folder):
    log = Log()
    log.add(19, INT_MAP)
    log.add(30, rows(7, 2, int_image(1, "a"), [b"\x03"]))
    whole = len(log.data)
    log.add(19, INT_MAP)
    log.write(folder / "bin.000001")
    sink, check = str(folder.parent / "out"), str(folder.parent / "check")

    def run():
        changes = images.row_changes(binlog.stream_binlog(spark, str(folder)))
        return feeds.drain(changes.select("start_pos", "op", "error"), "t", sink, check)

    assert run().count() == 1
    # The open statement is finished and a new file begins.
    log.add(30, rows(7, 2, int_image(2, "b"), [b"\x03"]))
    log.write(folder / "bin.000001")
    simple_log().write(folder / "bin.000002")
    got = run().collect()
    assert len(got) == 4 and not [r for r in got if r.error]
    assert run().count() == 4
    late = binlog.stream_binlog(spark, str(folder), starting=("bin.000001", whole))
    assert feeds.drain(late.select("event_type"), "late").filter("event_type = 30").count() == 2


def test_table_sink_and_dump(spark, folder):
    simple_log().write(folder / "bin.000001")
    read = binlog.read_binlog(spark, str(folder))
    out = str(folder.parent / "tables")
    stamped = images.row_changes(read, (*events.LOG_KEY, "ts"))
    sinks.write_changes(stamped, out)
    back = spark.read.parquet(out)
    assert back.count() == 2 and {"schema_name", "table_name", "day"} <= set(back.columns)
    lines = sinks.dump_text(read).filter("event_type = 16").collect()[0].text
    assert lines.startswith("=== XIDEvent ===\nDate: 2023-11-14 22:13:20\n") and lines.endswith("XID: 99\n\n")


def test_custom_decoder(spark, folder):
    simple_log().write(folder / "bin.000001")

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(x) for x in b.column("images").to_pylist()]}, schema=pa.schema([("n", pa.int32())]))

    read = binlog.read_binlog(spark, str(folder))
    got = images.row_images(read, decoder=sizes, decoder_schema="n int").collect()
    assert [r.n for r in got] == [len(int_image(1, "a") + int_image(-2, None))]

def test_two_servers_and_a_closing_payload_in_one_stream(spark, folder):
    """Servers advance on their own; an event that needs no open map ends a batch."""
    a, b = folder.parent / "a", folder.parent / "b"
    aside = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    a.mkdir()
    b.mkdir()
    for k in range(1, 6):
        simple_log().write(a / f"bin.{k:06d}")
    log = simple_log()
    log.add(40, b"\x02\x01\x00\x00")
    log.write(b / "bin.000001")
    whole = binlog.read_binlog(spark, str(folder.parent)).groupBy("source", "event_type").count().collect()

    def run():
        stream = binlog.stream_binlog(spark, str(folder.parent)).select("source", "event_type", "start_pos")
        return feeds.drain(stream, "two", f"{aside}/out", f"{aside}/check")

    got = run().groupBy("source", "event_type").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole))
    simple_log().write(b / "bin.000002")
    assert run().filter("source = 'b'").count() == 9
    late = binlog.stream_binlog(spark, str(folder.parent), starting={"a": ("bin.000005", 4), "b": ("bin.000002", 4)})
    assert {(r.source, r.file) for r in feeds.drain(late.select("source", "file"), "late2").collect()} == {
        ("a", "bin.000005"),
        ("b", "bin.000002"),
    }


def test_checksums_are_tested_whatever_is_read(spark, folder):
    log = simple_log()
    log.data[-6] ^= 1
    log.write(folder / "bin.000001")
    with pytest.raises(Exception, match="checksum mismatch"):
        binlog.read_binlog(spark, str(folder), verify_checksum=True).select("event_type").collect()


def test_counts_of_previous_gtids_have_eight_bytes(spark, folder):
    n = 65_537
    spans = b"".join((3 * k + 1).to_bytes(8, "little") + (3 * k + 2).to_bytes(8, "little") for k in range(n))
    log = simple_log()
    log.add(35, (1).to_bytes(8, "little") + bytes(range(16)) + n.to_bytes(8, "little") + spans)
    log.write(folder / "bin.000001")
    got = events.events(binlog.read_binlog(spark, str(folder)), "previous_gtids")
    assert got.count() == n and got.agg({"stop": "max"}).first()[0] == 3 * n - 1


def test_damage_tells_what_is_left_out(spark, folder):
    log = simple_log()
    start = log.add(16, bytes(8))
    log.data[start + 9 : start + 13] = (3).to_bytes(4, "little")
    log.add(16, bytes(8))
    log.write(folder / "bin.000001")
    (bad,) = binlog.read_binlog(spark, str(folder), mode="PERMISSIVE").filter("error is not null").collect()
    assert bad.error.startswith("event size below header size; ") and bad.error.endswith(" bytes of the file left out")


def test_values_after_alter_table(spark, folder):
    """Each change is decoded by the definition it was written with."""

    def named(*names):
        return b"\x04" + lenenc(sum(len(text(n)) for n in names)) + b"".join(text(n) for n in names)

    log = Log()
    log.add(19, table_map(9, [3, 3], b"", optional=named("a", "b")))
    log.add(30, rows(9, 2, b"\x00" + struct.pack("<ii", 1, 2), [b"\x03"]))
    log.add(19, table_map(12, [3, 3, 15], b"\x20\x00", optional=named("x", "a", "b")))
    log.add(30, rows(12, 3, b"\x00" + struct.pack("<ii", 9, 3) + text("four"), [b"\x07"]))
    log.add(19, table_map(13, [3, 3], b"", optional=named("a", "b")))
    log.add(30, rows(13, 2, b"\x00" + struct.pack("<ii", 5, 6), [b"\x03"]))
    log.write(folder / "bin.000001")
    read = binlog.read_binlog(spark, str(folder))
    found = catalog.column_catalog(images.table_maps(read), [*events.LOG_KEY, "map_id", "schema_name", "table_name"])
    specs = images.table_specs(found, "d", "t")
    assert [[s.name for s in own] for own in specs.values()] == [["a", "b"], ["x", "a", "b"]]
    typed = images.typed_changes(images.row_changes(read), "d", "t", specs).orderBy("start_pos")
    got = [(r.after.a, r.after.b, r.after.x) for r in typed.collect()]
    assert got == [(1, "2", None), (3, "four", 9), (5, "6", None)]
    first = dict(list(specs.items())[:1])
    with pytest.raises(Exception, match="no definition given"):
        images.typed_changes(images.row_changes(read), "d", "t", first).select("after.a").collect()
