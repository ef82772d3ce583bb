"""Images cut in vectors against the event-wise walk, damaged events included."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidelog.functions import columns as ct
from tidelog.operators import events, images, rowbatch, rowcodec
from tidelog.sources import binlog

KEYS = ["id"]


def table_map(columns, name=b"t"):
    types = bytes(t for t, _ in columns)
    metas = b"".join(
        m.to_bytes(rowcodec.META_BYTES.get(t, 0), "big" if t in rowcodec.BIG_ENDIAN_META else "little") for t, m in columns
    )
    n = len(columns)
    return (
        (7).to_bytes(6, "little") + b"\1\0" + b"\2db\0" + bytes([len(name)]) + name + b"\0"
        + bytes([n]) + types + bytes([len(metas)]) + metas + bytes((n + 7) // 8)
    )


LAYOUTS = {
    "fixed": [(ct.LONG, 0), (ct.TINY, 0), (ct.LONGLONG, 0), (ct.NEWDECIMAL, 12 * 256 + 2), (ct.DATETIME2, 0)],
    "mixed": [(ct.LONG, 0), (ct.VARCHAR, 60), (ct.VARCHAR, 300), (ct.BLOB, 2), (ct.JSON, 4), (ct.STRING, 247 * 256 + 1)],
    "wide": [(ct.SHORT, 0)] * 11,
}
DOC = bytes.fromhex("00" + "0100" + "0C00" + "0B00" + "0100" + "05") + b"\x07\x00" + b"k"


def image(some, columns, present, nulls):
    bits, out = 0, b""
    for k, i in enumerate(present):
        if some.random() < nulls:
            bits |= 1 << k
            continue
        size, prefix = rowcodec.cell_layout(*columns[i])
        if columns[i][0] == ct.JSON:
            out += len(DOC).to_bytes(4, "little") + DOC[:-3] + bytes([some.randrange(5)]) + DOC[-2:]
        elif prefix:
            size = some.choice([0, 1, 5, 40])
            out += size.to_bytes(prefix, "little") + some.randbytes(size)
        else:
            out += some.randbytes(size)
    return bits.to_bytes((len(present) + 7) // 8, "little") + out


def bitmap(present, n):
    return sum(1 << i for i in present).to_bytes((n + 7) // 8, "little")


def made(seed, layout, tp, count, nulls, damage):
    """Rows of ``rows_header`` as an Arrow batch."""
    some, columns = random.Random(seed), LAYOUTS[layout]
    n = len(columns)
    present1 = list(range(n)) if seed % 2 else sorted(some.sample(range(n), n - 1))
    present2 = present1 if tp == 21 else sorted(some.sample(range(n), 2))
    rows = []
    for k in range(count):
        data = b""
        for _ in range(some.choice([0, 1, 3, 30])):
            data += image(some, columns, present1, nulls)
            if tp in rowcodec.PAIRS:
                data += image(some, columns, present2, nulls)
        if data and some.random() < damage:
            data = data[: some.randrange(len(data))] if some.random() < 0.7 else data + some.randbytes(3)
        rows.append((k, tp, 6, n, bitmap(present1, n), bitmap(present2, n) if tp in rowcodec.TWO_BITMAPS else None, data, table_map(columns)))
    names = ["id", "event_type", "table_id_size", "n_cols", "present1", "present2", "images", "table_map"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def schema():
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType([T.StructField("id", T.LongType()), *T.StructType.fromDDL(images.CHANGE_FIELDS).fields]))


@pytest.mark.parametrize("tp", [21, 23, 24, 25, 30, 31, 32])
@pytest.mark.parametrize("layout", LAYOUTS)
def test_vectors_equal_the_event_wise_walk(spark, layout, tp):
    arrow, names = schema(), [f.name for f in schema()]
    for seed, (count, nulls, damage) in enumerate([(40, 0, 0), (40, 0.3, 0), (40, 0.2, 0.4), (5, 0.1, 0.1), (4, 0, 0)], tp):
        # Sliced, so that buffers do not begin at the batch.
        batch = made(seed, layout, tp, count + 3, nulls, damage).slice(2)
        got, single = [], []
        for part in images.together(batch, 1, np.arange(len(batch)), arrow, False):
            if isinstance(part, pa.RecordBatch):
                got += [tuple(r[n] for n in names) for r in part.to_pylist()]
            else:
                single += part.tolist()
        want = []
        for k in range(len(batch)):
            row = tuple(batch.column(c)[k].as_py() for c in range(1, 8))
            own = [(batch.column(0)[k].as_py(), *c) for c in images.event_changes(row, False)]
            if k not in single:
                want += own
            assert bool(own and own[-1][-1]) == (k in single)
        assert got == want
        assert damage or not single


def test_fixed_images_are_not_walked(monkeypatch):
    batch = made(1, "fixed", 30, 20, 0, 0)
    monkeypatch.setattr(rowbatch.Side, "walk", None)
    monkeypatch.setattr(rowbatch.Side, "step", None)
    parts = list(images.together(batch, 1, np.arange(len(batch)), schema(), False))
    assert sum(p.num_rows for p in parts) > 20


def test_chunks_bound_the_bytes_cut_at_once():
    sizes = np.array([5, 5, 100, 1, 1, 1])
    parts = rowbatch.chunks(sizes, 10)
    assert np.concatenate(parts).tolist() == list(range(6)) and all(sizes[p].sum() <= 110 for p in parts)


def test_table_filter(spark):
    sf = "/root/testdata/sf0.001"
    from tidelog.plans.archive import archive

    log = binlog.read_binlog(spark, archive(spark, sf), event_types=events.ROWS)
    every = images.row_changes(log).count()
    assert images.row_changes(log, tables=[("shop", "orders"), ("shop", "x")]).count() == every > 0
    assert images.row_changes(log, tables=[("shop", "order"), ("sho", "orders")]).count() == 0
    assert images.row_changes(log, tables=[]).count() == 0


def test_files_are_dealt_evenly():
    slices = [(binlog.FileSlice(f"f{i}", 4), size) for i, size in enumerate([50, 10, 10, 10, 10, 10, 0])]
    sizes = {s.path: n for s, n in slices}
    groups = binlog.grouped(slices, 1 << 20, 2)
    assert sorted(sum(sizes[s.path] for s in g.slices) for g in groups) == [50, 50]
    assert len(binlog.grouped(slices, 25, 1)) == 4 and len(binlog.grouped(slices, 1 << 20, 99)) == 7
    assert binlog.grouped([], 10, 8) == []


def test_updates_of_version_0_come_in_pairs(spark):
    columns = [(ct.TINY, 0), (ct.TINY, 0)]
    tm = table_map(columns)
    data = b"\x00\x01\x02" + b"\x00\x01\x03" + b"\x02\x05" + b"\x00\x05\x07"
    row = (21, 6, 2, b"\x03", None, data, tm)
    got = [c[2:6] for c in images.event_changes(row, False)]
    assert got == [(0, "U", [b"\x01", b"\x02"], [b"\x01", b"\x03"]), (1, "U", [b"\x05", None], [b"\x05", b"\x07"])]
