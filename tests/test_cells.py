"""Values of single cells against golden bytes of the log format."""

import struct

import pytest
from pyspark.sql import functions as F

from tidelog.functions import binary as bx
from tidelog.functions import cells, columns, temporal, text


def check(spark, cases, build):
    """cases: (hex bytes, expected); build: Column -> Column."""
    df = spark.createDataFrame([(i, bytes.fromhex(h)) for i, (h, _) in enumerate(cases)], "i int, d binary")
    got = {r["i"]: r["v"] for r in df.select("i", build(F.col("d")).alias("v")).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


@pytest.mark.parametrize(
    "fsp,cases",
    [
        (0, [("fef3ff7efb", "9999-12-31 23:59:59"), ("8000000000", "0000-00-00 00:00:00")]),
        (6, [("800382000001e240", "0001-01-01 00:00:00.123456")]),
        (3, [("80000000000c1c", "0000-00-00 00:00:00.310")]),
    ],
)
def test_datetime2(spark, fsp, cases):
    check(spark, cases, lambda d: cells.datetime2_text(d, fsp))


@pytest.mark.parametrize(
    "fsp,cases",
    [
        (0, [("b46efb", "838:59:59"), ("800000", "00:00:00"), ("7fffff", "-00:00:01"), ("4b9105", "-838:59:59")]),
        (2, [("7fffffff", "-00:00:00.01"), ("7fffff9d", "-00:00:00.99"), ("7fffff00", "-00:00:01"), ("7ffffef6", "-00:00:01.10"), ("80000001", "00:00:00.01")]),
        (4, [("7fffffffff", "-00:00:00.0001"), ("8000000001", "00:00:00.0001")]),
        (6, [("7fffffffffff", "-00:00:00.000001"), ("800000000001", "00:00:00.000001")]),
    ],
)
def test_time2(spark, fsp, cases):
    check(spark, cases, lambda d: cells.time2_text(d, fsp))


def packed(number: str, precision: int, scale: int) -> str:
    """Independent encoder: digits in groups of nine around the point."""
    sizes = [0, 1, 1, 2, 2, 3, 3, 4, 4, 4]
    negative = number.startswith("-")
    whole, _, frac = number.lstrip("-").partition(".")
    whole, frac = whole.zfill(precision - scale), frac.ljust(scale, "0")
    if precision == scale:
        whole = ""
    lead = len(whole) % 9
    parts = ([whole[:lead]] if lead else []) + [whole[i : i + 9] for i in range(lead, len(whole), 9)]
    parts += [frac[i : i + 9] for i in range(0, len(frac), 9)]
    data = bytearray(b"".join(int(p).to_bytes(sizes[len(p)], "big") for p in parts))
    data[0] ^= 0x80
    return (bytes(b ^ 0xFF for b in data) if negative else bytes(data)).hex()


@pytest.mark.parametrize(
    "precision,scale,numbers",
    [
        (4, 2, ["-10.55", "0.01", "99.99", "0.00"]),
        (5, 0, ["-11", "0", "99999"]),
        (15, 14, ["-9.99999999999999", "0.01234567890123"]),
        (20, 10, ["-10.5500000000", "1234567890.0123456789"]),
        (30, 5, ["-10.55000", "1234567890123456789012345.12345"]),
        (30, 25, ["-10.5500000000000000000000000", "0.0000000000000000000000001"]),
        (65, 30, ["-" + "9" * 35 + "." + "9" * 30, "1." + "0" * 30]),
        (2, 2, ["0.25", "-0.01"]),
        (9, 9, ["0.123456789"]),
    ],
)
def test_decimal(spark, precision, scale, numbers):
    cases = [(packed(n, precision, scale), n) for n in numbers]
    check(spark, cases, lambda d: cells.decimal_text(d, precision, scale))


def test_known_decimal_bytes(spark):
    check(spark, [("75c8", "-10.55"), ("800a37", "10.55")], lambda d: F.when(F.length(d) == 2, cells.decimal_text(d, 4, 2)).otherwise(cells.decimal_text(d, 5, 2)))


def test_floats(spark):
    values = [0.0, 1.5, -2.25, 1e-310, 5e-324, 1.7976931348623157e308, 3.141592653589793, float("inf"), float("-inf")]
    check(spark, [(struct.pack("<d", v).hex(), v) for v in values], cells.double_value)
    small = [0.0, 1.5, -2.25, 1e-45, 3.4028234663852886e38]
    want = [struct.unpack("<f", struct.pack("<f", v))[0] for v in small]
    check(spark, [(struct.pack("<f", v).hex(), w) for v, w in zip(small, want)], cells.float_value)


def test_old_temporal(spark):
    check(spark, [((2000 * 512 + 5 * 32 + 9).to_bytes(3, "little").hex(), "2000-05-09"), ("000000", "0000-00-00")], cells.date_text)
    check(spark, [((123456).to_bytes(3, "little").hex(), "12:34:56"), ("000000", "00:00:00")], cells.time_text)
    check(spark, [((20240131235959).to_bytes(8, "little").hex(), "2024-01-31 23:59:59"), ("00" * 8, "0000-00-00 00:00:00")], cells.datetime_text)
    check(spark, [("00", 0), ("01", 1901), ("ff", 2155)], cells.year_value)
    check(spark, [("00000000", "0000-00-00 00:00:00"), ((86400).to_bytes(4, "little").hex(), "1970-01-02 00:00:00")], cells.timestamp_text)
    check(spark, [("00000000000000", "0000-00-00 00:00:00.000"), ((86400).to_bytes(4, "big").hex() + "04d2", "1970-01-02 00:00:00.123")], lambda d: cells.timestamp2_text(d, 3))


def test_zero_time_is_cut_not_rounded(spark):
    row = spark.range(1).select(temporal.zero_time(F.lit(123999), 3).alias("a"), temporal.zero_time(F.lit(5), 0).alias("b")).collect()[0]
    assert tuple(row) == ("0000-00-00 00:00:00.123", "0000-00-00 00:00:00")


def test_bits_and_sets(spark):
    check(spark, [("0102030405", 0x0102030405), ("ff", 255)], lambda d: cells.bit_value(d).cast("bigint"))
    check(spark, [("010203", 0x030201)], lambda d: cells.set_mask(d, 3))


def test_length_encoded(spark):
    cases = [("fa", (250, 1)), ("fb", (None, 1)), ("fc0102", (0x0201, 3)), ("fd010203", (0x030201, 4)), ("fe0100000000000080", (2**63 + 1, 9)), ("", (None, 0))]
    check(spark, [(h, w) for h, w in cases], lambda d: F.struct(bx.lenenc_int(d, 1)["value"], bx.lenenc_int(d, 1)["width"]))


def test_unsigned_and_labels(spark):
    labels = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    row = spark.range(1).select(
        columns.fix_unsigned(F.lit(-1), F.lit(1), F.lit(True)).alias("u8"),
        columns.fix_unsigned(F.lit(-1).cast("bigint"), F.lit(8), F.lit(True)).alias("u64"),
        columns.enum_label(F.lit(3), labels).alias("last"),
        columns.enum_label(F.lit(0), labels).alias("invalid"),
        columns.set_labels(F.lit(5), labels).alias("set"),
    ).collect()[0]
    assert (int(row.u8), int(row.u64), row.last, row.invalid, row.set) == (255, 2**64 - 1, "c", None, ["a", "c"])


def test_versions_and_messages(spark):
    pairs = [("1.2.3", "1.2.3", 0), ("5.6-999", "8.0", -1), ("8.0.32-0ubuntu0.20.04.2", "8.0.28", 1), ("8.0.28-x", "8.0.28", -1)]
    df = spark.createDataFrame(pairs, "a string, b string, want int")
    assert df.filter(text.compare_versions(F.col("a"), F.col("b")) != F.col("want")).count() == 0
    msgs = [("ERROR 1094 (HY000): Unknown thread id: 42", 1094), ("", 0), ("ERROR", 0), ("no code here", 0)]
    df = spark.createDataFrame(msgs, "m string, want int")
    assert df.filter(text.error_code(F.col("m")) != F.col("want")).count() == 0
    row = spark.createDataFrame([("a'b\"c\\d\n\r\t\0\x1a\bé",)], "s string").select(text.sql_escape(F.col("s"))).collect()[0][0]
    assert row == "a\\'b\\\"c\\\\d\\n\\r\\t\\0\\Z\\bé"
