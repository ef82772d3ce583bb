"""Integers, bits and identifiers in BINARY columns.

Positions are 1-based as in SQL. ``reverse`` on BINARY is no way to change the
byte order (it reverses UTF-8 characters); it is applied to the hex text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

U64 = "decimal(20,0)"


def _c(value: int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def cut(col: Column, pos: int | Column, width: int | Column) -> Column:
    return F.substring(col, _c(pos), _c(width))


def hex_int(digits: Column) -> Column:
    """Unsigned value of up to 15 hex digits as BIGINT; NULL for no digits."""
    return F.conv(digits, 16, 10).cast("bigint")


# Byte order is reversed on the hex text by ``reverse``, which also swaps the
# two digits of each byte; swapping them back is plain bit arithmetic.
LOW_DIGITS = 0x0F0F0F0F0F0F0F0F


def _swap_digits(x: Column) -> Column:
    low = F.lit(LOW_DIGITS)
    return F.shiftleft(x.bitwiseAND(low), 4).bitwiseOR(F.shiftrightunsigned(x, 4).bitwiseAND(low))


def _number(bits: Column, width: int, signed: bool) -> Column:
    """64 bits read as signed, to the value of ``width`` bytes."""
    if width == 8:
        return bits if signed else F.pmod(bits.cast("decimal(21,0)"), F.lit(str(1 << 64)).cast("decimal(21,0)")).cast(U64)
    if not signed:
        return bits
    sign = F.lit(1 << (8 * width - 1)).cast("bigint")
    return bits.bitwiseXOR(sign) - sign


def _bits(digits: Column) -> Column:
    # A negative target base makes conv give 64 bits as signed.
    return F.conv(digits, 16, -10).cast("bigint")


def le_int(col: Column, pos: int | Column, width: int, signed: bool = False) -> Column:
    """Little-endian integer of 1-8 bytes; unsigned 8-byte values are DECIMAL(20,0)."""
    return _number(_swap_digits(_bits(F.reverse(F.hex(cut(col, pos, width))))), width, signed)


def be_int(col: Column, pos: int | Column, width: int, signed: bool = False) -> Column:
    return _number(_bits(F.hex(cut(col, pos, width))), width, signed)


def to_le(value: Column, width: int) -> Column:
    """The low ``width`` bytes of an integer, least significant first."""
    digits = F.reverse(F.lpad(F.hex(_swap_digits(value.cast("bigint"))), 16, "0"))
    return F.unhex(F.substring(digits, 1, 2 * width))


def to_be(value: Column, width: int) -> Column:
    digits = F.lpad(F.hex(value.cast("bigint")), 16, "0")
    return F.unhex(F.substring(digits, 17 - 2 * width, 2 * width))


def lenenc_int(col: Column, pos: int | Column) -> Column:
    """Length-encoded integer as ``struct<value, width>``; marker 0xfb and no input are NULL."""
    pos = _c(pos)
    head = be_int(col, pos, 1)
    value = (
        F.when(head < 0xFB, head.cast(U64))
        .when(head == 0xFC, le_int(col, pos + 1, 2).cast(U64))
        .when(head == 0xFD, le_int(col, pos + 1, 3).cast(U64))
        .when(head == 0xFE, le_int(col, pos + 1, 8))
    )
    width = (
        F.when(head.isNull(), 0)
        .when(head == 0xFC, 3)
        .when(head == 0xFD, 4)
        .when(head == 0xFE, 9)
        .otherwise(1)
    )
    return F.struct(value.alias("value"), width.alias("width"))


def to_lenenc(value: Column) -> Column:
    return (
        F.when(value < 0xFB, to_le(value, 1))
        .when(value < 1 << 16, F.concat(F.unhex(F.lit("FC")), to_le(value, 2)))
        .when(value < 1 << 24, F.concat(F.unhex(F.lit("FD")), to_le(value, 3)))
        .otherwise(F.concat(F.unhex(F.lit("FE")), to_le(value, 8)))
    )


def text(col: Column) -> Column:
    """UTF-8 text; bytes that are no UTF-8 become replacement characters."""
    return F.make_valid_utf8(col.cast("string"))


def uuid_text(col: Column) -> Column:
    """16 bytes as 8-4-4-4-12 lower-case hex."""
    h = F.lower(F.hex(col))
    return F.concat_ws(
        "-", *[F.substring(h, i, n) for i, n in [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]]
    )


def bit(col: Column, i: Column, msb_first: bool = False) -> Column:
    """Bit ``i`` of a bitmap; NULL beyond its end."""
    i = _c(i).cast("int")
    octet = hex_int(F.hex(F.substring(col, (F.floor(i / 8) + 1).cast("int"), F.lit(1))))
    return F.getbit(octet, 7 - i % 8 if msb_first else i % 8) == 1


def bits(col: Column, n: int | Column, msb_first: bool = False) -> Column:
    """The first ``n`` bits as ARRAY<BOOLEAN>."""
    n = _c(n).cast("int")
    every = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(every, lambda i: bit(col, i, msb_first))
