"""Typed values out of single column cells (BINARY) of a row image.

``meta`` arguments (precision, scale, fsp, ...) may be numbers or columns; with
numbers Catalyst folds the branches that cannot occur.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.binary import _c, be_int, hex_int, le_int
from tidelog.functions.temporal import frac_text, render_time, zero_time

HEX, INVERTED = "0123456789ABCDEF", "FEDCBA9876543210"
# Bytes that hold 0..9 left-over decimal digits (fixed values of the format).
DIGIT_BYTES = [0, 1, 1, 2, 2, 3, 3, 4, 4, 4]


def _idiv(a: Column, n: int) -> Column:
    return F.floor(a / n).cast("bigint")


def decimal_text(cell: Column, precision: int, scale: int) -> Column:
    """Exact decimal text, trailing zeros kept.

    Digits are stored in groups of nine (4 bytes) around the point, the
    left-over digits in fewer bytes; negative values have all bits inverted and
    the first bit tells the sign.
    """
    groups, lead = divmod(precision - scale, 9)
    fgroups, tail = divmod(scale, 9)
    raw = F.hex(cell)
    negative = F.substring(raw, 1, 1) < "8"
    body = F.when(negative, F.translate(raw, HEX, INVERTED)).otherwise(raw)
    parts, at = [], 1
    plan = ([lead] if lead else []) + [9] * (groups + fgroups) + ([tail] if tail else [])
    for n in plan:
        width = 2 * DIGIT_BYTES[n]
        digits = F.substring(body, at, width)
        if at == 1:
            # The sign bit is set by now in either case; drop it.
            first = F.translate(F.substring(digits, 1, 1), "89ABCDEF", "01234567")
            digits = F.concat(first, F.substring(digits, 2, width - 1))
        parts.append(F.lpad(F.conv(digits, 16, 10), n, "0"))
        at += width
    digits = F.concat(*parts)
    shown = F.regexp_replace(digits, rf"^0*(\d*?)(\d{{{scale}}})$", "$1.$2") if scale else F.ltrim(digits, F.lit("0"))
    # A value below one has no digit left in front of the point.
    shown = F.regexp_replace(shown, r"^(?=\.|$)", "0")
    return F.when(negative, F.concat(F.lit("-"), shown)).otherwise(shown)


def bit_value(cell: Column) -> Column:
    """BIT(n): big-endian, any width up to 8 bytes."""
    return F.conv(F.hex(cell), 16, 10).cast("decimal(20,0)")


def set_mask(cell: Column, width: int) -> Column:
    """SET: little-endian mask of ``width`` bytes."""
    return le_int(cell, 1, width, signed=width == 8)


def frac_micros(cell: Column, skip: int, fsp: Column) -> Column:
    """Microseconds of the (fsp+1)/2 fraction bytes after ``skip`` bytes."""
    n = _idiv(fsp + 1, 2)
    raw = F.coalesce(hex_int(F.hex(F.substring(cell, F.lit(skip + 1), n.cast("int")))), F.lit(0))
    return F.when(n == 1, raw * 10000).when(n == 2, raw * 100).otherwise(raw)


def _clock(h: Column, m: Column, s: Column) -> Column:
    return F.format_string("%02d:%02d:%02d", h, m, s)


def _calendar(y: Column, m: Column, d: Column) -> Column:
    return F.format_string("%04d-%02d-%02d", y, m, d)


def datetime2_text(cell: Column, fsp: int | Column = 0) -> Column:
    """DATETIME(fsp) wall clock text; zero dates come out as zeros."""
    fsp = _c(fsp)
    packed = F.abs(be_int(cell, 1, 5) - 0x8000000000)
    ymd, hms = F.shiftright(packed, 17), packed.bitwiseAND((1 << 17) - 1)
    ym = F.shiftright(ymd, 5)
    date = _calendar(_idiv(ym, 13), ym % 13, ymd.bitwiseAND(31))
    time = _clock(F.shiftright(hms, 12), F.shiftright(hms, 6).bitwiseAND(63), hms.bitwiseAND(63))
    return F.concat(date, F.lit(" "), time, frac_text(frac_micros(cell, 5, fsp), fsp))


def time2_text(cell: Column, fsp: int | Column = 0) -> Column:
    """TIME(fsp), signed, hours up to 838; a zero fraction is not shown.

    The cell is one fixed-point number with a bias, so negative values need no
    special treatment of their fraction bytes.
    """
    fsp = _c(fsp)
    n = _idiv(fsp + 1, 2).cast("int")
    scale = F.element_at(F.array(*[F.lit(1 << (8 * i)).cast("bigint") for i in range(4)]), n + 1)
    value = hex_int(F.hex(F.substring(cell, F.lit(1), 3 + n))) - scale * 0x800000
    size = F.abs(value)
    hms, rest = _idiv_col(size, scale), size % scale
    micros = F.when(n == 1, rest * 10000).when(n == 2, rest * 100).otherwise(rest)
    clock = _clock(
        F.shiftright(hms, 12).bitwiseAND(1023),
        F.shiftright(hms, 6).bitwiseAND(63),
        hms.bitwiseAND(63),
    )
    sign = F.when(value < 0, "-").otherwise("")
    return F.concat(sign, clock, F.when(micros != 0, frac_text(micros, fsp)).otherwise(""))


def _idiv_col(a: Column, b: Column) -> Column:
    return ((a - a % b) / b).cast("bigint")


def timestamp2_micros(cell: Column, fsp: int | Column = 0) -> Column:
    """TIMESTAMP(fsp) as microseconds since the epoch; NULL for the zero value."""
    fsp = _c(fsp)
    sec = be_int(cell, 1, 4)
    return F.when(sec != 0, sec * 1000000 + frac_micros(cell, 4, fsp))


def timestamp2_text(cell: Column, fsp: int | Column = 0, tz: str = "UTC") -> Column:
    fsp = _c(fsp)
    at = timestamp2_micros(cell, fsp)
    return F.coalesce(
        render_time(F.timestamp_micros(at), fsp, tz), zero_time(frac_micros(cell, 4, fsp), fsp)
    )


def timestamp_text(cell: Column, tz: str = "UTC") -> Column:
    """Old TIMESTAMP: 4 bytes, little-endian seconds."""
    sec = le_int(cell, 1, 4)
    shown = render_time(F.timestamp_seconds(F.nullif(sec, F.lit(0))), F.lit(0), tz)
    return F.coalesce(shown, zero_time(F.lit(0), F.lit(0)))


def date_text(cell: Column) -> Column:
    """DATE: day in 5 bits, month in 4, then the year."""
    v = le_int(cell, 1, 3)
    return _calendar(F.shiftright(v, 9), F.shiftright(v, 5).bitwiseAND(15), v.bitwiseAND(31))


def time_text(cell: Column) -> Column:
    """Old TIME: decimal digits HHMMSS."""
    v = le_int(cell, 1, 3)
    return _clock(_idiv(v, 10000), _idiv(v % 10000, 100), v % 100)


def datetime_text(cell: Column) -> Column:
    """Old DATETIME: decimal digits YYYYMMDDHHMMSS in 8 bytes."""
    v = le_int(cell, 1, 8, signed=True)
    day, clock = _idiv(v, 1000000), v % 1000000
    return F.concat_ws(
        " ",
        _calendar(_idiv(day, 10000), _idiv(day % 10000, 100), day % 100),
        _clock(_idiv(clock, 10000), _idiv(clock % 10000, 100), clock % 100),
    )


def year_value(cell: Column) -> Column:
    v = be_int(cell, 1, 1)
    return F.when(v == 0, v).otherwise(v + 1900)


def _ieee(bits: Column, exponent_bits: int, mantissa_bits: int) -> Column:
    """IEEE-754 value of its bits; powers of two are exact, so is the product."""
    top = 1 << exponent_bits
    mantissa = bits.bitwiseAND((1 << mantissa_bits) - 1)
    exponent = F.shiftright(bits, mantissa_bits).bitwiseAND(top - 1)
    sign = F.when(F.getbit(bits, F.lit(exponent_bits + mantissa_bits)) == 1, -1.0).otherwise(1.0)
    bias = (top >> 1) - 1 + mantissa_bits
    normal = (mantissa + (1 << mantissa_bits)) * F.pow(F.lit(2.0), exponent - bias)
    tiny = mantissa * F.pow(F.lit(2.0), F.lit(1 - bias))
    special = F.when(mantissa == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return sign * F.when(exponent == top - 1, special).when(exponent == 0, tiny).otherwise(normal)


def double_value(cell: Column) -> Column:
    return _ieee(le_int(cell, 1, 8, signed=True), 11, 52)


def float_value(cell: Column) -> Column:
    return _ieee(le_int(cell, 1, 4), 8, 23).cast("float")
