"""Encoders that turn table rows into event bytes (fixtures for the decoders)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.binary import to_be, to_le, to_lenenc


def raw(hex_text: str) -> Column:
    return F.unhex(F.lit(hex_text))


def utf8(col: Column) -> Column:
    return F.encode(col, "UTF-8")


def uuid_bytes(sid: Column) -> Column:
    return F.unhex(F.replace(sid, F.lit("-"), F.lit("")))


def frame(
    event_type: Column, body: Column, ts: Column, server_id: Column, start_pos: Column, flags: Column,
    checksum: bool = True,
) -> Column:
    """Header and body of an event, sized for a checksum to follow. ``ts`` is in seconds."""
    size = F.length(body) + 19 + (4 if checksum else 0)
    return F.concat(
        to_le(ts, 4), to_le(event_type, 1), to_le(server_id, 4), to_le(size, 4),
        to_le(start_pos + size, 4), to_le(flags, 2), body,
    )


def with_crc(head: Column) -> Column:
    return F.concat(head, to_le(F.crc32(head), 4))


def decimal_cell(unscaled: Column, precision: int, scale: int) -> Column:
    """NEWDECIMAL bytes of an integer that counts units of 10^-scale (|value| < 10^18)."""
    digit_bytes = [0, 1, 1, 2, 2, 3, 3, 4, 4, 4]
    magnitude = F.abs(unscaled)
    whole = F.floor(magnitude / F.lit(10**scale)).cast("bigint")
    frac = magnitude % F.lit(10**scale)
    groups, lead = divmod(precision - scale, 9)
    fgroups, tail = divmod(scale, 9)
    parts = []
    if lead:
        parts.append(to_be(F.floor(whole / F.lit(10 ** (9 * groups))).cast("bigint"), digit_bytes[lead]))
    for g in reversed(range(groups)):
        parts.append(to_be(F.floor(whole / F.lit(10 ** (9 * g))).cast("bigint") % 10**9, 4))
    for g in range(fgroups):
        parts.append(to_be(F.floor(frac / F.lit(10 ** (scale - 9 * (g + 1)))).cast("bigint") % 10**9, 4))
    if tail:
        parts.append(to_be(frac % 10**tail, digit_bytes[tail]))
    plain = F.hex(F.concat(*parts))
    flipped = F.concat(
        F.translate(F.substring(plain, 1, 1), "01234567", "89ABCDEF"), F.substring(plain, F.lit(2), F.length(plain))
    )
    inverted = F.translate(flipped, "0123456789ABCDEF", "FEDCBA9876543210")
    return F.unhex(F.when(unscaled < 0, inverted).otherwise(flipped))


def datetime2_cell(ts: Column, fsp: int = 0) -> Column:
    """DATETIME(fsp) bytes of a wall-clock timestamp."""
    ym = F.year(ts) * 13 + F.month(ts)
    ymd = (ym * 32 + F.dayofmonth(ts)).cast("bigint")
    hms = F.hour(ts) * 4096 + F.minute(ts) * 64 + F.second(ts)
    packed = to_be(ymd * (1 << 17) + hms + 0x8000000000, 5)
    if not fsp:
        return packed
    micros = F.date_format(ts, "SSSSSS").cast("bigint")
    n = (fsp + 1) // 2
    return F.concat(packed, to_be(F.floor(micros / 10 ** (6 - 2 * n)).cast("bigint"), n))


def lenenc_text(col: Column) -> Column:
    return F.concat(to_lenenc(F.octet_length(col)), utf8(col))


def short_text(col: Column) -> Column:
    """String with a 1-byte length in front."""
    return F.concat(to_le(F.octet_length(col), 1), utf8(col))
