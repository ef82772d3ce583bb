"""Helpers the Arrow jobs of ``images`` call per event: where cells begin and end.

Only what has a length that must be walked is handled here (row images, table
map metadata, JSON documents). Values of the cells are decoded afterwards by
the native expressions in ``functions.cells``.
"""

from __future__ import annotations

import decimal
import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

from tidelog.functions import columns as ct

DIGIT_BYTES = (0, 1, 1, 2, 2, 3, 3, 4, 4, 4)
# Bytes of types with one size (fixed values of the format).
FIXED = {
    ct.NULL: 0, ct.TINY: 1, ct.YEAR: 1, ct.SHORT: 2, ct.INT24: 3, ct.DATE: 3, ct.TIME: 3,
    ct.LONG: 4, ct.FLOAT: 4, ct.TIMESTAMP: 4, ct.LONGLONG: 8, ct.DOUBLE: 8, ct.DATETIME: 8,
}
META_BYTES = {
    **dict.fromkeys((ct.STRING, ct.NEWDECIMAL, ct.VAR_STRING, ct.VARCHAR, ct.BIT), 2),
    **dict.fromkeys((ct.BLOB, ct.DOUBLE, ct.FLOAT, ct.GEOMETRY, ct.JSON), 1),
    **dict.fromkeys((ct.TIME2, ct.DATETIME2, ct.TIMESTAMP2), 1),
}
BIG_ENDIAN_META = (ct.STRING, ct.NEWDECIMAL)
NOT_IN_LOGS = (ct.NEWDATE, ct.ENUM, ct.SET, ct.TINY_BLOB, ct.MEDIUM_BLOB, ct.LONG_BLOB)

UPDATES = {21, 24, 31, 39, 167}
TWO_BITMAPS = {24, 31, 39, 167}
# Updates whose images come in pairs; those of version 0 share one bitmap.
PAIRS = TWO_BITMAPS | {21}
DELETES = {22, 25, 32, 168}
PARTIAL_UPDATE = 39


def lenenc(data: bytes, at: int) -> tuple[int | None, int]:
    """(value, next position) of a length-encoded integer; None for the NULL marker."""
    if at >= len(data):
        return None, at
    head = data[at]
    if head < 0xFB:
        return head, at + 1
    width = {0xFC: 2, 0xFD: 3, 0xFE: 8}.get(head, 0)
    if not width:
        return None, at + 1
    if at + 1 + width > len(data):
        raise ValueError("length-encoded integer cut short")
    return int.from_bytes(data[at + 1 : at + 1 + width], "little"), at + 1 + width


def _lenenc_list(data: bytes) -> list[int]:
    out, at = [], 0
    while at < len(data):
        value, at = lenenc(data, at)
        out.append(value)
    return out


def _texts(data: bytes, at: int, n: int | None) -> tuple[list[str], int]:
    out: list[str] = []
    while at < len(data) and (n is None or len(out) < n):
        size, at = lenenc(data, at)
        if at + size > len(data):
            raise ValueError("string cut short")
        out.append(data[at : at + size].decode("utf-8", "replace"))
        at += size
    return out, at


def _label_lists(data: bytes) -> list[list[str]]:
    out, at = [], 0
    while at < len(data):
        n, at = lenenc(data, at)
        labels, at = _texts(data, at, n)
        out.append(labels)
    return out


@dataclass
class TableMap:
    table_id: int
    flags: int
    schema: str
    table: str
    types: list[int]
    metas: list[int]
    null_bitmap: bytes
    lists: dict[str, object] = field(default_factory=dict)
    layout: list[tuple[int, int]] = field(default_factory=list)


def _prefixes(data: bytes) -> dict[str, object]:
    flat = _lenenc_list(data)
    return {"pk": flat[::2], "pk_prefix": flat[1::2]}


def _default_charset(data: bytes) -> list[int]:
    flat = _lenenc_list(data)
    if len(flat) % 2 != 1:
        raise ValueError("default charset list has an even length")
    return flat


# Optional metadata by field type (fixed values of the format).
OPTIONAL = {
    1: lambda d: {"signedness": d},
    2: lambda d: {"default_charset": _default_charset(d)},
    3: lambda d: {"column_charset": _lenenc_list(d)},
    4: lambda d: {"column_names": _texts(d, 0, None)[0]},
    5: lambda d: {"set_values": _label_lists(d)},
    6: lambda d: {"enum_values": _label_lists(d)},
    7: lambda d: {"geometry_types": _lenenc_list(d)},
    8: lambda d: {"pk": _lenenc_list(d), "pk_prefix": [0] * len(_lenenc_list(d))},
    9: _prefixes,
    10: lambda d: {"enum_set_default_charset": _default_charset(d)},
    11: lambda d: {"enum_set_column_charset": _lenenc_list(d)},
}


def cell_layout(tp: int, meta: int) -> tuple[int, int]:
    """(fixed size, 0) or (0, bytes of the length prefix) of a column's cells."""
    if tp == ct.STRING:
        if meta < 256:
            return 0, 1
        b0, b1 = meta >> 8, meta & 0xFF
        if b0 & 0x30 != 0x30:
            return 0, 2 if b1 | ((b0 & 0x30 ^ 0x30) << 4) > 255 else 1
        if b0 in (ct.ENUM, ct.SET):
            return b1, 0
        return 0, 1
    if tp in FIXED:
        return FIXED[tp], 0
    if tp == ct.NEWDECIMAL:
        whole, scale = (meta >> 8) - (meta & 0xFF), meta & 0xFF
        size = 4 * (whole // 9) + DIGIT_BYTES[whole % 9]
        return size + 4 * (scale // 9) + DIGIT_BYTES[scale % 9], 0
    if tp == ct.BIT:
        return ((meta >> 8) * 8 + (meta & 0xFF) + 7) // 8, 0
    if tp in (ct.TIMESTAMP2, ct.DATETIME2, ct.TIME2):
        return {ct.TIMESTAMP2: 4, ct.DATETIME2: 5, ct.TIME2: 3}[tp] + (meta + 1) // 2, 0
    if tp in (ct.VARCHAR, ct.VAR_STRING):
        return 0, 1 if meta < 256 else 2
    if tp in (ct.BLOB, ct.GEOMETRY, ct.JSON):
        return 0, meta
    raise ValueError(f"column type {tp} cannot be in a row image")


@lru_cache(maxsize=4096)
def parse_table_map(body: bytes, id_size: int) -> TableMap:
    """Same statement, same bytes: a worker parses each distinct map once."""
    at = id_size + 2
    names = []
    for _ in range(2):
        size = body[at]
        names.append(body[at + 1 : at + 1 + size].decode("utf-8", "replace"))
        at += size + 2
    n, at = lenenc(body, at)
    types = list(body[at : at + n])
    at += n
    meta_size, at = lenenc(body, at)
    meta_end = at + (meta_size or 0)
    metas = []
    for tp in types:
        if tp in NOT_IN_LOGS:
            raise ValueError(f"unsupported column type {tp} in a table map")
        width = META_BYTES.get(tp, 0)
        order = "big" if tp in BIG_ENDIAN_META else "little"
        metas.append(int.from_bytes(body[at : at + width], order))
        at += width
    at = meta_end
    null_bytes = (n + 7) // 8
    if at + null_bytes > len(body):
        raise ValueError("table map ends inside its null bitmap")
    found = TableMap(
        int.from_bytes(body[:id_size], "little"),
        int.from_bytes(body[id_size : id_size + 2], "little"),
        names[0],
        names[1],
        types,
        metas,
        body[at : at + null_bytes],
    )
    at += null_bytes
    while at < len(body):
        kind = body[at]
        size, at = lenenc(body, at + 1)
        if kind in OPTIONAL:
            found.lists.update(OPTIONAL[kind](body[at : at + size]))
        at += size
    found.layout = [cell_layout(t, m) for t, m in zip(types, metas)]
    return found


def bit_positions(bitmap: bytes, n: int) -> list[int]:
    return [i for i in range(n) if bitmap[i >> 3] >> (i & 7) & 1]


class ImageWalker:
    """Cuts the images of rows events into cells."""

    def __init__(self, tm: TableMap, event_type: int, n_cols: int, ignore_json_errors: bool = False):
        if n_cols > len(tm.types):
            raise ValueError("row image has more columns than its table map")
        self.tm, self.event_type, self.n_cols = tm, event_type, n_cols
        self.ignore = ignore_json_errors
        self.json_cols = [i for i in range(n_cols) if tm.types[i] == ct.JSON]

    def image(self, data: bytes, at: int, present: list[int], after: bool):
        """(cells by ordinal, ordinals holding JSON diffs, next position)."""
        partial: set[int] = set()
        if self.event_type == PARTIAL_UPDATE and after:
            options, at = lenenc(data, at)
            if options & 1:
                size = (len(self.json_cols) + 7) // 8
                marked = bit_positions(data[at : at + size], len(self.json_cols))
                partial = {self.json_cols[i] for i in marked}
                at += size
        nulls = at
        at += (len(present) + 7) // 8
        if at > len(data):
            raise ValueError("row image ends inside its null bitmap")
        cells: list[bytes | None] = [None] * self.n_cols
        layout, types = self.tm.layout, self.tm.types
        for k, i in enumerate(present):
            if data[nulls + (k >> 3)] >> (k & 7) & 1:
                continue
            size, prefix = layout[i]
            if prefix:
                size = int.from_bytes(data[at : at + prefix], "little")
                at += prefix
            end = at + size
            if end > len(data):
                raise ValueError("row image cut short")
            cell = data[at:end]
            if types[i] == ct.JSON and cell:
                cell = self.json_cell(cell, i in partial)
            cells[i] = cell
            at = end
        return cells, sorted(partial & set(present)), at

    def json_cell(self, cell: bytes, partial: bool) -> bytes | None:
        try:
            value = json_diffs(cell) if partial else json_value(cell)
        except (ValueError, IndexError, struct.error):
            if self.ignore:
                return None
            raise
        return dump_json(value)

    def changes(self, data: bytes, present1: list[int], present2: list[int]) -> Iterator[tuple]:
        """(before cells, after cells, diff ordinals) of each change in the event."""
        at, update = 0, self.event_type in PAIRS
        first_is_before = update or self.event_type in DELETES or self.event_type in UPDATES
        while at < len(data):
            started = at
            first, _, at = self.image(data, at, present1, False)
            second, diffs = None, []
            if update:
                second, diffs, at = self.image(data, at, present2, True)
            if at == started:
                raise ValueError("row image without any bytes")
            if first_is_before:
                yield first, second, diffs
            else:
                yield None, first, diffs


# -- JSON documents in binary form ---------------------------------------------

SMALL_OBJECT, LARGE_OBJECT, SMALL_ARRAY, LARGE_ARRAY, LITERAL = 0, 1, 2, 3, 4
STRING_TYPE, OPAQUE = 12, 15
# Number types: struct formats (fixed values of the format).
NUMBERS = {5: "<h", 6: "<H", 7: "<i", 8: "<I", 9: "<q", 10: "<Q", 11: "<d"}
LITERALS = {0: None, 1: True, 2: False}


_dump = json.JSONEncoder(ensure_ascii=False, separators=(",", ":"), sort_keys=True).encode


def dump_json(value) -> bytes:
    return _dump(value).encode()


def json_value(doc: bytes):
    return _node(doc[0], doc, 1)


def _varlen(doc: bytes, at: int) -> tuple[int, int]:
    size = 0
    for i in range(5):
        byte = doc[at + i]
        size |= (byte & 0x7F) << (7 * i)
        if not byte & 0x80:
            return size, at + i + 1
    raise ValueError("bad JSON length")


def _node(tp: int, doc: bytes, at: int):
    if tp in NUMBERS:
        return struct.unpack_from(NUMBERS[tp], doc, at)[0]
    if tp == LITERAL:
        if doc[at] not in LITERALS:
            raise ValueError("bad JSON literal")
        return LITERALS[doc[at]]
    if tp == STRING_TYPE:
        size, at = _varlen(doc, at)
        if at + size > len(doc):
            raise ValueError("JSON string cut short")
        return doc[at : at + size].decode("utf-8", "replace")
    if tp == OPAQUE:
        size, start = _varlen(doc, at + 1)
        return _opaque(doc[at], doc[start : start + size])
    if tp > LARGE_ARRAY:
        raise ValueError(f"bad JSON type {tp}")
    return _container(tp, doc, at)


def _container(tp: int, doc: bytes, base: int):
    """Object or array: counts, then entries that point forward from ``base``."""
    small, is_object = tp in (SMALL_OBJECT, SMALL_ARRAY), tp in (SMALL_OBJECT, LARGE_OBJECT)
    word = 2 if small else 4
    offset = "<H" if small else "<I"
    count, size = (struct.unpack_from(offset, doc, base + i * word)[0] for i in range(2))
    if base + size > len(doc):
        raise ValueError("JSON container cut short")
    at = base + 2 * word
    names = []
    if is_object:
        for _ in range(count):
            start = base + struct.unpack_from(offset, doc, at)[0]
            length = struct.unpack_from("<H", doc, at + word)[0]
            names.append(doc[start : start + length].decode("utf-8", "replace"))
            at += word + 2
    inline = {LITERAL, 5, 6} if small else {LITERAL, 5, 6, 7, 8}
    values = []
    for _ in range(count):
        kind = doc[at]
        if kind in inline:
            values.append(_node(kind, doc, at + 1))
        else:
            start = struct.unpack_from(offset, doc, at + 1)[0]
            if start < 2 * word:
                raise ValueError("JSON value points into its header")
            values.append(_node(kind, doc, base + start))
        at += 1 + word
    return dict(zip(names, values)) if is_object else values


def _opaque(column_type: int, data: bytes):
    """Decimals and times inside JSON become strings, other opaque values null."""
    if column_type == ct.NEWDECIMAL:
        return decimal_of(data[2:], data[0], data[1])
    if column_type not in (ct.TIME, ct.DATE, ct.DATETIME, ct.TIMESTAMP):
        return None
    packed = struct.unpack_from("<q", data)[0]
    size, frac = abs(packed) >> 24, abs(packed) & 0xFFFFFF
    hms = size & 0x1FFFF
    clock = f"{hms >> 12:02}:{hms >> 6 & 63:02}:{hms & 63:02}.{frac:06}"
    if column_type == ct.TIME:
        if packed == 0:
            return "00:00:00"
        hours = size >> 12 & 1023
        return f"{'-' if packed < 0 else ''}{hours:02}:{size >> 6 & 63:02}:{size & 63:02}.{frac:06}"
    if packed == 0:
        return "0000-00-00 00:00:00"
    ymd = size >> 17
    return f"{(ymd >> 5) // 13:04}-{(ymd >> 5) % 13:02}-{ymd & 31:02} {clock}"


def decimal_of(data: bytes, precision: int, scale: int) -> str:
    """Decimal text of packed digits; the first bit is set for values from 0 up."""
    negative = not data[0] & 0x80
    body = bytearray(b ^ 0xFF for b in data) if negative else bytearray(data)
    body[0] ^= 0x80
    groups, lead = divmod(precision - scale, 9)
    fgroups, tail = divmod(scale, 9)
    plan = ([lead] if lead else []) + [9] * (groups + fgroups) + ([tail] if tail else [])
    digits, at = "", 0
    for n in plan:
        width = DIGIT_BYTES[n]
        digits += str(int.from_bytes(body[at : at + width], "big")).zfill(n)
        at += width
    number = decimal.Decimal(("-" if negative else "") + (digits or "0")).scaleb(
        -scale, decimal.Context(prec=70)
    )
    return f"{number:f}"


DIFF_OPS = {0: "replace", 1: "insert", 2: "remove"}


def json_diffs(data: bytes) -> list[dict]:
    """The diffs of a partially updated JSON column, in order."""
    out, at = [], 0
    while at < len(data):
        if data[at] not in DIFF_OPS:
            raise ValueError("corrupted JSON diff")
        op = DIFF_OPS[data[at]]
        size, at = lenenc(data, at + 1)
        diff = {"op": op, "path": data[at : at + size].decode("utf-8", "replace")}
        at += size
        if op != "remove":
            size, at = lenenc(data, at)
            diff["value"] = dump_json(json_value(data[at : at + size])).decode()
            at += size
        out.append(diff)
    return out
