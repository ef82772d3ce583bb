"""Plain-Python encoder of small log files, independent of the Spark encoders."""

from __future__ import annotations

import struct
import zlib

MAGIC = b"\xfebin"
LENGTHS = bytes(
    [56, 13, 0, 8, 0, 0, 0, 0, 4, 0, 4, 0, 0, 0, 98, 0, 4, 26, 8, 0, 0, 0, 8, 8, 8, 2, 0, 0, 0, 10, 10, 10, 42, 42, 0, 18, 52, 0, 10, 40, 0]
)


def lenenc(n: int) -> bytes:
    if n < 0xFB:
        return bytes([n])
    if n < 1 << 16:
        return b"\xfc" + n.to_bytes(2, "little")
    return b"\xfd" + n.to_bytes(3, "little")


def text(s: str) -> bytes:
    return lenenc(len(s.encode())) + s.encode()


class Log:
    def __init__(self, checksum: bool = True, ts: int = 1_700_000_000):
        self.data, self.checksum, self.ts = bytearray(MAGIC), checksum, ts
        version = b"8.0.32".ljust(50, b"\0")
        self.add(15, b"\x04\0" + version + bytes(4) + b"\x13" + LENGTHS + bytes([int(checksum)]), force_crc=True)

    def add(self, tp: int, body: bytes, flags: int = 0, force_crc: bool = False) -> int:
        start = len(self.data)
        crc = self.checksum or force_crc
        size = 19 + len(body) + (4 if crc else 0)
        raw = struct.pack("<IBIIIH", self.ts, tp, 1, size, start + size, flags) + body
        self.data += raw + (struct.pack("<I", zlib.crc32(raw)) if crc else b"")
        return start

    def write(self, path) -> None:
        path.write_bytes(bytes(self.data))


def table_map(table_id: int, types: list[int], metas: bytes, schema="d", table="t", optional=b"", nulls=None) -> bytes:
    n = len(types)
    nulls = b"\xff" * ((n + 7) // 8) if nulls is None else nulls
    return (
        table_id.to_bytes(6, "little") + b"\1\0" + bytes([len(schema)]) + schema.encode() + b"\0"
        + bytes([len(table)]) + table.encode() + b"\0" + lenenc(n) + bytes(types)
        + lenenc(len(metas)) + metas + nulls + optional
    )


def rows(table_id: int, n: int, images: bytes, present: list[bytes], flags: int = 1, version: int = 2) -> bytes:
    extra = b"\2\0" if version == 2 else b""
    return table_id.to_bytes(6, "little") + struct.pack("<H", flags) + extra + lenenc(n) + b"".join(present) + images
