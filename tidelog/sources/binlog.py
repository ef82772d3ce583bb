"""Binary-log archives as a Spark data source (batch and streaming).

A file is a chain: each event's size tells where the next one starts, so a file
is read by one task front to back and files are read in parallel (servers
rotate at 1 GB). The reader only frames events; bodies are decoded later by
native expressions. Any folder pyarrow can open (local, HDFS, object stores) works.
"""

from __future__ import annotations

import heapq
import io
import json
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from tidelog.operators.events import body_of
from tidelog.operators.position import file_base, file_seq

MAGIC = b"\xfebin"
HEADER = struct.Struct("<IBIIIH")
FORMAT, ROTATE = 15, 4
ROW_TYPES = {20, 21, 22, 23, 24, 25, 30, 31, 32, 39, 166, 167, 168}
TABLE_MAP = 19
STMT_END = 1
# Events after which no table map can be open.
BOUNDARIES = {2, 3, 4, 15, 16, 33, 34, 35, 162, 163}
BATCH_BYTES = 8 << 20
BATCH_ROWS = 10_000

FRAME_SCHEMA = (
    "source string, file string, start_pos bigint, ts timestamp, event_type int, "
    "server_id bigint, event_size bigint, log_pos bigint, flags int, checksum_alg int, "
    "table_id_size int, raw binary, table_map binary, error string"
)
ARROW_FIELDS = [
    ("source", pa.string()),
    ("file", pa.string()),
    ("start_pos", pa.int64()),
    ("ts", pa.timestamp("us", tz="UTC")),
    ("event_type", pa.int32()),
    ("server_id", pa.int64()),
    ("event_size", pa.int64()),
    ("log_pos", pa.int64()),
    ("flags", pa.int32()),
    ("checksum_alg", pa.int32()),
    ("table_id_size", pa.int32()),
    ("raw", pa.binary()),
    ("table_map", pa.binary()),
    ("error", pa.string()),
]


class CorruptLog(ValueError):
    pass


class MapCache:
    """Table maps in force while a file is read front to back.

    A row event refers to the last map with its table id; one flagged as the
    end of its statement drops all maps after itself.
    """

    def __init__(self):
        self.maps: dict[int, bytes] = {}

    def see(self, tp: int, body: bytes, id_size: int) -> bytes | None:
        """Body of the map a row event needs, else None."""
        if tp == TABLE_MAP:
            self.maps[int.from_bytes(body[:id_size], "little")] = body
            return None
        if tp not in ROW_TYPES:
            return None
        found = self.maps.get(int.from_bytes(body[:id_size], "little"))
        if len(body) > id_size and body[id_size] & STMT_END:
            self.maps.clear()
        return found


@dataclass
class FileSlice(InputPartition):
    """Events of one file that start in [start, stop); stop None reads to the end."""

    path: str
    start: int = 4
    stop: int | None = None
    with_format: bool = True


@dataclass
class FileGroup(InputPartition):
    """Slices one task reads one after the other."""

    slices: list[FileSlice]


def grouped(slices: list[tuple[FileSlice, int]], target_bytes: int, least: int) -> list[FileGroup]:
    """Small files share a task, up to about the target size and in ``least`` tasks at least if there
    are as many files. Largest first, each to the task with the fewest bytes, so tasks are alike."""
    total = sum(size for _, size in slices)
    count = min(len(slices), max(least, -(-total // target_bytes)))
    groups = [FileGroup([]) for _ in range(count)]
    held = [(0, i) for i in range(count)]
    for part, size in sorted(slices, key=lambda s: -s[1]):
        filled, i = heapq.heappop(held)
        groups[i].slices.append(part)
        heapq.heappush(held, (filled + size, i))
    return groups


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark itself resolves it, for tasks to open."""
    if "://" in path:
        return path
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(hadoop).toString()


def position_key(name: str) -> tuple[str, int]:
    base, dot, ext = name.rpartition(".")
    return (base, int(ext)) if dot and ext.isdigit() else (name, 0)


def list_logs(path: str) -> list[tuple[str, int]]:
    """(path, size) of the log files in a folder (or of one file), in log order.

    Paths keep the scheme they were asked with, for the tasks to open.
    """
    fs, root = open_fs(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [(path, info.size)]
    base, cut = path.rstrip("/"), len(root.rstrip("/"))
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    logs = [
        (base + f.path[cut:], f.size)
        for f in found
        if f.type == pafs.FileType.File and not f.base_name.startswith((".", "_"))
    ]
    return sorted(logs, key=lambda f: (f[0].rpartition("/")[0], position_key(f[0].rpartition("/")[2])))


def format_facts(raw: bytes) -> tuple[int, int]:
    """(checksum algorithm, table id size) told by a format event."""
    body = raw[19:]
    version = body[2:52].rstrip(b"\0").decode("latin-1")
    numbers = [int("".join(c for c in p if c.isdigit()) or 0) for p in version.split("-")[0].split(".")[:3]]
    numbers += [0] * (3 - len(numbers))
    aware = tuple(numbers) >= ((5, 3, 0) if "mariadb" in version.lower() else (5, 6, 1))
    alg = body[-5] if aware and len(body) >= 62 else 0
    lengths = body[57 : len(body) - 5 if aware else len(body)]
    map_header = lengths[TABLE_MAP - 1] if len(lengths) >= TABLE_MAP else 8
    return alg, 4 if map_header == 6 else 6


def frames(part: FileSlice, permissive: bool, headers: bool = False) -> Iterator[tuple]:
    """Walk one file: (start_pos, header fields, alg, id size, raw bytes, error).

    With ``headers`` bodies are passed over, but for that of a format event, and no raw bytes come.
    """
    fs, path = open_fs(part.path)
    with io.BufferedReader(fs.open_input_file(path), 4 << 20) as stream:
        if stream.read(4) != MAGIC:
            if not permissive:
                raise CorruptLog(f"{path} is not a binary log")
            yield 0, (0, 0, 0, 0, 0, 0), 0, 6, b"", "not a binary log"
            return
        at, alg, id_size = 4, 0, 6
        start = max(part.start, 4)
        while part.stop is None or at < part.stop:
            head = stream.read(19)
            if len(head) < 19:
                # A header cut short is how a log that is being written ends.
                return
            fields = HEADER.unpack(head)
            size = fields[3]
            passed = headers and fields[1] != FORMAT and 19 <= size <= stream.raw.size() - at
            if passed:
                stream.seek(at + size)
            body = stream.read(size - 19) if size >= 19 and not passed else b""
            raw = head + body
            error = None
            if size < 19:
                error = "event size below header size"
            elif len(raw) != size and not passed:
                error = "event body cut short"
            if error and not permissive:
                raise CorruptLog(f"{path} at {at}: {error}")
            if error:
                left = stream.raw.size() - at - len(raw)
                error = f"{error}; {left} bytes of the file left out" if left else error
            if not error and fields[1] == FORMAT:
                alg, id_size = format_facts(raw)
            first_format = at == 4 and fields[1] == FORMAT and part.with_format
            if at >= start or first_format or error:
                yield at, fields, alg, id_size, None if headers else raw, error
            if error:
                return
            at += size
            if at < start and fields[1] == FORMAT:
                # The format event is known; go on from the asked offset.
                stream.seek(start)
                at = start


def checksum_wrong(raw: bytes, alg: int) -> bool:
    return alg == 1 and zlib.crc32(raw[:-4]) != int.from_bytes(raw[-4:], "little")


def batches(
    part: FileSlice, permissive: bool, keep, verify: bool = False, headers: bool = False
) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(ARROW_FIELDS)
    folder, _, name = part.path.rpartition("/")
    source = folder.rpartition("/")[2]
    rows, held, maps = [], 0, MapCache()

    def flush():
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=t) for c, (_, t) in zip(cols, ARROW_FIELDS)], schema=schema
        )

    for at, (ts, tp, server, size, log_pos, flags), alg, id_size, raw, error in frames(part, permissive, headers):
        if verify and not error and checksum_wrong(raw, alg):
            error = "checksum mismatch"
            if not permissive:
                raise CorruptLog(f"{part.path} at {at}: {error}")
        bound = None if error or headers else maps.see(tp, raw[19 : size - 4 if alg == 1 else size], id_size)
        if not (error or keep(ts, tp)):
            continue
        stamp = ts * 1_000_000
        rows.append(
            (source, name, at, stamp, tp, server, size, log_pos, flags, alg, id_size, raw, bound, error)
        )
        held += len(raw or b"")
        if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
            yield flush()
            rows, held = [], 0
    if rows:
        yield flush()


class Keep:
    """Event types and start time asked for, checked before bytes leave the reader.

    These are options of the read and not pushed filters: Spark keeps the
    filters pushed to a Python source with the source and not with the scan, so
    a plan that reads one DataFrame twice with different filters would lose rows.
    """

    def __init__(self, options):
        types = options.get("eventTypes", "")
        self.types = {int(t) for t in types.split(",")} if types else None
        self.since = int(options.get("since", 0))

    def __call__(self, ts: int, tp: int) -> bool:
        return (self.types is None or tp in self.types) and ts >= self.since


class BinlogReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.start = int(options.get("startPos", 4))
        self.permissive = options.get("mode", "FAILFAST").upper() == "PERMISSIVE"
        self.target = int(options.get("targetBytes", 128 << 20))
        self.least = int(options.get("minPartitions", 1))
        self.keep = Keep(options)
        self.verify = options.get("verifyChecksum", "false").lower() == "true"
        self.headers = options.get("headersOnly", "false").lower() == "true"
        if self.headers and self.verify:
            raise ValueError("checksums cover bodies: verifyChecksum needs headersOnly=false")

    def partitions(self) -> Sequence[InputPartition]:
        slices = [(FileSlice(p, self.start), size) for p, size in list_logs(self.path)]
        return grouped(slices, self.target, self.least)

    def read(self, partition):
        for part in partition.slices:
            yield from batches(part, self.permissive, self.keep, self.verify, self.headers)


class BinlogStreamReader(DataSourceStreamReader):
    """Offsets are a position per folder: everything before (file, pos) of it has been read.

    Each folder is the log of one server, so servers advance on their own. A batch
    ends where no table map is open, so binding row events to table maps needs
    no state across batches.

    With ``maxBytes`` a batch takes about so many bytes, dealt evenly over the folders that have
    something new, and goes on to the first end of a statement behind them. Files that fit are taken whole,
    without a look inside; headers are walked only in the file where a batch ends, from the position reached on.
    """

    def __init__(self, options):
        self.path = options["path"]
        self.permissive = options.get("mode", "FAILFAST").upper() == "PERMISSIVE"
        self.verify = options.get("verifyChecksum", "false").lower() == "true"
        # Where to start, by the name of the server's folder; "" holds for all others.
        self.start = json.loads(options.get("starting", "{}"))
        self.target = int(options.get("targetBytes", 128 << 20))
        self.least = int(options.get("minPartitions", 1))
        self.keep = Keep(options)
        self.limit = int(options.get("maxBytes", 0))
        # Spark names the position of its checkpoint, too, by asking for the empty range behind it.
        self.reached: dict = {}

    def initialOffset(self) -> dict:
        return {}

    def _by_folder(self) -> dict[str, list[tuple[str, int]]]:
        found: dict[str, list[tuple[str, int]]] = {}
        for path, size in list_logs(self.path):
            found.setdefault(path.rpartition("/")[0], []).append((path, size))
        return found

    def latestOffset(self) -> dict:
        new = {}
        for folder, logs in self._by_folder().items():
            file, pos = self._begin(folder, self.reached)
            left = [(p, size, 4) for p, size in logs if position_key(p.rpartition("/")[2]) >= position_key(file)]
            if left and file and left[0][0].rpartition("/")[2] == file:
                left[0] = (*left[0][:2], max(pos, 4))
            if left:
                new[folder] = left
        ends = dict(self.reached)
        waiting = sum(any(size > at for _, size, at in left) for left in new.values())
        for folder, left in new.items():
            end = self._end(left, max(1, self.limit // waiting) if self.limit and waiting else None)
            if end is not None:
                ends[folder] = end
        return ends

    def _end(self, left: list[tuple[str, int, int]], most: int | None) -> list | None:
        """Where a batch over these (path, size, begin) ends that takes about ``most`` bytes."""
        *old, (last, size, at) = left
        for path, whole, begin in old:
            if most is not None and whole - begin > most:
                stop = self._boundary(path, whole, begin, begin + most)
                # A file cut short is finished, too: the server has gone on to the next.
                return [path.rpartition("/")[2], stop if stop > begin else whole]
            if most is not None:
                most -= whole - begin
                if most <= 0:
                    return [path.rpartition("/")[2], whole]
        return [last.rpartition("/")[2], self._boundary(last, size, at, None if most is None else at + most)]

    def _boundary(self, path: str, size: int, begin: int, enough: int | None) -> int:
        """Where the last event ends behind which no table map is open, or the first such end from ``enough`` on.

        Reads headers through a buffer, from ``begin`` on, where no map is open.
        """
        fs, inner = open_fs(path)
        safe = at = begin
        open_map = False
        with io.BufferedReader(fs.open_input_file(inner), 1 << 20) as f:
            while at + 19 <= size and (enough is None or safe < enough):
                f.seek(at)
                head = f.read(19)
                _, tp, _, event_size, _, _ = HEADER.unpack(head)
                if event_size < 19 or at + event_size > size:
                    break
                if tp == TABLE_MAP:
                    open_map = True
                elif tp in ROW_TYPES:
                    flags = f.read(8)[6:8]
                    open_map = open_map and not int.from_bytes(flags, "little") & STMT_END
                elif tp in BOUNDARIES:
                    open_map = False
                at += event_size
                if not open_map:
                    safe = at
        return safe

    def _begin(self, folder: str, start: dict) -> tuple[str, int]:
        if folder in start:
            return tuple(start[folder])
        return tuple(self.start.get(folder.rpartition("/")[2], self.start.get("", ("", 4))))

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.reached = end
        parts = []
        for folder, logs in self._by_folder().items():
            if folder not in end:
                continue
            file, pos = self._begin(folder, start)
            last, until = end[folder]
            lo, hi = position_key(file), position_key(last)
            for path, size in logs:
                key = position_key(path.rpartition("/")[2])
                if key < lo or key > hi:
                    continue
                begin = pos if key == lo and file else 4
                stop = until if key == hi else None
                if stop is None or begin < stop:
                    parts.append((FileSlice(path, begin, stop, with_format=begin <= 4), (stop or size) - begin))
        return grouped(parts, self.target, self.least)

    def read(self, partition):
        for part in partition.slices:
            yield from batches(part, self.permissive, self.keep, self.verify)

    def commit(self, end: dict) -> None:
        pass


class BinlogDataSource(DataSource):
    """``spark.read.format("binlog")`` / ``spark.readStream.format("binlog")``."""

    @classmethod
    def name(cls) -> str:
        return "binlog"

    def schema(self) -> str:
        return FRAME_SCHEMA

    def reader(self, schema):
        return BinlogReader(self.options)

    def streamReader(self, schema):
        return BinlogStreamReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BinlogDataSource)


def as_log(framed: DataFrame) -> DataFrame:
    """Framed events to ``log_events``: position columns, key and body."""
    name = F.col("file")
    body = body_of(F.col("raw"), F.col("event_type"), F.col("checksum_alg"))
    return framed.select(
        "source",
        "file",
        file_base(name).alias("file_base"),
        file_seq(name).alias("file_seq"),
        "start_pos",
        F.lit(0).alias("inner_idx"),
        "ts",
        "event_type",
        "server_id",
        "event_size",
        "log_pos",
        "flags",
        "checksum_alg",
        "table_id_size",
        "table_map",
        "error",
        body.alias("body"),
        "raw",
    )


def read_binlog(
    spark: SparkSession,
    path: str,
    start_pos: int = 4,
    mode: str = "FAILFAST",
    verify_checksum: bool = False,
    event_types: Sequence[int] = (),
    since: int = 0,
    headers_only: bool = False,
) -> DataFrame:
    """Events of an archive folder or file as ``log_events``.

    ``event_types`` and ``since`` (seconds) drop other events inside the
    reader; row events come with their table map all the same.

    ``verify_checksum`` tests each CRC32 in the reader, whatever columns are asked for.

    ``headers_only`` passes over bodies: ``raw``, ``body`` and ``table_map`` are NULL and no bytes of
    them reach Spark. It can't be joined with ``verify_checksum``.

    FAILFAST stops at the first damaged event; PERMISSIVE keeps it as a row
    with ``error`` (see ``quality.split_quarantine``) and goes on with the next file.
    """
    register(spark)
    reader = spark.read.format("binlog").option("startPos", start_pos).option("mode", mode)
    if event_types:
        reader = reader.option("eventTypes", ",".join(map(str, event_types)))
    reader = reader.option("since", since).option("verifyChecksum", verify_checksum)
    reader = reader.option("headersOnly", headers_only)
    return as_log(_sized(spark, reader).load(qualified(spark, path)))


def _sized(spark: SparkSession, reader):
    return reader.option("minPartitions", spark.sparkContext.defaultParallelism)


def raw_mode(log: DataFrame) -> DataFrame:
    """Only format and rotate events are typed; the others stay opaque bytes."""
    typed = F.col("event_type").isin(FORMAT, ROTATE)
    return log.withColumn("typed", typed)


def stream_binlog(
    spark: SparkSession,
    path: str,
    starting: tuple[str, int] | dict[str, tuple[str, int]] | None = None,
    mode: str = "FAILFAST",
    verify_checksum: bool = False,
    event_types: Sequence[int] = (),
    since: int = 0,
    max_bytes: int = 0,
) -> DataFrame:
    """Growing archive as a stream.

    A folder per server; ``starting`` is a (file, position) for all of them, or one
    per folder name. ``max_bytes`` bounds a batch (0: none), see ``feeds.finish`` for drains.
    The other options are those of ``read_binlog``.
    """
    register(spark)
    reader = _sized(spark, spark.readStream.format("binlog").option("mode", mode))
    if starting:
        by_folder = starting if isinstance(starting, dict) else {"": starting}
        reader = reader.option("starting", json.dumps(by_folder))
    if event_types:
        reader = reader.option("eventTypes", ",".join(map(str, event_types)))
    reader = reader.option("since", since).option("verifyChecksum", verify_checksum).option("maxBytes", max_bytes)
    return as_log(reader.load(qualified(spark, path)))
