"""Compressed events: expanded or inflated in Arrow batches, everything else untouched.

Spark has no SQL function for zlib or zstd, so these two jobs pass bytes
through Python. Both read the log once.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidelog.operators.events import COMPRESSED, PAYLOAD
from tidelog.operators.images import fixed_part
from tidelog.sources.binlog import MapCache

ZSTD = 0
ROWS_PER_BATCH, BYTES_PER_BATCH = 10_000, 8 << 20


def payload_parts(body: bytes) -> tuple[int | None, bytes]:
    """Type-length-value head of a transaction payload: (compression type, payload)."""
    at, algorithm = 0, None
    while True:
        kind = body[at]
        if kind == 0:
            return algorithm, body[at + 1 :]
        size = body[at + 1]
        value = int.from_bytes(body[at + 2 : at + 2 + size], "little")
        if kind == 2:
            algorithm = value
        elif kind not in (1, 3):
            raise ValueError(f"unknown payload field {kind}")
        at += 2 + size


def inner_events(body: bytes) -> Iterator[bytes]:
    """Events inside a compressed transaction, decompressed as a stream."""
    algorithm, payload = payload_parts(body)
    if algorithm != ZSTD:
        raise ValueError(f"payload compression type {algorithm}")
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(payload), read_across_frames=True) as reader:
        while True:
            head = reader.read(19)
            if len(head) < 19:
                return
            size = int.from_bytes(head[9:13], "little")
            rest = reader.read(size - 19)
            if size < 19 or len(rest) != size - 19:
                raise ValueError("inner event exceeds the payload")
            yield head + rest


def expand_payloads(log: DataFrame) -> DataFrame:
    """Replace each compressed transaction by its events.

    They share the position of the payload event and are told apart by
    ``inner_idx`` (1, 2, ...). Inner events carry no checksum. A damaged payload
    stays in the log with ``error`` set, behind the events read before the damage.
    """
    schema = log.schema
    arrow = to_arrow_schema(schema)
    names = arrow.names

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            packed = pc.fill_null(pc.equal(batch.column("event_type"), PAYLOAD), False)
            if pc.any(packed).as_py() is not True:
                yield batch.cast(arrow)
                continue
            yield batch.filter(pc.invert(packed)).cast(arrow)
            for row in batch.filter(packed).to_pylist():
                maps = MapCache()
                try:
                    for i, raw in enumerate(inner_events(row["body"]), 1):
                        rows.append(
                            {
                                **row,
                                "inner_idx": i,
                                "ts": pd.Timestamp(int.from_bytes(raw[:4], "little"), unit="s", tz="UTC"),
                                "event_type": raw[4],
                                "server_id": int.from_bytes(raw[5:9], "little"),
                                "event_size": len(raw),
                                "log_pos": int.from_bytes(raw[13:17], "little"),
                                "flags": int.from_bytes(raw[17:19], "little"),
                                "checksum_alg": 0,
                                "table_map": maps.see(raw[4], raw[19:], row["table_id_size"]),
                                "body": raw[19:],
                                "raw": raw,
                            }
                        )
                        held += len(raw)
                        if len(rows) >= ROWS_PER_BATCH or held >= BYTES_PER_BATCH:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, held = [], 0
                except (ValueError, IndexError, zstandard.ZstdError) as exc:
                    rows.append({**row, "error": f"transaction payload: {exc}"})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    assert {"body", "raw", "inner_idx", "error"} <= set(names)
    return log.mapInArrow(expand, schema)


def inflate(data: bytes) -> bytes:
    """zlib data behind a header whose low three bits give the size of the length field."""
    return zlib.decompress(data[1 + (data[0] & 7) :])


@F.pandas_udf(T.BinaryType())
def _inflate(tails: pd.Series) -> pd.Series:
    return tails.map(lambda t: None if t is None else inflate(bytes(t)))


def inflate_bodies(log: DataFrame) -> DataFrame:
    """Plain bodies for compressed MariaDB events.

    Only what follows the fixed part is compressed: the SQL text of a query
    event, the row images of a rows event.
    """
    compressed = F.col("event_type").isin(*COMPRESSED)
    keep = fixed_part(F.col("body"), F.col("event_type"), F.col("table_id_size"))
    tail = F.when(compressed, F.substring(F.col("body"), (keep + 1).cast("int"), F.length("body")))
    plain = F.concat(F.substring(F.col("body"), F.lit(1), keep.cast("int")), _inflate(tail))
    # One pass: other events send nulls to Python and keep their body.
    return log.withColumn("body", F.when(compressed, plain).otherwise(F.col("body")))
