"""Row events of an archive to table maps, row images and typed changes.

The reader hands each row event its table map (``table_map``), so decoding is
one narrow step: no shuffle between the file and ``row_changes``. Headers are
native expressions, a small Arrow job cuts the images into cells, and native
expressions turn cells into values.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidelog.functions import cells as cell_fn
from tidelog.functions import columns as ct
from tidelog.functions.binary import be_int, le_int, lenenc_int
from tidelog.functions.binary import text as utf8_text
from tidelog.operators import rowbatch, rowcodec
from tidelog.operators.catalog import LISTS
from tidelog.operators.events import LOG_KEY, ROWS, TABLE_MAP

V2 = (30, 31, 32, 39)
BATCH_ROWS = 4_000
BATCH_BYTES = 8 << 20


# -- table maps --------------------------------------------------------------------

MAP_FIELDS = (
    "table_id bigint, map_id bigint, map_flags int, schema_name string, table_name string, "
    "types array<int>, metas array<int>, null_bitmap binary, "
    + ", ".join(f"{n} {t}" for n, t in LISTS.items())
    + ", map_error string"
)


def _with_schema(df: DataFrame, keys: Sequence[str], fields: str) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name in keys]
    return T.StructType(kept + T.StructType.fromDDL(fields).fields)


def map_id(table_map: bytes, id_size: int) -> int:
    """Tells table definitions apart: a hash of the map without the id the server gave it."""
    return int.from_bytes(hashlib.blake2b(table_map[id_size + 2 :], digest_size=8).digest(), "little", signed=True)


def _map_row(body: bytes, id_size: int) -> dict:
    try:
        tm = rowcodec.parse_table_map(body, id_size)
    except (ValueError, IndexError) as exc:
        return {"map_error": str(exc) or "damaged table map"}
    return {
        "table_id": tm.table_id,
        "map_id": map_id(body, id_size),
        "map_flags": tm.flags,
        "schema_name": tm.schema,
        "table_name": tm.table,
        "types": tm.types,
        "metas": tm.metas,
        "null_bitmap": tm.null_bitmap,
        "map_error": None,
        **tm.lists,
    }


def table_maps(log: DataFrame, keys: Sequence[str] = LOG_KEY) -> DataFrame:
    """Decoded table-map events with their metadata lists (see ``catalog``)."""
    source = log.filter(F.col("event_type") == TABLE_MAP).select(*keys, "body", "table_id_size")
    schema = _with_schema(source, keys, MAP_FIELDS)
    arrow, kept = to_arrow_schema(schema), [c for c in source.columns if c in keys]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A map is decoded once however often it comes.
            kind = rowbatch.kinds([batch.column("body"), batch.column("table_id_size")])
            _, first, which = np.unique(kind, return_index=True, return_inverse=True)
            some = batch.select(["body", "table_id_size"]).take(pa.array(first))
            rows = [_map_row(body, size) for body, size in zip(*(c.to_pylist() for c in some.columns))]
            decoded = pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(arrow)[len(kept) :]))
            decoded = decoded.take(pa.array(which.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *decoded.columns], schema=arrow)

    # Missing lists come out as NULL; an absent list is an empty one.
    decoded = source.mapInArrow(decode, schema)
    empty = {
        n: F.coalesce(F.col(n), F.array().cast(t)) for n, t in LISTS.items() if t.startswith("array")
    }
    return decoded.withColumns(empty)


# -- row events ---------------------------------------------------------------------


def fixed_part(body: Column, event_type: Column, id_size: Column) -> Column:
    """Bytes in front of the compressed part of a compressed event."""
    query = 14 + le_int(body, 12, 2) + be_int(body, 9, 1)
    n_cols = lenenc_int(body, id_size + 3)
    bitmap = F.floor((n_cols["value"].cast("bigint") + 7) / 8)
    bitmaps = bitmap * F.when(event_type == 167, 2).otherwise(1)
    return F.when(event_type == 165, query).otherwise(id_size + 2 + n_cols["width"] + bitmaps)


def rows_header(log: DataFrame) -> DataFrame:
    """Header fields of row events; ``images`` is the undecoded rest."""
    body, id_size, tp = F.col("body"), F.col("table_id_size"), F.col("event_type")
    table_id = F.when(id_size == 4, le_int(body, 1, 4)).otherwise(le_int(body, 1, 6))
    row_flags = le_int(body, id_size + 1, 2)
    extra = F.when(tp.isin(*V2), le_int(body, id_size + 3, 2)).otherwise(0)
    at = (id_size + 3 + extra).cast("int")
    n_cols = lenenc_int(body, at)
    n = n_cols["value"].cast("int")
    width = F.floor((n + 7) / 8).cast("int")
    first = (at + n_cols["width"]).cast("int")
    two = tp.isin(*rowcodec.TWO_BITMAPS)
    rest = F.when(two, first + 2 * width).otherwise(first + width)
    return log.filter(tp.isin(*ROWS)).withColumns(
        {
            "table_id": table_id,
            "row_flags": row_flags.cast("int"),
            "stmt_end": row_flags.bitwiseAND(F.lit(1)) == 1,
            "n_cols": n,
            "present1": F.substring(body, first, width),
            "present2": F.when(two, F.substring(body, first + width, width)),
            "images": F.substring(body, rest, F.length(body)),
        }
    )


CHANGE_FIELDS = (
    "schema_name string, table_name string, change_no bigint, op string, "
    "before array<binary>, after array<binary>, skipped_before array<int>, "
    "skipped_after array<int>, json_diffs array<int>, map_id bigint, error string"
)

Decoder = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def of_tables(tables: Sequence[tuple[str, str]]) -> Column:
    """Whether a row event's table map is of one of (schema, table); reads its first bytes only."""

    def named(schema: str, table: str) -> Column:
        parts = [x.encode() for x in (schema, table)]
        head = b"".join(bytes([len(x)]) + x + b"\0" for x in parts)
        return F.substring(F.col("table_map"), F.col("table_id_size") + 3, F.lit(len(head))) == F.lit(head)

    return reduce(or_, (named(*t) for t in tables), F.lit(False))


def row_changes(
    log: DataFrame,
    keys: Sequence[str] = LOG_KEY,
    ignore_json_errors: bool = False,
    tables: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per change with the cells of its images (NULL: null or skipped).

    An event that cannot be cut gives one row with ``error`` instead; row
    events without a table map are left to ``orphan_events``. With ``tables``,
    (schema, table) pairs, events of other tables are dropped before any image is read.
    Events are cut in batches of one kind, so rows come out in no certain order.
    """
    needed = ["event_type", "table_id_size", "n_cols", "present1", "present2", "images", "table_map"]
    bound = log.filter(F.col("table_map").isNotNull())
    if tables is not None:
        bound = bound.filter(of_tables(tables))
    source = rows_header(bound).select(*keys, *needed)
    schema = _with_schema(source, keys, CHANGE_FIELDS)
    arrow = to_arrow_schema(schema)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, single = _Columns(arrow), []
            kind = rowbatch.kinds([batch.column(n) for n in needed if n != "images"])
            order = np.argsort(kind, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(kind[order])) + 1):
                if len(rows) >= rowbatch.TOGETHER:
                    for part in together(batch, len(keys), rows, arrow, ignore_json_errors):
                        if isinstance(part, pa.RecordBatch):
                            yield part
                        else:
                            single += part.tolist()
                else:
                    single += rows.tolist()
            columns = [batch.column(n).take(pa.array(single, pa.int64())).to_pylist() for n in (*keys, *needed)]
            for row in zip(*columns):
                key = row[: len(keys)]
                for change in event_changes(row[len(keys) :], ignore_json_errors):
                    out.add(key, change)
                    if out.full():
                        yield out.flush()
            if out.rows:
                yield out.flush()

    return source.mapInArrow(decode, schema)


def operation(event_type: int) -> str:
    return "U" if event_type in rowcodec.UPDATES else "D" if event_type in rowcodec.DELETES else "I"


def together(
    batch: pa.RecordBatch, n_keys: int, rows: np.ndarray, schema: pa.Schema, ignore_json_errors: bool
) -> Iterator[pa.RecordBatch | np.ndarray]:
    """Changes of events of one kind as batches, and the rows that have to be cut one by one."""
    tp, id_size, n, bitmap1, bitmap2, _, table_map = (batch.column(n_keys + k)[int(rows[0])].as_py() for k in range(7))
    images = batch.column(n_keys + 5)
    if tp == rowcodec.PARTIAL_UPDATE or images.null_count:
        yield rows
        return
    try:
        tm = rowcodec.parse_table_map(table_map, id_size)
        image_walker(table_map, id_size, tp, n, ignore_json_errors)
        present1, skip1 = columns_present(bitmap1, n)
        present2, skip2 = columns_present(bitmap2 or bitmap1, n)
    except (ValueError, IndexError, TypeError):
        yield rows
        return
    op, first_after = operation(tp), operation(tp) == "I"
    sides = [rowbatch.Side(tm.layout, present1, n)]
    if tp in rowcodec.PAIRS:
        sides.append(rowbatch.Side(tm.layout, present2, n))
    own = rowbatch.Kind(tm, tp, sides)
    bounds = np.frombuffer(images.buffers()[1], np.int32, len(images) + 1, 4 * images.offset).astype(np.int64)
    if not images.buffers()[2]:
        yield rows
        return
    data = np.frombuffer(images.buffers()[2], np.uint8)
    for chunk in rowbatch.chunks(bounds[rows + 1] - bounds[rows]):
        mine = rows[chunk]
        low, high = int(bounds[mine].min()), int(bounds[mine + 1].max())
        event, number, cells, damaged = own.cut(data[low:high], bounds[mine] - low, bounds[mine + 1] - low)
        texts = data[low:high]
        for part in cells if own.json else ():
            texts, wrong = own.decode_json(texts, part, ignore_json_errors)
            damaged = np.concatenate([damaged, event[wrong]])
        if len(damaged):
            yield mine[np.unique(damaged)]
            good = np.flatnonzero(~np.isin(event, damaged))
            event, number, cells = event[good], number[good], [c.take(good) for c in cells]
        # In log order within the kind.
        order = np.lexsort((number, event))
        event, number = event[order], number[order]
        if not len(event):
            continue
        lists = [rowbatch.cell_lists(texts, c.take(order)) for c in cells]
        size, at = len(event), pa.array(mine[event])
        none = pa.nulls(size, schema.field("before").type)
        before, after = (none, lists[0]) if first_after else (lists[0], lists[1] if len(lists) > 1 else none)
        value = {
            "schema_name": tm.schema, "table_name": tm.table, "op": op,
            "skipped_before": None if first_after else skip1,
            "skipped_after": skip1 if first_after else skip2 if len(sides) > 1 else None,
            "json_diffs": [], "map_id": known_map_id(table_map, id_size), "error": None,
        }
        made = {"change_no": pa.array(number), "before": before, "after": after}
        columns = [batch.column(k).take(at) for k in range(n_keys)]
        for f in list(schema)[n_keys:]:
            column = made.get(f.name)
            columns.append(pa.repeat(pa.scalar(value[f.name], f.type), size) if column is None else column.cast(f.type))
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


# Events of a table repeat their map and bitmaps; a worker prepares them once.


@lru_cache(maxsize=4096)
def image_walker(
    table_map: bytes, id_size: int, event_type: int, n_cols: int, ignore_json_errors: bool
) -> rowcodec.ImageWalker:
    tm = rowcodec.parse_table_map(table_map, id_size)
    return rowcodec.ImageWalker(tm, event_type, n_cols, ignore_json_errors)


known_map_id = lru_cache(maxsize=4096)(map_id)


@lru_cache(maxsize=4096)
def columns_present(bitmap: bytes, n_cols: int) -> tuple[list[int], list[int]]:
    """Ordinals in the image and ordinals left out of it."""
    present = rowcodec.bit_positions(bitmap, n_cols)
    return present, sorted(set(range(n_cols)) - set(present))


def event_changes(row: tuple, ignore_json_errors: bool) -> Iterator[tuple]:
    """Changes of one row event, given as (type, id size, columns, bitmaps, images, map)."""
    tp, id_size, n, bitmap1, bitmap2, images, table_map = row
    op = operation(tp)
    schema = table = None
    try:
        tm = rowcodec.parse_table_map(table_map, id_size)
        schema, table = tm.schema, tm.table
        walker = image_walker(table_map, id_size, tp, n, ignore_json_errors)
        present1, skip1 = columns_present(bitmap1, n)
        present2, skip2 = columns_present(bitmap2 or bitmap1, n)
        for no, (before, after, diffs) in enumerate(walker.changes(images, present1, present2)):
            yield (
                schema, table, no, op, before, after,
                skip1 if before is not None else None,
                (skip2 if op == "U" else skip1) if after is not None else None,
                diffs, known_map_id(table_map, id_size), None,
            )
    except (ValueError, IndexError) as exc:
        yield schema, table, None, op, None, None, None, None, None, None, str(exc) or "damaged row event"


class _Columns:
    """Column lists of an output batch, bounded in rows and bytes."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self._reset()

    def _reset(self):
        self.columns = [[] for _ in self.schema]
        self.rows = self.bytes = 0

    def add(self, key: tuple, values: tuple) -> None:
        for column, value in zip(self.columns, (*key, *values)):
            column.append(value)
        self.rows += 1
        for cells in (values[4], values[5]):
            if cells:
                self.bytes += sum(map(len, filter(None, cells)))

    def full(self) -> bool:
        return self.rows >= BATCH_ROWS or self.bytes >= BATCH_BYTES

    def flush(self) -> pa.RecordBatch:
        arrays = [pa.array(c, type=f.type) for c, f in zip(self.columns, self.schema)]
        self._reset()
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def row_images(
    log: DataFrame,
    keys: Sequence[str] = LOG_KEY,
    decoder: Decoder | None = None,
    decoder_schema: str | None = None,
    header_only: bool = False,
) -> DataFrame:
    """One row per image: ``image_idx, kind, cells, skipped``.

    ``header_only`` stops after the event header. ``decoder`` replaces the
    image job by a function over Arrow batches of ``rows_header`` output.
    """
    if header_only:
        return rows_header(log).select(*keys, "event_type", "table_id", "row_flags", "stmt_end", "n_cols")
    if decoder is not None:
        return rows_header(log).mapInArrow(decoder, decoder_schema)
    changes = row_changes(log, keys).filter(F.col("error").isNull())
    per_change = F.when(F.col("op") == "U", 2).otherwise(1)
    op = F.col("op")

    def side(name: str, kinds: dict[str, str], second: int) -> Column:
        kind = F.when(op == "U", kinds["U"]).otherwise(kinds["other"])
        index = F.col("change_no") * per_change + F.when(op == "U", second).otherwise(0)
        return F.struct(
            index.alias("image_idx"),
            kind.alias("kind"),
            F.col(name).alias("cells"),
            F.col(f"skipped_{name}").alias("skipped"),
        )

    both = F.array(
        side("before", {"U": "UpdateBI", "other": "DeleteBI"}, 0),
        side("after", {"U": "UpdateAI", "other": "WriteAI"}, 1),
    )
    present = F.filter(both, lambda i: i["cells"].isNotNull())
    return changes.select(*keys, "schema_name", "table_name", F.inline(present))


def orphan_events(log: DataFrame) -> DataFrame:
    """Row events that came without a table map."""
    return (
        log.filter(F.col("event_type").isin(*ROWS) & F.col("table_map").isNull())
        .drop("table_map")
        .withColumn("error", F.lit("no table map for this table id"))
    )


# -- values ----------------------------------------------------------------------------


@dataclass(frozen=True)
class ColumnSpec:
    """A column of one table, as its table map describes it."""

    name: str
    ordinal: int
    type: int
    meta: int = 0
    unsigned: bool = False


def table_spec(catalog: DataFrame, schema_name: str, table_name: str) -> list[ColumnSpec]:
    """Columns of one table from ``column_catalog`` (a schema: a few thousand rows at most).

    When the table changed within the log, a name keeps its last definition; use
    ``table_specs`` to decode each change by the definition it was written with.
    """
    mine = catalog.filter((F.col("schema_name") == schema_name) & (F.col("table_name") == table_name))
    label = F.coalesce("name", F.concat(F.lit("@"), F.col("ordinal").cast("string")))
    latest = mine.groupBy(label.alias("name")).agg(
        F.max_by(F.struct("ordinal", "type", "meta", "unsigned"), F.struct("file_base", "file_seq", "start_pos")).alias("c")
    )
    rows = latest.select("name", "c.*").collect()
    specs = [ColumnSpec(r["name"], r["ordinal"], r["type"], r["meta"], bool(r["unsigned"])) for r in rows]
    return sorted(specs, key=lambda s: s.ordinal)


def table_specs(catalog: DataFrame, schema_name: str, table_name: str) -> dict[int, list[ColumnSpec]]:
    """Columns of each definition of one table, by ``map_id``, oldest first.

    ``catalog`` must have been made with ``map_id`` among its keys. Definitions are
    told apart before anything is collected: a few rows per ALTER TABLE.
    """
    mine = catalog.filter((F.col("schema_name") == schema_name) & (F.col("table_name") == table_name))
    label = F.coalesce("name", F.concat(F.lit("@"), F.col("ordinal").cast("string")))
    column = F.struct(label.alias("name"), "type", "meta", "unsigned")
    seen = F.min(F.struct("file_base", "file_seq", "start_pos")).alias("seen")
    rows = mine.groupBy("map_id", "ordinal").agg(F.first(column).alias("c"), seen).collect()
    out: dict[int, list[ColumnSpec]] = {}
    for r in sorted(rows, key=lambda r: (tuple(r["seen"]), r["ordinal"])):
        c = r["c"]
        out.setdefault(r["map_id"], []).append(
            ColumnSpec(c["name"], r["ordinal"], c["type"], c["meta"], bool(c["unsigned"]))
        )
    return out


INT_BYTES = {ct.TINY: 1, ct.SHORT: 2, ct.INT24: 3, ct.LONG: 4, ct.LONGLONG: 8}


def cell_value(cell: Column, spec: ColumnSpec, tz: str = "UTC") -> Column:
    """Typed value of a cell, by native expressions."""
    tp, meta = spec.type, spec.meta
    if tp == ct.STRING and meta >= 256 and meta >> 8 in (ct.ENUM, ct.SET):
        width = meta & 0xFF
        return le_int(cell, 1, width, signed=width == 8)
    if tp in INT_BYTES:
        return le_int(cell, 1, INT_BYTES[tp], signed=not spec.unsigned)
    if tp == ct.NEWDECIMAL:
        precision, scale = meta >> 8, meta & 0xFF
        shown = cell_fn.decimal_text(cell, precision, scale)
        return shown.try_cast(f"decimal({precision},{scale})") if precision <= 38 else shown
    if tp == ct.FLOAT:
        return cell_fn.float_value(cell)
    if tp == ct.DOUBLE:
        return cell_fn.double_value(cell)
    if tp == ct.BIT:
        return cell_fn.bit_value(cell)
    if tp == ct.YEAR:
        return cell_fn.year_value(cell)
    if tp == ct.DATETIME2:
        return cell_fn.datetime2_text(cell, meta)
    if tp == ct.TIMESTAMP2:
        return cell_fn.timestamp2_text(cell, meta, tz)
    if tp == ct.TIME2:
        return cell_fn.time2_text(cell, meta)
    if tp == ct.TIMESTAMP:
        return cell_fn.timestamp_text(cell, tz)
    if tp in (ct.DATE, ct.TIME, ct.DATETIME):
        show = {ct.DATE: cell_fn.date_text, ct.TIME: cell_fn.time_text, ct.DATETIME: cell_fn.datetime_text}
        return show[tp](cell)
    if tp in (ct.BLOB, ct.GEOMETRY):
        return cell
    return utf8_text(cell)


def typed_changes(
    changes: DataFrame,
    schema_name: str,
    table_name: str,
    specs: Sequence[ColumnSpec] | Mapping[int, Sequence[ColumnSpec]],
    tz: str = "UTC",
) -> DataFrame:
    """Changes of one table with ``before`` and ``after`` as typed structs.

    ``specs`` is one definition for all changes, or one per ``map_id`` (``table_specs``):
    then each change is decoded by its own, and a field has the type of its newest
    definition (older values are cast, NULL where they can't be). A field that a
    definition lacks is NULL. Changes of a definition that isn't given are errors.

    The fields of an absent image are NULL (``op`` tells which are there), so a
    query that reads some fields makes Spark decode only those cells.
    """
    mine = changes.filter((F.col("schema_name") == schema_name) & (F.col("table_name") == table_name))

    def typed(side: str) -> Column:
        cells = F.col(side)

        def value(s: ColumnSpec) -> Column:
            return cell_value(F.try_element_at(cells, F.lit(s.ordinal + 1)), s, tz)

        if not isinstance(specs, Mapping):
            return F.struct(*[value(s).alias(s.name) for s in specs])
        newest = {s.name: s for own in specs.values() for s in own}
        kinds = mine.select(*[value(s).alias(f"c{i}") for i, s in enumerate(newest.values())]).schema
        unknown = F.raise_error(F.concat(F.lit("no definition given for table map "), F.col("map_id").cast("string")))
        fields = []
        for (name, last), kind in zip(newest.items(), kinds, strict=True):
            out = None
            for number, own in specs.items():
                s = next((s for s in own if s.name == name), None)
                shown = F.lit(None) if s is None else value(s)
                if s is not None and (s.type, s.meta, s.unsigned) != (last.type, last.meta, last.unsigned):
                    shown = shown.try_cast(kind.dataType)
                shown = shown.cast(kind.dataType)
                test = F.col("map_id") == number
                out = F.when(test, shown) if out is None else out.when(test, shown)
            known = F.col("map_id").isin(*specs) | F.col("map_id").isNull()
            fields.append(out.when(~known, unknown.cast(kind.dataType)).alias(name))
        return F.struct(*fields)

    return mine.withColumns({"before": typed("before"), "after": typed("after")})
