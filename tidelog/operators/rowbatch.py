"""Row images of whole Arrow batches as arrays of offsets.

Events that share table map, type and bitmaps are cut together: all of them
advance one column at a time, as vectors of positions into the one buffer their images lie
in. Images of fixed width need no walk at all, they lie at equal strides. Cells are then copied
once, into one buffer per batch and side. Python objects are made for JSON documents
only. Events that are damaged, or whose kind repeats too rarely to gain
from vectors, are left to the event-wise walk of ``rowcodec``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

from tidelog.functions import columns as ct
from tidelog.operators import rowcodec

#: Events of one kind from which vectors gain.
TOGETHER = 4
#: Positions advanced at once from which vectors gain over plain integers.
LOCKSTEP = 12
#: Bytes of images cut at once.
CHUNK_BYTES = 8 << 20
#: JSON cells up to so many bytes are remembered by their bytes.
JSON_BYTES, JSON_KNOWN = 512, 1 << 14

_JSON_ERRORS = (ValueError, IndexError, rowcodec.struct.error)


@lru_cache(maxsize=JSON_KNOWN)
def _small_json(cell: bytes) -> bytes:
    return rowcodec.dump_json(rowcodec.json_value(cell))


def json_text(cell: bytes, ignore_errors: bool) -> bytes | None:
    try:
        return _small_json(cell) if len(cell) <= JSON_BYTES else rowcodec.dump_json(rowcodec.json_value(cell))
    except _JSON_ERRORS:
        if ignore_errors:
            return None
        raise


@dataclass
class Cells:
    """Begin and size of each cell of a run of images; size -1 is null or left out."""

    begin: np.ndarray
    size: np.ndarray

    @staticmethod
    def empty(rows: int, columns: int) -> Cells:
        return Cells(np.zeros((rows, columns), np.int64), np.full((rows, columns), -1, np.int64))

    def take(self, rows: np.ndarray) -> Cells:
        return Cells(self.begin[rows], self.size[rows])

    @staticmethod
    def joined(parts: list[Cells]) -> Cells:
        return Cells(np.concatenate([p.begin for p in parts]), np.concatenate([p.size for p in parts]))


class Side:
    """The columns one bitmap leaves in an image, and how long their cells are."""

    def __init__(self, layout: list[tuple[int, int]], present: list[int], n_cols: int):
        self.present, self.n_cols = present, n_cols
        self.columns = [(k, i, *layout[i]) for k, i in enumerate(present)]
        self.null_bytes = (len(present) + 7) // 8
        self.fixed = all(not prefix for _, i, size, prefix in self.columns)
        self.stride = self.null_bytes + sum(size for _, i, size, _ in self.columns)

    def walk(self, data: np.ndarray, at: np.ndarray) -> tuple[Cells, np.ndarray]:
        """Cells of the images that begin at ``at``, and where they end (maybe beyond the event)."""
        out, last = Cells.empty(len(at), self.n_cols), len(data) - 1
        nulls, at = at, at + self.null_bytes
        for k, i, size, prefix in self.columns:
            null = data[np.minimum(nulls + (k >> 3), last)] >> (k & 7) & 1 == 1
            if prefix:
                size = np.zeros(len(at), np.int64)
                for b in range(prefix):
                    size |= data[np.minimum(at + b, last)].astype(np.int64) << (8 * b)
            out.begin[:, i] = at + prefix
            out.size[:, i] = np.where(null, -1, size)
            at = np.where(null, at, at + prefix + size)
        return out, at

    def step(self, data: memoryview, at: int, end: int, begins: list, sizes: list) -> int:
        """The same for one image, in plain integers."""
        nulls, at = at, at + self.null_bytes
        if at > end:
            return at
        begin, own = [0] * self.n_cols, [-1] * self.n_cols
        for k, i, size, prefix in self.columns:
            if data[nulls + (k >> 3)] >> (k & 7) & 1:
                continue
            if prefix:
                if at + prefix > end:
                    return end + 1
                size = int.from_bytes(data[at : at + prefix], "little")
                at += prefix
            begin[i], own[i] = at, size
            at += size
            if at > end:
                return at
        begins.append(begin)
        sizes.append(own)
        return at


class Kind:
    """Events of one table map, type and pair of bitmaps."""

    def __init__(self, tm: rowcodec.TableMap, event_type: int, sides: list[Side]):
        self.tm, self.event_type, self.sides = tm, event_type, sides
        self.json = [i for i in range(sides[0].n_cols) if tm.types[i] == ct.JSON]

    def strided(self, data: np.ndarray, at: np.ndarray, end: np.ndarray):
        """(event, change number, cells per side) where no cell has a length of its own and none is null."""
        stride = sum(s.stride for s in self.sides)
        if not stride or any(not s.fixed for s in self.sides):
            return None
        counts = (end - at) // stride
        if (counts * stride != end - at).any():
            return None
        event = np.repeat(np.arange(len(at)), counts)
        number = np.arange(len(event)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin, cells = at[event] + number * stride, []
        for side in self.sides:
            # A null bit would shorten its image, so none of the images that come first may have one.
            for b in range(side.null_bytes):
                known = 0xFF if b < len(side.present) // 8 else (1 << len(side.present) % 8) - 1
                if (data[begin + b] & known).any():
                    return None
            out, place = Cells.empty(len(event), side.n_cols), begin + side.null_bytes
            for _, i, size, _ in side.columns:
                out.begin[:, i], out.size[:, i] = place, size
                place = place + size
            cells.append(out)
            begin = begin + side.stride
        return event, number, cells

    def cut(self, data: np.ndarray, at: np.ndarray, end: np.ndarray):
        """(event, change number, cells per side, damaged events)."""
        found = self.strided(data, at, end)
        if found is not None:
            return *found, np.zeros(0, np.int64)
        events, numbers, cells, damaged = [], [], [[] for _ in self.sides], []
        active, at, number = np.flatnonzero(at < end), at.copy(), 0
        while len(active) >= LOCKSTEP:
            begun = place = at[active]
            own = []
            for side in self.sides:
                part, place = side.walk(data, place)
                own.append(part)
            bad = (place > end[active]) | (place == begun)
            damaged.append(active[bad])
            good = np.flatnonzero(~bad)
            events.append(active[good])
            numbers.append(np.full(len(good), number))
            for k, part in enumerate(own):
                cells[k].append(part.take(good))
            at[active] = place
            active = active[good]
            active = active[at[active] < end[active]]
            number += 1
        view = memoryview(data)
        for e in active.tolist():
            place, stop, n = int(at[e]), int(end[e]), number
            lists = [([], []) for _ in self.sides]
            while place < stop:
                begun = place
                for side, (begins, sizes) in zip(self.sides, lists, strict=True):
                    place = side.step(view, place, stop, begins, sizes) if place <= stop else place
                if place > stop or place == begun:
                    damaged.append(np.array([e]))
                    break
                n += 1
            rows = n - number
            if rows:
                events.append(np.full(rows, e))
                numbers.append(np.arange(number, n))
                for k, (begins, sizes) in enumerate(lists):
                    cells[k].append(Cells(np.array(begins[:rows], np.int64), np.array(sizes[:rows], np.int64)))
        if not events:
            none = np.zeros(0, np.int64)
            return none, none, [Cells.empty(0, s.n_cols) for s in self.sides], np.concatenate([none, *damaged])
        return (
            np.concatenate(events),
            np.concatenate(numbers),
            [Cells.joined(parts) for parts in cells],
            np.concatenate([np.zeros(0, np.int64), *damaged]),
        )

    def decode_json(self, data: np.ndarray, cells: Cells, ignore_errors: bool) -> tuple[np.ndarray, np.ndarray]:
        """``data`` with the documents' texts behind it, ``cells`` moved to them; also rows whose document is damaged."""
        texts, at, damaged, view = [], len(data), [], memoryview(data)
        for i in self.json:
            for row in np.flatnonzero(cells.size[:, i] > 0).tolist():
                begin = int(cells.begin[row, i])
                try:
                    text = json_text(bytes(view[begin : begin + int(cells.size[row, i])]), ignore_errors)
                except _JSON_ERRORS:
                    damaged.append(row)
                    continue
                if text is None:
                    cells.size[row, i] = -1
                else:
                    cells.begin[row, i], cells.size[row, i] = at, len(text)
                    texts.append(text)
                    at += len(text)
        if texts:
            data = np.concatenate([data, np.frombuffer(b"".join(texts), np.uint8)])
        return data, np.array(damaged, np.int64)


def cell_lists(data: np.ndarray, cells: Cells) -> pa.Array:
    """Arrow lists of cells: one copy of the bytes, no object per cell."""
    rows, columns = cells.size.shape
    begin, size = cells.begin.ravel(), cells.size.ravel()
    there = size >= 0
    length = np.where(there, size, 0)
    offsets = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    source = np.repeat(begin - offsets[:-1], length) + np.arange(offsets[-1])
    values = pa.BinaryArray.from_buffers(
        pa.binary(),
        len(length),
        [
            pa.py_buffer(np.packbits(there, bitorder="little")),
            pa.py_buffer(offsets.astype(np.int32)),
            pa.py_buffer(data[source]),
        ],
    )
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * columns), values)


def kinds(columns: list[pa.Array]) -> np.ndarray:
    """A number per row that tells which rows agree in all columns."""
    code = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        known = column.dictionary_encode()
        own = known.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        code = code * (len(known.dictionary) + 1) + own
        if code.size and code.max() > 1 << 40:
            code = np.unique(code, return_inverse=True)[1].reshape(-1).astype(np.int64)
    return code


def chunks(sizes: np.ndarray, most: int = CHUNK_BYTES) -> list[np.ndarray]:
    """Row numbers in runs of about ``most`` bytes, of one row at least."""
    part = (np.cumsum(sizes) - sizes) // most
    return np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(part)) + 1)
