"""Hierarchical packing of documents into sequences of several context sizes.

1. **Route.** A document's ids are cut into full windows of the largest context; the rest
   goes to the tier of the smallest context that holds it.
2. **Pack each tier.** Longest first, a rest opens a window of its tier,
3. **fill gaps:** unless it fits into the gap of an open window, the smallest that holds it,
   which is how shorter tiers fill the gaps of longer windows. Gaps that are left then are
   closed exactly: the emptiest windows are dissolved and their pieces cut to measure.
   What remains at the end, less than one window and its donors, is cut into windows of
   falling powers of two. So no sequence needs padding, and only pieces of dissolved
   windows are cut.
4. **Balance step groups.** Sequences of each tier are dealt evenly to steps of about
   ``step_tokens`` tokens, so every step has the same mix of tiers; numbers rise with the step.

Steps 2 to 4 work on counts of equal lengths: a histogram of at most ``capacity`` numbers goes to
the driver, whatever the input, and comes back as a table of ranges. Pieces are
numbered by (task that wrote them, length) while they are written, so numbering takes no
shuffle and a length, text or id that many rows share is no group of its own.

A null text is an empty one: just the end id. Repeated rows and null ids are documents of
their own. An empty table gives an empty result. Extra columns are ignored. A very long
text is many full windows and one rest.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidelog.llm.common import arrow_type, source
from tidelog.llm.packing import tokenizer
from tidelog.session import settle

CAPACITY = 2048
CONTEXTS = (256, 512, 1024, 2048)
#: Tokens of one step group, about.
STEP_TOKENS = 1 << 20

RESTS = "doc_id long, start long, length long, doc_tokens long, crc long, ids binary, task int, number long"
PLACED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "context int, step long"
)


class Part(NamedTuple):
    """Places ``at`` to ``at + size`` of pieces number ``first``, ``first`` + 1, ... of one length."""

    length: int
    at: int
    size: int
    first: int

    def skip(self, count: int) -> Part:
        return self._replace(first=self.first + count)


class Run(NamedTuple):
    """``count`` windows filled alike; window k holds piece number first + k of each part."""

    count: int
    context: int
    parts: tuple[Part, ...]
    gap: int

    def split(self, count: int) -> tuple[Run, Run]:
        return self._replace(count=count), self._replace(
            count=self.count - count, parts=tuple(p.skip(count) for p in self.parts)
        )

    def add(self, part: Part) -> Run:
        return self._replace(parts=(*self.parts, part), gap=self.gap - part.size)


def first_fill(hist: np.ndarray, contexts: tuple[int, ...]) -> list[Run]:
    """Whole pieces, longest first, into the smallest gap or a new window of their tier."""
    top = contexts[-1]
    gaps: list[list[Run]] = [[] for _ in range(top + 1)]
    free = np.zeros(top + 1, bool)
    for n in range(top, 0, -1):
        left, number = int(hist[n]), 0
        tier = next(c for c in contexts if c >= n)
        while left:
            best = n + int(np.argmax(free[n:]))
            if free[best]:
                run = gaps[best].pop()
                if run.count > left:
                    run, rest = run.split(left)
                    gaps[best].append(rest)
                free[best] = bool(gaps[best])
            else:
                run = Run(max(1, left // (tier // n)), tier, (), tier)
            run = run.add(Part(n, 0, n, number))
            number, left = number + run.count, left - run.count
            gaps[run.gap].append(run)
            free[run.gap] = run.gap > 0
    return [run for runs in gaps for run in runs]


def close_gaps(runs: list[Run]) -> list[Run]:
    """All windows filled to the last token; pieces of the emptiest windows are cut to measure."""
    full = [r for r in runs if not r.gap]
    # By share of the window that is empty; the fullest are served first.
    share = lambda r: r.gap / r.context
    waiting = deque(sorted((r for r in runs if r.gap), key=share))
    pool: list[tuple[Part, int]] = []

    while waiting:
        run = waiting.popleft()
        if not pool:
            if waiting:
                donor = waiting.pop()
                need = -(-run.count * run.gap // (donor.context - donor.gap))
                if need < donor.count:
                    donor, rest = donor.split(need)
                    waiting.append(rest)
            else:  # the last run: some of its windows give to the others
                need = -(-run.count * run.gap // run.context)
                if need == run.count:
                    return full + powers([(p, run.count) for p in run.parts])
                donor, run = run.split(need)
            pool = [(p, donor.count) for p in donor.parts]
        part, count = pool.pop()
        if count > run.count:
            pool.append((part.skip(run.count), count - run.count))
        elif count < run.count:
            run, rest = run.split(count)
            waiting.appendleft(rest)
        size = min(part.size, run.gap)
        if size < part.size:
            pool.append((part._replace(at=part.at + size, size=part.size - size), run.count))
        run = run.add(part._replace(size=size))
        if run.gap:
            waiting.appendleft(run)
        else:
            full.append(run)
    return full + powers(pool)


def powers(pieces: list[tuple[Part, int]]) -> list[Run]:
    """Less than one window of pieces in a row, cut into windows that are powers of two, the largest first."""
    queue = deque(part.skip(k) for part, count in pieces for k in range(count))
    left, out = sum(p.size for p in queue), []
    while left:
        size = 1 << (left.bit_length() - 1)
        run = Run(1, size, (), size)
        while run.gap:
            part = queue.popleft()
            if part.size > run.gap:
                queue.appendleft(part._replace(at=part.at + run.gap, size=part.size - run.gap))
                part = part._replace(size=run.gap)
            run = run.add(part)
        out.append(run)
        left -= size
    return out


def plan(hist: np.ndarray, contexts: tuple[int, ...] = CONTEXTS) -> tuple[np.ndarray, dict[int, int]]:
    """Ranges (length, at, first number, count, size, window index, offset, context) and windows per context.

    ``hist[n]``: rests of length n. Windows are counted per context.
    """
    runs = close_gaps(first_fill(hist, contexts))
    used: dict[int, int] = {}
    rows = []
    for run in runs:
        window, offset = used.get(run.context, 0), 0
        used[run.context] = window + run.count
        for p in run.parts:
            rows.append((p.length, p.at, p.first, run.count, p.size, window, offset, run.context))
            offset += p.size
    return np.array(sorted(rows), np.int64).reshape(-1, 8), used


class Steps:
    """Window number k of a context to its step and sequence number.

    Context c has n of all windows; they are dealt to the steps evenly, and within a step
    contexts follow each other from long to short.
    """

    def __init__(self, windows: dict[int, int], step_tokens: int):
        total = sum(c * n for c, n in windows.items())
        self.steps = max(1, -(-total // step_tokens))
        self.order = sorted(windows, reverse=True)
        self.windows = windows

    def _before(self, context: int, step: np.ndarray) -> np.ndarray:
        """Windows of the context in the steps before: the k with k * steps // n < step."""
        return -(-step * self.windows[context] // self.steps)

    def step(self, context: int, k: np.ndarray) -> np.ndarray:
        return k * self.steps // self.windows[context]

    def place(self, context: int, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        step = self.step(context, k)
        number = k - self._before(context, step)
        for c in self.order:
            number = number + self._before(c, step + (c > context))
        return step, number


def cut_documents(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Full windows and rests of all documents, numbered per writing task and length."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, task, seen = arrow_type(RESTS), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids, begin = tokenizer(path).encode(batch.column(1))
            data, begin, out = memoryview(ids.tobytes()), (4 * begin).tolist(), []
            for doc, a, b in zip(batch.column(0).to_pylist(), begin, begin[1:], strict=False):
                own = bytes(data[a:b]) + end
                total = len(own) // 4
                for start in range(0, total, capacity):
                    part = own[4 * start : 4 * (start + capacity)]
                    n = len(part) // 4
                    # A full window is never cut: its ids need not be kept.
                    out.append((doc, start, n, total, zlib.crc32(part), part if n < capacity else None, task, int(seen[n])))
                    seen[n] += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, RESTS)


def pack(rests: DataFrame, capacity: int = CAPACITY, contexts: tuple[int, ...] = CONTEXTS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pieces with their sequences. ``rests`` is read three times: settle it."""
    if tuple(sorted(contexts)) != tuple(contexts) or contexts[-1] != capacity or any(c & (c - 1) for c in contexts):
        raise ValueError("contexts are rising powers of two, the last one the capacity")
    hist = np.zeros(capacity + 1, np.int64)
    for r in rests.groupBy("length").count().collect():  # at most ``capacity`` rows
        hist[r["length"]] = r["count"]
    ranges, windows = plan(hist, contexts)
    steps = Steps(windows, step_tokens)
    # Ranges of one length and place in the piece are one class; class and number are one sorted key.
    classes, of = np.unique(ranges[:, 0] * (capacity + 1) + ranges[:, 1], return_inverse=True)
    keys = (of.reshape(-1) << 44) + ranges[:, 2]

    counts = rests.groupBy("task", "length").agg(F.count(F.lit(1)).alias("_n"))
    along = W.partitionBy("length").orderBy("task")
    before = counts.select("task", "length", (F.sum("_n").over(along) - F.col("_n")).alias("_before"))
    named = rests.join(before, ["task", "length"])
    columns = ["doc_id", "start", "length", "doc_tokens", "crc", "ids", (F.col("_before") + F.col("number")).alias("n")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_type(PLACED)
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, ids = batch.column(0), batch.column(5)
            start, length, tokens, crc, n = (batch.column(k).to_numpy() for k in (1, 2, 3, 4, 6))
            row, at = np.arange(len(n)), np.zeros(len(n), np.int64)
            found = []
            while len(row):  # once, and again for what is left of cut pieces
                of = np.searchsorted(classes, length[row] * (capacity + 1) + at)
                entry = np.searchsorted(keys, (of << 44) + n[row], "right") - 1
                e = ranges[entry]
                if (e[:, 0] != length[row]).any() or (e[:, 1] != at).any() or (n[row] - e[:, 2] >= e[:, 3]).any():
                    raise ValueError("a piece has no place in the plan")
                found.append((row, at, e, n[row] - e[:, 2] + e[:, 5]))
                at = at + e[:, 4]
                more = at < length[row]
                row, at = row[more], at[more]
            row, at, window = (np.concatenate([f[k] for f in found]) for k in (0, 1, 3))
            e = np.concatenate([f[2] for f in found])
            step, number = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
            for c in np.unique(e[:, 7]):
                mine = e[:, 7] == c
                step[mine], number[mine] = steps.place(int(c), window[mine])
            size, sums = e[:, 4], crc[row].copy()
            for k in np.flatnonzero(size < length[row]).tolist():
                data = ids[int(row[k])].as_buffer()
                sums[k] = zlib.crc32(memoryview(data)[4 * at[k] : 4 * (at[k] + size[k])])
            parts = [doc.take(pa.array(row)), start[row] + at, size, sums, tokens[row], number, e[:, 6], e[:, 7].astype(np.int32), step]
            yield pa.RecordBatch.from_arrays([p if isinstance(p, pa.Array) else pa.array(p) for p in parts], schema=schema)

    return named.select(*columns).mapInArrow(place, PLACED)


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    contexts: tuple[int, ...] = CONTEXTS,
    step_tokens: int = STEP_TOKENS,
    end_id: int = 1,
    path: str | None = None,
) -> DataFrame:
    """One row per piece: its document, place there, checksum, sequence, place there, context and step."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return pack(settle(cut_documents(docs, path, capacity, end_id), "rests"), capacity, contexts, step_tokens)


def op13_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(source(spark, sf_dir, "documents"))
