"""Packing documents into training sequences of a fixed number of tokens.

Pattern packing by non-negative least squares. Only documents longer than a
sequence are cut. The histogram of piece lengths (at most ``capacity`` numbers,
whatever the input) goes to the driver, which

1. enumerates patterns of one, two or three lengths that fill a sequence exactly;
2. fits non-negative repeat counts to the histogram (multiplicative updates);
3. rounds them down to what the histogram holds, then packs the rest by best fit,
   longest first, working on counts of equal lengths and equal gaps.

The plan is a table of ranges "pieces number a to b of this length go to the
sequences from s on, at offset o". Its size depends on ``capacity`` and
``max_patterns`` only. Pieces are numbered within their length by counts per
(length, bucket), so a length that a third of all rows share is no single task.

A null text is an empty one: a piece of just the end id. Repeated rows are pieces
of their own. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidelog.llm.common import Cache, map_batches, source
from tidelog.session import settle

#: Distinct words whose ids one worker keeps.
CACHE = 400_000
#: Rows of one numbering bucket, about.
BUCKET_ROWS = 100_000
#: Patterns of three lengths that are tried; more are thinned evenly.
MAX_PATTERNS = 40_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

# Letters without composing marks, whose lower case is one letter of the same kind, then
# ASCII marks other than those of contractions and special tokens: the letters are one
# pre-token of the tokenizer and the marks another.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]*)")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(others)}


class WordTokenizer:
    """Ids of whole texts from cached ids of words.

    For byte-level tokenizers that lower-case and whose pre-tokens never cross white space.
    The texts are cut and their distinct words found in Arrow; the library sees each
    distinct word once while it is cached. A word of plain letters and trailing marks
    goes to the library's model in these two parts, any other word to the whole
    library as it stands.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok, self.cache, self.marks = Tokenizer.from_file(path), Cache(CACHE), Cache(1 << 12)
        self.model, self.letters = self.tok.model, _byte_letters()

    def _whole(self, words: list[str]) -> list[bytes]:
        found = self.tok.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _letters(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _make(self, words: list[str]) -> list[bytes]:
        parts = [_PLAIN.fullmatch(w) for w in words]
        made = {w: self._letters(w) for w in {m[1].lower() for m in parts if m}}
        tail = self.marks.fetch({m[2] for m in parts if m}, self._whole)
        odd = iter(self._whole([w for w, m in zip(words, parts, strict=True) if not m]))
        return [made[m[1].lower()] + tail(m[2]) if m else next(odd) for m in parts]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (little-endian unsigned 32-bit) and where each text's begin; null is empty."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten().dictionary_encode()
        known = words.dictionary.to_pylist()
        ids = list(map(self.cache.fetch(known, self._make), known))
        begin = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4, out=begin[1:])
        joined = pa.array(np.frombuffer(b"".join(ids), "<u4"))
        rows = pa.LargeListArray.from_arrays(pa.array(begin), joined).take(words.indices)
        at = rows.offsets.to_numpy()[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return rows.values.to_numpy()[at[0] :], at - at[0]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def cut_pieces(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids; the end id closes each document."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batch: pa.RecordBatch):
        out = []
        ids, begin = tokenizer(path).encode(batch.column(1))
        data, begin = memoryview(ids.tobytes()), (4 * begin).tolist()
        for doc, a, b in zip(batch.column(0).to_pylist(), begin, begin[1:], strict=False):
            ids = bytes(data[a:b]) + end
            for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                out.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
        return list(zip(*out, strict=True)) if out else None

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, PIECES)


def patterns(lengths: np.ndarray, capacity: int, most: int) -> np.ndarray:
    """Rows of three lengths (0: none) that add up to the capacity, from the lengths there are."""
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    own = np.flatnonzero(there)
    rows = [np.array([[capacity, 0, 0]])] if there[capacity] else []
    pair = own[(own <= capacity // 2) & there[capacity - own]]
    rows.append(np.stack([pair, capacity - pair, 0 * pair], 1))
    # By first length: all pairs of lengths at once would take hundreds of MB.
    small, middle = own[3 * own <= capacity], []
    for a in small:
        b = own[(own >= a) & (2 * own <= capacity - a)]
        middle.append(b[there[capacity - a - b]])
    a = np.repeat(small, [len(b) for b in middle])
    b = np.concatenate([np.zeros(0, np.int64), *middle])
    if len(a) > most:
        some = np.linspace(0, len(a) - 1, most).astype(np.int64)
        a, b = a[some], b[some]
    return np.concatenate([*rows, np.stack([a, b, capacity - a - b], 1)])


def fit(rows: np.ndarray, hist: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Non-negative least squares: repeats of each pattern that come closest to the histogram."""
    target = hist.astype(float)
    target[0] = 0
    used = rows > 0
    toward = (target[rows] * used).sum(1)
    x = np.full(len(rows), max(1e-3, target.sum() / max(1, used.sum())))
    for _ in range(rounds):
        made = np.bincount(rows.ravel(), np.repeat(x, 3) * used.ravel(), len(hist))
        made[0] = 0
        x *= toward / np.maximum((made[rows] * used).sum(1), 1e-12)
    return x


def plan(hist: np.ndarray, capacity: int = 4096, most: int = MAX_PATTERNS) -> tuple[np.ndarray, int]:
    """Ranges (length, first number, count, first sequence, offset), and how many sequences.

    hist[n]: pieces of length n.
    """
    left, used, ranges, sequences = hist.astype(np.int64).copy(), np.zeros(capacity + 1, np.int64), [], 0

    def put(length: int, count: int, sequence: int, offset: int) -> None:
        ranges.append((length, int(used[length]), count, sequence, offset))
        used[length] += count
        left[length] -= count

    rows = patterns(np.flatnonzero(left), capacity, most)
    x = fit(rows, left) if len(rows) else np.zeros(0)
    for share in (np.floor(x), np.round(x) - np.floor(x)):
        for k in np.argsort(-x, kind="stable"):
            if x[k] < 0.5:
                break
            lengths = [n for n in rows[k].tolist() if n]
            count = min([int(share[k]), *(int(left[n]) // lengths.count(n) for n in lengths)])
            if count > 0:
                at = 0
                for n in lengths:
                    put(n, count, sequences, at)
                    at += n
                sequences += count

    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # runs of sequences by free space
    free = np.zeros(capacity + 1, bool)
    for n in range(capacity, 0, -1):
        while left[n]:
            best = n + int(np.argmax(free[n:]))
            if free[best]:
                first, run = gaps[best].pop()
                count = min(run, int(left[n]))
                if run > count:
                    gaps[best].append((first + count, run - count))
                free[best] = bool(gaps[best])
                rest = best - n
            else:
                per = capacity // n
                count = max(1, int(left[n]) // per)
                first, rest = sequences, capacity - n
                sequences += count
            put(n, count, first, capacity - rest - n)
            if rest:
                gaps[rest].append((first, count))
                free[rest] = True
    return np.array(sorted(ranges), np.int64).reshape(-1, 5), sequences


def pack(pieces: DataFrame, capacity: int = 4096, most: int = MAX_PATTERNS) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``. ``pieces`` is read three times: settle it."""
    hist = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        hist[r["length"]] = r["count"]
    ranges, _ = plan(hist, capacity, most)
    keys = (ranges[:, 0] << 44) + ranges[:, 1]

    key = ["doc_id", "piece", "start", "ids_crc32"]
    buckets = max(1, int(hist.sum()) // BUCKET_ROWS)
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    before = (
        dealt.groupBy("length", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(W.partitionBy("length").orderBy("_bucket")) - F.col("_n"))
        .drop("_n")
    )
    number = F.row_number().over(W.partitionBy("length", "_bucket").orderBy(*key)) - 1
    numbered = dealt.withColumn("_row", number).join(before, ["length", "_bucket"])
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("_row")).alias("n"))

    def place(batch: pa.RecordBatch):
        if not batch.num_rows:
            return None
        length, n = batch.column(3).to_numpy(), batch.column(5).to_numpy()
        at = np.searchsorted(keys, (length << 44) + n, "right") - 1
        if (ranges[at, 0] != length).any() or (n - ranges[at, 1] >= ranges[at, 2]).any():
            raise ValueError("a piece has no place in the plan")
        return [*batch.columns[:5], ranges[at, 3] + n - ranges[at, 1], ranges[at, 4]]

    return map_batches(numbered, place, f"{PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = 4096, end_id: int = 1, path: str | None = None) -> DataFrame:
    """One row per piece of every document with its sequence and place."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return pack(settle(cut_pieces(docs, path, capacity, end_id), "pieces"), capacity)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(source(spark, sf_dir, "documents"))
