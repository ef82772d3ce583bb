"""Removal of passages that an earlier document has, by FM-index search per shard.

A word goes if a window of ``WIDTH`` words that holds it also starts in a document
with a smaller id. Searching every document in every shard would take the square of
the input, so windows are routed: the anchor of a window is the leftmost of its
``ANCHOR``-word runs with the smallest hash. Equal windows have equal anchors, so each
window is searched in one shard only. Neighbouring windows with one anchor make a
passage, about 20 windows long.

1. ``passages`` lists each document's passages as hashes. Anchors of one document only
   are dropped, which leaves what is repeated.
2. Equal passages are one class, owned by its first document: in every other document
   the whole passage goes.
3. Where an anchor has several classes, their words are fetched and dealt to shards by
   anchor, about ``SHARD_WORDS`` words each. A shard builds the index (``fm_index``) and
   streams its passages backwards through it; matches of ``WIDTH`` words give the
   smallest owner, and windows with an owner before their own go.
4. Anchors with more than ``HOT`` classes (a passage that very many documents share in
   different surroundings) are cut into windows, each a row of its 128-bit hash. The
   smallest owner of each is counted before the shuffle and joined back to its rows, so
   a window of any number of documents is no single task.

Anchors, passages and windows are met by 64-bit hashes of words; equality of windows
within a shard is decided on the words themselves, that of hot ones on 128 bits of hash.

A null text has no words. Rows with a null id lose nothing and take nothing away.
Rows with one id are one document: it takes nothing from itself. Other columns are
kept as they are; ``n_words``, ``n_removed`` and ``kept_sha256`` must not be among them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import gram_hashes, hashes, map_batches, mix, source, words_of
from tidelog.llm.fm_index import FMIndex
from tidelog.llm.rewrite import keyed, rewrite
from tidelog.session import settle, settle_alone

WIDTH = 50
ANCHOR = 12
SHARD_WORDS = 200_000
HOT = 5_000

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n-word windows by doubling: few steps for wide windows."""
    if len(h) < n:
        return h[:0]
    level, span, out, done = mix(h + np.uint64(n)), 1, None, 0
    odd = np.uint64(0x9E3779B97F4A7C15)
    size = len(h) - n + 1
    while True:
        if n & span:
            part = level[done : done + size]
            out = part if out is None else mix(out * odd + part)
            done += span
        if span * 2 > n:
            return out
        level = mix(level[:-span] * odd + level[span:])
        span *= 2


def cut_passages(h: np.ndarray, width: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window, anchor hash and own hash of each passage of a text."""
    if len(h) < width:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    grams = window_hashes(h, anchor)
    view = np.lib.stride_tricks.sliding_window_view(grams, width - anchor + 1)
    place = np.arange(len(view)) + view.argmin(1)
    first = np.flatnonzero(np.concatenate(([True], np.diff(place) != 0)))
    last = np.append(first[1:], len(place)) - 1
    whole = window_hashes(h, width)
    own = mix(whole[first] * np.uint64(0xC4CEB9FE1A85EC53) + mix(whole[last] + (last - first).astype(np.uint64)))
    return first, last, grams[place[first]].view(np.int64), own.view(np.int64)


def passages(docs: DataFrame, width: int, anchor: int) -> DataFrame:
    """(doc_id, print, first, last, anchor, passage): windows first to last share an anchor."""

    def run(batch: pa.RecordBatch):
        out, reps = [], []
        for text in batch.column(2).to_pylist():
            cut = cut_passages(hashes(words_of(text)), width, anchor)
            out.append(cut)
            reps.append(len(cut[0]))
        if not sum(reps):
            return None
        first, last, anchors, own = (np.concatenate(c) for c in zip(*out, strict=True))
        at = pa.array(np.repeat(np.arange(len(reps)), reps))
        return [batch.column(0).take(at), batch.column(1).take(at), first.astype(np.int32), last.astype(np.int32), anchors, own]

    return map_batches(keyed(docs), run, "doc_id long, print long, first int, last int, anchor long, passage long")


def _contents(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The words of wanted passages; of hot ones, the hash of each window."""
    by_doc = wanted.groupBy("doc_id", "print").agg(
        F.collect_list("anchor").alias("anchors"), F.collect_list("passage").alias("own"),
        F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"), F.collect_list("hot").alias("hots"),
    )
    met = keyed(docs).join(by_doc, ["doc_id", "print"])

    def run(batch: pa.RecordBatch):
        out = []
        for r in batch.to_pylist():
            words = words_of(r["text"])
            for anchor, own, a, b, hot in zip(r["anchors"], r["own"], r["firsts"], r["lasts"], r["hots"], strict=True):
                part = words[a : b + width]
                if not hot:
                    out.append((anchor, own, r["doc_id"], 0, False, b" ".join(part)))
                    continue
                for k in range(len(part) - width + 1):
                    out.append((anchor, own, r["doc_id"], k, True, xxhash.xxh3_128_digest(b" ".join(part[k : k + width]))))
        return list(zip(*out, strict=True)) if out else None

    return map_batches(met, run, "anchor long, passage long, owner long, at int, hot boolean, words binary")


def search_shard(width: int) -> Callable:
    """One shard: index its passages, stream them, report words (from, to) that go."""

    def run(table):
        schema = pa.schema([("anchor", pa.int64()), ("passage", pa.int64()), ("owner", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])
        rows = list(zip(*(table[c].to_pylist() for c in ("anchor", "passage", "owner", "at", "words")), strict=True))
        numbers: dict[bytes, int] = {}
        texts = [
            np.array([numbers.setdefault(w, len(numbers) + 1) for w in r[4].split()], np.int64) for r in rows
        ]
        index = FMIndex(texts, np.array([r[2] for r in rows], np.int64), width)
        out = []
        for (anchor, own, owner, at, _), found in zip(rows, index.window_owners(texts), strict=True):
            gone = np.flatnonzero(found < owner)
            if not len(gone):
                continue
            breaks = np.flatnonzero(np.diff(gone) > 1)
            begins, ends = gone[np.append(0, breaks + 1)], gone[np.append(breaks, len(gone) - 1)]
            out += [(anchor, own, owner, at + a, at + b + width) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def late_windows(windows: DataFrame, width: int) -> DataFrame:
    """Words (from, to) of the windows that a smaller owner has, too."""
    # Written first, so that the join is of plain shuffles, which can be split at a hot window.
    low = settle(windows.groupBy("anchor", "words").agg(F.min("owner").alias("low")), "window_owners")
    met = windows.join(low, ["anchor", "words"]).filter("low < owner")
    return met.select("anchor", "passage", "owner", F.col("at").alias("a"), (F.col("at") + width).alias("b"))


def repeated_spans(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, hot: int = HOT, shard: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, print, marks): the words [a, b) of each document that go. What else it writes is dropped."""
    return settle_alone(lambda: _repeated_spans(docs, width, anchor, hot, shard), "spans")


def _shared(docs: DataFrame, width: int, anchor: int) -> DataFrame:
    """Passages whose anchor several documents have."""
    rows = settle(passages(docs, width, anchor), "passages")
    shared = rows.groupBy("anchor").agg((F.min("doc_id") != F.max("doc_id")).alias("shared")).filter("shared")
    # Written first, so that both sides of the joins by anchor are plain shuffles, which can be split at a hot anchor.
    return rows.join(settle(shared.select("anchor"), "shared_anchors"), "anchor")


def _classes(rows: DataFrame) -> DataFrame:
    """Each distinct passage with its first place and how many its anchor has."""
    one = F.min(F.struct("doc_id", "print", "first", "last")).alias("one")
    classes = settle(rows.groupBy("anchor", "passage").agg(one), "classes")
    many = settle(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")), "anchors")
    return classes.join(many, "anchor").select("anchor", "passage", "n", "one.*")


def _repeated_spans(docs: DataFrame, width: int, anchor: int, hot: int, shard: int) -> DataFrame:
    rows = settle_alone(lambda: _shared(docs, width, anchor), "shared")
    classes = settle_alone(lambda: _classes(rows), "passage_classes")

    whole = rows.join(classes.select("anchor", "passage", F.col("doc_id").alias("owner")), ["anchor", "passage"])
    whole = whole.filter("doc_id > owner").select("doc_id", "print", F.col("first").alias("a"), (F.col("last") + width).alias("b"))

    wanted = classes.filter("n > 1").withColumn("hot", F.col("n") > hot)
    words = F.when(~F.col("hot"), F.col("last") - F.col("first") + width)
    size = wanted.agg(F.sum(words).alias("s"), F.max("n").alias("n")).first()
    shards = max(1, -(-(size["s"] or 0) // shard))
    contents, late = _contents(docs, wanted, width), None
    if (size["n"] or 0) > hot:
        contents = settle(contents, "contents")
        late = late_windows(contents.filter("hot"), width)
        contents = contents.filter("not hot")
    dealt = contents.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    found = dealt.groupBy("shard").applyInArrow(
        search_shard(width), "anchor long, passage long, owner long, a int, b int"
    )
    found = found if late is None else found.unionByName(late)
    parts = rows.join(found.distinct().withColumnRenamed("owner", "doc_id"), ["anchor", "passage", "doc_id"])
    parts = parts.select("doc_id", "print", (F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b")).alias("b"))
    return whole.unionByName(parts).groupBy("doc_id", "print").agg(F.collect_list(F.struct("a", "b")).alias("marks"))


def _without(text: str, spans: list[dict]) -> tuple[str, int, int, str]:
    """Text without the words of the spans, its words before, words gone, digest of the rest."""
    data = text.encode()
    if not spans:
        words = data.split()
        return text, len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest()
    at = [m.span() for m in _WORD.finditer(data)]
    edge = np.zeros(len(at) + 1, np.int64)
    np.add.at(edge, [s["a"] for s in spans], 1)
    np.add.at(edge, [s["b"] for s in spans], -1)
    keep = np.cumsum(edge)[:-1] == 0
    change = np.flatnonzero(np.diff(np.concatenate(([0], keep.astype(np.int8), [0]))))
    parts = [data[at[a][0] : at[b - 1][1]] for a, b in change.reshape(-1, 2).tolist()]
    digest = hashlib.sha256(b" ".join(b" ".join(p.split()) for p in parts)).hexdigest()
    return b" ".join(parts).decode(), len(at), int(len(at) - keep.sum()), digest


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """The documents, columns as before, with what is left as ``text``; and ``n_words``
    (before), ``n_removed``, ``kept_sha256`` (of the kept words, joined by one space)."""
    extra = [("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string")]
    return rewrite(docs, repeated_spans(docs, **options), _without, extra)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = source(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
