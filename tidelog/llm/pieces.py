"""SentencePiece encoding and decoding that keeps track of source bytes.

The normaliser walks the text with the model's compiled character map (a double
array trie): at each place the longest prefix found is replaced by its target,
anything else stays. Each normalised byte records the source byte it came from,
so a piece, which is a run of normalised bytes, projects to a span of source bytes.

Segmentation: merges never cross two neighbouring characters that stand side by
side in no piece of the vocabulary. So the normalised text falls into chunks (at
word marks, line feeds, and full stops or commas after a letter, each only if the
vocabulary has no piece across) that are encoded independently, once per distinct
chunk, and kept in a bounded cache. For other vocabularies the text is one chunk.

A null text is an empty one (begin and end ids only). Rows are independent, so
repeated rows, ties and an empty table need no rule; extra columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import Cache, list_array, map_batches, source

MARK = "▁"
CACHE = 400_000
CUT = "\x1f"


class CharMap:
    """The compiled character map: trie units, then zero-ended targets."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.targets = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes matched at ``at`` and their target."""
        units, found = self.units, None
        if not units:
            return None
        unit = units[0]
        node = (unit >> 10) << ((unit & 0x200) >> 6)
        for k in range(at, len(data)):
            node ^= data[k]
            unit = units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                found = (k + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        length, start = found
        return length, self.targets[start : self.targets.index(b"\0", start)]


class Codec:
    def __init__(self, model: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        proto = pb.ModelProto()
        proto.ParseFromString(self.sp.serialized_model_proto())
        spec = proto.normalizer_spec
        self.map = CharMap(spec.precompiled_charsmap)
        self.dummy, self.collapse = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.escaped = spec.escape_whitespaces
        kinds = [p.type for p in proto.pieces]
        pieces = [p.piece for p in proto.pieces]
        # User-defined pieces are matched before anything else: such texts stay whole.
        self.split = not any(MARK in p.lstrip(MARK) for p in pieces) and 4 not in kinds and self.escaped and self.dummy
        # Normalised bytes a piece stands for: a byte piece one, a control piece none.
        self.width = np.array(
            [0 if k == 3 else 1 if k == 6 else len(p.encode()) for p, k in zip(pieces, kinds, strict=True)], np.int64
        )
        self.unknown = kinds.index(2)
        self.cache = Cache(CACHE)
        self.chunk = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        joined = {pair for p, k in zip(pieces, kinds, strict=True) if k == 1 for pair in zip(p, p[1:], strict=False)}
        self.stops = "".join(c for c in ".," if not any(b == c and a.isalpha() for a, b in joined))
        before = {a for a, b in joined if b in self.stops} | {MARK}
        self.whole = re.compile(f"{MARK}{MARK}|{CUT}|[{re.escape(''.join(sorted(before)))}][{self.stops or CUT}]")
        self.breaks = not any("\n" in pair for pair in joined)
        # Chunks carry their own marks, so the library must not put one.
        spec.add_dummy_prefix = False
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.bos, self.eos = self.sp.bos_id(), self.sp.eos_id()

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them and the end its source byte."""
        data = text.encode()
        mark = MARK.encode() if self.escaped else b" "
        if not self.map.units and not self.collapse:
            if not data:
                return b"", np.zeros(1, np.int64)
            raw = np.frombuffer(data, np.uint8)
            width = np.where(raw == 32, len(mark), 1)
            align = np.repeat(np.arange(len(raw)), width)
            head = mark if self.dummy else b""
            return head + data.replace(b" ", mark), np.concatenate(([0] * len(head), align, [len(data)]))
        out, align, at = [], [], 0
        space = True  # extra white space at the start goes
        while at < len(data):
            hit = self.map.longest(data, at)
            if hit is None:
                lead = data[at]
                length = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                target = data[at : at + length]
            else:
                length, target = hit
            if self.collapse:
                while space and target.startswith(b" "):
                    target = target[1:]
            if target:
                if self.dummy and not out:
                    out.append(mark)
                    align += [at] * len(mark)
                shown = target.replace(b" ", mark)
                out.append(shown)
                align += [at] * len(shown)
                space = target.endswith(b" ")
            at += length
        joined = b"".join(out)
        end = len(data)
        if self.collapse:
            while joined.endswith(mark):
                joined = joined[: -len(mark)]
                end = align[len(joined)]
                align = align[: len(joined)]
        return joined, np.array([*align, end], np.int64)

    def _chunks(self, text: str) -> list[str]:
        if self.whole.search(text):
            return self.chunk.findall(text)
        text = text.replace(MARK, CUT + MARK)
        for stop in self.stops:
            text = text.replace(stop, CUT + stop)
        if self.breaks:
            text = text.replace("\n", f"{CUT}\n{CUT}")
        return text.split(CUT)

    def _make(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks as little-endian 32-bit integers."""
        ids = self.bare.encode([c.replace(MARK, " ") for c in chunks], num_threads=1)
        return [np.array(i, "<u4").tobytes() for i in ids]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per text: ids with begin and end id, and per id its source bytes [begin, end)."""
        norm = [self.normalise(t) for t in texts]
        if self.split:
            chunks = [self._chunks(n.decode()) for n, _ in norm]
            look = self.cache.fetch({c for row in chunks for c in row}, self._make)
            bodies = [b"".join(map(look, row)) for row in chunks]
        else:
            bodies = [np.array(i, "<u4").tobytes() for i in self.sp.encode(texts, num_threads=1)]
        out = []
        for body, (joined, align) in zip(bodies, norm, strict=True):
            ids = np.frombuffer(body, "<u4")
            ends = np.cumsum(self.width[ids]) if len(ids) else np.zeros(0, np.int64)
            if self.unknown in ids:
                ends = self._unknown_ends(ids, joined)
            if len(ends) and ends[-1] != len(joined):
                raise ValueError(f"pieces cover {ends[-1]} of {len(joined)} normalised bytes")
            begins = np.concatenate(([0], ends))[:-1].astype(np.int64) if len(ends) else ends
            ids = np.concatenate(([self.bos], ids, [self.eos])).astype("<u4")
            last = align[-1]
            out.append((ids, np.concatenate(([0], align[begins], [last])), np.concatenate(([0], align[ends], [last]))))
        return out

    def _unknown_ends(self, ids: np.ndarray, joined: bytes) -> np.ndarray:
        """An unknown piece runs up to where the next known piece is found."""
        ends, at = [], 0
        for k, i in enumerate(ids.tolist()):
            if i != self.unknown:
                at += int(self.width[i])
            else:
                rest = ids[k + 1 :].tolist()
                known = next((x for x in rest if x != self.unknown), None)
                at = len(joined) if known is None else joined.index(self.sp.id_to_piece(known).encode(), at + 1)
            ends.append(at)
        return np.array(ends, np.int64)

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.sp.decode(ids)


@lru_cache(maxsize=2)
def codec(model: str) -> Codec:
    return Codec(model)


ENCODED = "ids binary, begins array<int>, ends array<int>, decoded string"


def encode_texts(df: DataFrame, id_col: str, text_col: str, model: str) -> DataFrame:
    """One row per input row: id, ids (little-endian unsigned 32 bit), the source bytes
    [begins, ends) of every id, and the text that the ids decode to."""

    def run(batch: pa.RecordBatch):
        c = codec(model)
        rows = c.encode([t or "" for t in batch.column(1).to_pylist()])
        return [
            batch.column(0),
            [ids.tobytes() for ids, _, _ in rows],
            list_array([b.astype(np.int32) for _, b, _ in rows], pa.int32()),
            list_array([e.astype(np.int32) for _, _, e in rows], pa.int32()),
            c.decode([ids.tolist() for ids, _, _ in rows]),
        ]

    picked = df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col))
    return map_batches(picked, run, f"`{id_col}` long, {ENCODED}")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = source(spark, sf_dir, "documents")
    out = encode_texts(docs, "doc_id", "text", public_tokenizers.path("piece_bpe_32k.model"))
    return out.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
        F.element_at("ends", -1).cast("long").alias("n_source_bytes"),
    )
