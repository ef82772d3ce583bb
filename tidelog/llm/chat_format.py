"""Chat formatting by prefix-target expansion.

Every assistant turn is a training example of its own: all turns before it are
context, only that reply is under the loss. ``format_turns`` writes each turn once with its
place in the conversation's text. ``expand`` makes the examples: each with its whole context
and target, and what follows the last reply as one more text without loss; their
volume grows with the square of a conversation by its nature, memory doesn't. ``digest``, and with it
the query, reads everything from the expanded examples. ``examples`` is the
compact form, "prefix up to here, loss from - to"; ``render`` gives an example a row.

Template of a turn: ``<|im_start|>`` role, line feed, text, ``<|im_end|>``, line
feed. Inside texts a backslash is put between the ``<`` and ``|`` of a marker (after
any that stand there already), so no text can form a control string and
``unescape`` gives it back unchanged. Roles also escape backslash and line feed.

Rows of a conversation are ordered by turn, then role, then text (ties and
repeated rows stay, in that order); null conversation ids are one conversation;
null turns come first; null roles and texts are empty. Extra columns are ignored.
Conversations are sorted and streamed, so memory doesn't grow with their length;
a digest over all text of one conversation is sequential by its nature.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_type, source

START, END = "<|im_start|>", "<|im_end|>"
_MARK, _MARKED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)

TURNS = (
    "conv_id long, turn long, is_target boolean, example_no long, chunk string, "
    "start long, end long, loss_start long, loss_end long"
)


def escape(text: str) -> str:
    return _MARK.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _MARKED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns of one conversation together and in order. The sort spills."""
    return (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, now, at, example = arrow_type(TURNS), object(), 0, 0
    for batch in batches:
        out = []
        for conv, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if conv != now:
                now, at, example = conv, 0, 0
            head, body = f"{START}{escape_role(role)}\n", escape(text)
            chunk, target = f"{head}{body}{END}\n", role == "assistant"
            begin = at + len(head)
            out.append(
                (conv, turn, target, example if target else None, chunk, at, at + len(chunk))
                + ((begin, begin + len(body)) if target else (None, None))
            )
            at, example = at + len(chunk), example + target
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t.type) for c, t in zip(list(zip(*out, strict=True)) or [[]] * 9, schema, strict=True)],
            schema=schema,
        )


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per turn: its formatted text, its place in the conversation's text, its loss span."""
    return _ordered(turns).mapInArrow(_format, TURNS)


def examples(formatted: DataFrame) -> DataFrame:
    """One row per assistant turn: the prefix [0, text_end) with loss on [loss_start, loss_end)."""
    return formatted.filter("is_target").select(
        "conv_id", "example_no", F.col("turn").alias("target_turn"), F.col("start").alias("context_end"),
        "loss_start", "loss_end", F.col("end").alias("text_end"),
    )


def render(turns: DataFrame) -> DataFrame:
    """The examples with their whole texts; grows with the square of a conversation by its nature."""

    def write(batches):
        ddl = "conv_id long, example_no long, text string, loss_start long, loss_end long"
        schema, now, prefix = arrow_type(ddl), object(), []
        for batch in batches:
            for r in batch.to_pylist():
                if r["conv_id"] != now:
                    now, prefix = r["conv_id"], []
                prefix.append(r["chunk"])
                if r["is_target"]:
                    row = (now, r["example_no"], "".join(prefix), r["loss_start"], r["loss_end"])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], t.type) for v, t in zip(row, schema, strict=True)], schema=schema
                    )

    return format_turns(turns).mapInArrow(
        write, "conv_id long, example_no long, text string, loss_start long, loss_end long"
    )


EXAMPLES = (
    "conv_id long, example_no long, at long, piece string, text_end long, loss_start long, loss_end long"
)
# Characters of an example written as one row, and of a context kept in memory; longer ones lie on disk.
PIECE, HELD = 1 << 20, 4 << 20
_ROWS = 1000


class _Context:
    """The text of a conversation so far, in pieces of about ``PIECE`` characters, read again for each example."""

    def __init__(self):
        self.file, self.blocks, self.open, self.size = None, [], [], 0

    def add(self, chunk: str) -> None:
        self.open.append(chunk)
        self.size += len(chunk)
        if self.size >= PIECE:
            self.blocks.append("".join(self.open))
            self.open, self.size = [], 0
        if len(self.blocks) * PIECE >= HELD:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(0, 2)
            for block in self.blocks:
                data = block.encode()
                self.file.write(len(data).to_bytes(8, "little") + data)
            self.blocks = []

    def pieces(self) -> Iterator[str]:
        if self.file:
            self.file.seek(0)
            while size := self.file.read(8):
                yield self.file.read(int.from_bytes(size, "little")).decode()
        yield from self.blocks
        if self.open:
            self.open = ["".join(self.open)]
            yield self.open[0]

    def close(self) -> None:
        if self.file:
            self.file.close()


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, now, context, rest = arrow_type(EXAMPLES), object(), _Context(), None
    out, held = [], 0

    def flush():
        nonlocal out, held
        columns = [pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)]
        out, held = [], 0
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def text(example, end, loss):
        """All pieces of one text: the context so far, with the last turn in it."""
        nonlocal held
        at = 0
        for piece in context.pieces():
            out.append((now, example, at, piece, end, *loss))
            at, held = at + len(piece), held + len(piece)
            if held >= PIECE or len(out) >= _ROWS:
                yield flush()

    names = ["conv_id", "chunk", "end", "is_target", "example_no", "loss_start", "loss_end"]
    for batch in batches:
        for conv, chunk, end, target, example, begin, stop in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            if conv != now:
                if rest is not None:
                    yield from text(None, rest, (None, None))
                context.close()
                now, context = conv, _Context()
            context.add(chunk)
            rest = end
            if target:
                yield from text(example, end, (begin, stop))
                rest = None
    if rest is not None:
        yield from text(None, rest, (None, None))
    context.close()
    if out:
        yield flush()


def expand(formatted: DataFrame) -> DataFrame:
    """The examples written out: context and target of each, in pieces that begin at ``at``.

    Turns behind the last reply come as a text with their context and without number and loss.
    """
    return formatted.mapInArrow(_expand, EXAMPLES)


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_examples long, example_chars long"
)


class _Reader:
    """Turns and loss of one conversation as its examples give them."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss_chars, self.n_examples, self.example_chars = conv, 0, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        # How much of the text has been read into turns, what is left over of the last piece, and the last turn.
        self.read, self.left, self.last = 0, "", (0, "")

    def piece(self, example: int | None, at: int, piece: str, end: int, begin: int | None, stop: int | None) -> None:
        new = self.read + len(self.left)
        if example is not None:
            self.example_chars += len(piece)
        if at + len(piece) > new:
            self.left += piece[new - at :]
            done = 0
            for turn in _TURN.finditer(self.left):
                self.all.update(f"{unescape_role(turn[1])}\n{unescape(turn[2])}\n".encode())
                self.turns, self.last, done = self.turns + 1, (self.read + turn.start(), turn[0]), turn.end()
            self.read, self.left = self.read + done, self.left[done:]
        if example is not None and at + len(piece) == end:
            first, chunk = self.last
            reply = unescape(chunk[begin - first : stop - first])
            self.loss.update(reply.encode())
            self.loss_chars, self.n_examples = self.loss_chars + len(reply), self.n_examples + 1

    def result(self) -> tuple:
        return (
            self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.read, self.n_examples,
            self.example_chars,
        )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, reader, done = arrow_type(DIGEST), None, []

    def flush():
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t.type) for c, t in zip(zip(*done, strict=True), schema, strict=True)], schema=schema
        )

    for batch in batches:
        for conv, *piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if reader is None or conv != reader.conv:
                if reader is not None:
                    done.append(reader.result())
                reader = _Reader(conv)
            reader.piece(*piece)
        if len(done) >= _ROWS:
            yield flush()
            done = []
    if reader is not None:
        done.append(reader.result())
    if done:
        yield flush()


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its expanded examples (of turns in the order ``format_turns`` gives).

    Examples are read where they are expanded, so their volume is never shuffled or held.
    """
    return formatted.mapInArrow(lambda batches: _digest(_expand(batches)), DIGEST)


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = f"{END}{START}assistant ok"
    extra = spark.createDataFrame(
        [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string"
    )
    return digest(format_turns(rows.unionByName(extra)))
