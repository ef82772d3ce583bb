"""Texts rewritten by what a table says about each document."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import KINDS


def text_print(docs: DataFrame) -> Column:
    """Hash of the text: with the id it names a document even if ids repeat."""
    return F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("print")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, print, text) of the rows that have an id."""
    doc_id, text = docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")
    return docs.select(doc_id, text_print(docs), text).filter("doc_id is not null")


def rewrite(docs: DataFrame, marks: DataFrame, fn: Callable[[str, list], tuple], extra: list[tuple[str, str]]) -> DataFrame:
    """All rows of ``docs``, columns as before, ``text`` replaced, and ``extra`` columns (name, kind).

    ``marks``: (doc_id, print, marks). ``fn`` takes a text and its marks (an empty list
    where there are none) and gives the new text and the extra values. Null texts
    are read as empty ones and stay null.
    """
    docs = docs.withColumn("text", docs["text"].cast("string"))
    names, where = docs.columns, docs.columns.index("text")
    schema = T.StructType(list(docs.schema.fields))
    for name, kind in extra:
        schema = schema.add(name, kind)
    marks = marks.withColumnsRenamed({"doc_id": "_doc", "print": "_print", "marks": "_marks"})
    met = docs.join(marks, (docs["doc_id"].cast("long") == F.col("_doc")) & (text_print(docs) == F.col("_print")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(where).to_pylist()
            out = [fn(t or "", m or []) for t, m in zip(texts, batch.column(len(names)).to_pylist(), strict=True)]
            new, *more = zip(*out, strict=True) if out else [[]] * (1 + len(extra))
            columns = list(batch.columns[: len(names)])
            columns[where] = pa.array([None if t is None else x for t, x in zip(texts, new, strict=True)], pa.string())
            columns += [pa.array(v, KINDS[kind]) for v, (_, kind) in zip(more, extra, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *(name for name, _ in extra)])

    return met.select(*[docs[c] for c in names], "_marks").mapInArrow(run, schema)
