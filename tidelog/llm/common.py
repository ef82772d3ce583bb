"""Small helpers of the corpus operators.

A word is a run of bytes other than ASCII white space, as everywhere in this
subpackage. ``bytes.split`` cuts at exactly those bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import prepare, table

#: Rows and bytes in one Arrow batch: texts may be long, workers are small.
BATCH_ROWS = "500"
BATCH_BYTES = str(8 << 20)


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of the corpus operators: small Arrow batches, shuffle files kept no longer than needed."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    # What a query has shuffled goes when it ends: results that are read again are settled.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(ready(spark), sf_dir, name)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word, the same on every machine."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser; spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word windows, in order; fewer words give no window."""
    if len(h) < n:
        return h[:0]
    size = len(h) - n + 1
    out = np.full(size, 0x9E3779B97F4A7C15, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + size])
    return out


class Cache:
    """A mapping of bounded size: entries not used for two fillings go."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def fetch(self, keys: Iterable, make: Callable[[list], list]) -> Callable:
        """Have every key, making the unknown ones in one call; returns the look-up."""
        new, old = self.new, self.old
        if len(new) > self.size:
            self.old, self.new = new, {}
            new, old = self.new, self.old
        wanted = set(keys) - new.keys()
        unknown = []
        for key in wanted:
            value = old.get(key)
            if value is None:
                unknown.append(key)
            else:
                new[key] = value
        if unknown:
            new.update(zip(unknown, make(unknown), strict=True))
        return new.__getitem__


KINDS = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
    "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
    "array<float>": pa.list_(pa.float32()),
}


def arrow_type(ddl: str) -> pa.Schema:
    """The Arrow schema of a flat DDL string; works on executors, which have no session."""
    return pa.schema([(n.strip("`"), KINDS[k]) for n, k in (c.split() for c in ddl.split(","))])


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[list] | None], ddl: str) -> DataFrame:
    """mapInArrow where ``fn`` gives the columns of ``ddl`` for one batch, or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_type(ddl)
        for batch in batches:
            columns = fn(batch)
            if columns is not None:
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)],
                    schema=schema,
                )

    return df.mapInArrow(run, ddl)


def cut(columns: list[pa.Array], limit: int) -> Iterator[list[pa.Array]]:
    """Slices of at most ``limit`` rows."""
    for at in range(0, len(columns[0]), limit):
        yield [c.slice(at, limit) for c in columns]


def list_array(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Arrow lists over one joined buffer."""
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    values = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for a body that reads it often inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)
