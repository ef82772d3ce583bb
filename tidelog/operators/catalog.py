"""Column catalog: the metadata lists of a table map, resolved per column.

Every list of a table map has entries for its own class of columns only, so
the k-th entry belongs to the k-th column of that class. A server repeats the same few maps
before every statement, so maps are told apart by a 128-bit hash of their content and each
distinct one is resolved once; the rows are joined to their map by that hash. Ranks within
a class are prefix sums over all columns of an Arrow batch, so a map costs its
number of columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidelog.functions.binary import bit
from tidelog.functions.columns import GEOMETRY, JSON, column_class, real_type

# Metadata columns of ``table_maps`` besides types, metas and null_bitmap.
LISTS = {
    "signedness": "binary",
    "default_charset": "array<bigint>",
    "column_charset": "array<bigint>",
    "column_names": "array<string>",
    "set_values": "array<array<string>>",
    "enum_values": "array<array<string>>",
    "geometry_types": "array<bigint>",
    "pk": "array<bigint>",
    "pk_prefix": "array<bigint>",
    "enum_set_default_charset": "array<bigint>",
    "enum_set_column_charset": "array<bigint>",
}


def _at(values: Column, i: Column) -> Column:
    return F.try_element_at(values, (i + 1).cast("int"))


def collation(default: Column, listed: Column, k: Column) -> Column:
    """Override for the k-th column, else the default, else the k-th listed collation.

    ``default`` is ``[collation, k, collation, k, collation, ...]``.
    """
    pairs = F.when(
        F.size(default) > 1, F.sequence(F.lit(2), F.size(default) - 1, F.lit(2))
    ).otherwise(F.array().cast("array<int>"))
    override = F.aggregate(
        pairs,
        F.lit(None).cast("bigint"),
        lambda found, p: F.when(
            F.try_element_at(default, p) == k, F.try_element_at(default, p + 1)
        ).otherwise(found),
    )
    return F.when(F.size(default) > 0, F.coalesce(override, F.try_element_at(default, F.lit(1)))).otherwise(
        _at(listed, k)
    )


# Classes of columns that metadata lists have entries for: rank column and members.
RANKED = {
    "__num": ("numeric",),
    "__chr": ("character",),
    "__enum": ("enum",),
    "__set": ("set",),
    "__es": ("enum", "set"),
}
_RANKS = [*RANKED, "__geo"]


def ranks(member: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """How many earlier columns of the same row are members: -1 for columns that are none.

    ``member``: flags of all rows' columns in a row, ``begin``: where each row's begin (and the end).
    """
    before = np.concatenate(([0], np.cumsum(member)))
    own = np.repeat(before[begin[:-1]], np.diff(begin))
    return np.where(member, before[:-1] - own, -1)


def _collations(default: list[int] | None, listed: list[int] | None, count: int) -> list[int | None]:
    """Collation of each of ``count`` columns of a class, as ``collation`` gives it for one."""
    if default:
        # As in the log: the default first, then pairs of rank and collation; the last pair wins.
        # A rank without collation at the end overrides nothing.
        found = [default[0]] * count
        for k, value in zip(default[1::2], default[2::2], strict=False):
            if k is not None and value is not None and 0 <= k < count:
                found[k] = value
        return found
    listed = listed or []
    return [listed[k] if k < len(listed) else None for k in range(count)]


def _flat(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Joined values of a list column and where each row's begin; a null list is an empty one."""
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten(), np.concatenate(([0], np.cumsum(sizes)))


def _with_ranks(maps: DataFrame) -> DataFrame:
    """``maps`` with the rank of each column in each class and its collation, as arrays."""
    schema = T.StructType(list(maps.schema.fields))
    for name in _RANKS:
        schema = schema.add(name, T.ArrayType(T.IntegerType()))
    schema = schema.add("__collation", T.ArrayType(T.LongType()))
    arrow = to_arrow_schema(schema)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, begin = _flat(batch.column("__classes"))
            types, _ = _flat(batch.column("types"))
            known = classes.dictionary_encode()
            names, codes = known.dictionary.to_pylist(), known.indices.to_numpy(zero_copy_only=False)
            made = {}
            for name, members in RANKED.items():
                made[name] = ranks(np.isin(codes, [k for k, c in enumerate(names) if c in members]), begin)
            made["__geo"] = ranks(types.fill_null(0).to_numpy(zero_copy_only=False) == GEOMETRY, begin)
            shown: list[int | None] = [None] * len(codes)
            for rank, default, listed in (
                ("__chr", "default_charset", "column_charset"),
                ("__es", "enum_set_default_charset", "enum_set_column_charset"),
            ):
                rows = zip(batch.column(default).to_pylist(), batch.column(listed).to_pylist(), strict=True)
                for row, (d, x) in enumerate(rows):
                    at = np.flatnonzero(made[rank][begin[row] : begin[row + 1]] >= 0) + begin[row]
                    for i, value in zip(at.tolist(), _collations(d, x, len(at)), strict=True):
                        shown[i] = value
            offsets = pa.array(begin.astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32(), mask=v < 0)) for v in made.values()]
            lists.append(pa.ListArray.from_arrays(offsets, pa.array(shown, pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip([*batch.columns, *lists], arrow, strict=True)], schema=arrow
            )

    return maps.mapInArrow(resolve, schema)


def content_hash(columns: Sequence[str]) -> list[Column]:
    """128 bits that name a row's content, null-safe; longs under the names ``__h0`` and ``__h1``."""
    return [F.xxhash64(F.lit(seed), *columns).alias(f"__h{seed}") for seed in (0, 1)]


def column_catalog(
    table_maps: DataFrame, keys: Sequence[str], flavor: str = "mysql"
) -> DataFrame:
    """One row per column of each table map."""
    content = ["types", "metas", "null_bitmap", *LISTS]
    # A hash takes null and an empty list for the same; presence tells them apart.
    there = [F.col(c).isNull().cast("int").alias(f"__n_{c}") for c in content]
    named = table_maps.select(*keys, *content, *there)
    named = named.select(*keys, *content, *content_hash([*content, *(f"__n_{c}" for c in content)]))
    # Told apart by all columns and not by a first one per hash: aggregating such lists sorts every
    # row with its content before anything is combined, keys alone are combined as they come.
    distinct = named.select("__h0", "__h1", *content).distinct()

    types, metas, cls = F.col("types"), F.col("metas"), F.col("__classes")
    classes = F.transform(types, lambda t, i: column_class(real_type(t, _at(metas, i)), flavor))
    prepared = _with_ranks(distinct.withColumn("__classes", classes))
    n = F.size(types)
    ordinals = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def entry(i: Column) -> Column:
        pk_ord = F.array_position(F.col("pk"), i.cast("bigint"))
        null_bit = bit(F.col("null_bitmap"), i)

        def by_rank(name: str, value) -> Column:
            k = _at(F.col(name), i)
            return F.when(k.isNotNull(), value(k))

        return F.struct(
            i.alias("ordinal"),
            _at(types, i).alias("type"),
            _at(metas, i).alias("meta"),
            real_type(_at(types, i), _at(metas, i)).alias("real_type"),
            _at(cls, i).alias("class"),
            null_bit.alias("nullable"),
            by_rank("__num", lambda k: bit(F.col("signedness"), k, True)).alias("unsigned"),
            _at(F.col("column_names"), i).alias("name"),
            _at(F.col("__collation"), i).alias("collation"),
            F.coalesce(
                by_rank("__enum", lambda k: _at(F.col("enum_values"), k)),
                by_rank("__set", lambda k: _at(F.col("set_values"), k)),
            ).alias("labels"),
            by_rank("__geo", lambda k: _at(F.col("geometry_types"), k)).alias("geometry"),
            F.when(pk_ord > 0, pk_ord - 1).alias("pk_ord"),
            F.when(pk_ord > 0, F.try_element_at(F.col("pk_prefix"), pk_ord.cast("int"))).alias("pk_prefix"),
        )

    resolved = prepared.select("__h0", "__h1", F.transform(ordinals, entry).alias("__columns"))
    # One definition per hash, also where a hash takes lists with NULLs inside for the same.
    resolved = resolved.dropDuplicates(["__h0", "__h1"])
    return named.select(*keys, "__h0", "__h1").join(resolved, ["__h0", "__h1"]).select(*keys, F.inline("__columns"))


def column_label(name: Column, ordinal: Column) -> Column:
    """Column name, or ``@ordinal`` when the server did not log names."""
    return F.coalesce(name, F.concat(F.lit("@"), ordinal.cast("string")))


def json_column_count(catalog: DataFrame, keys: Sequence[str]) -> DataFrame:
    return catalog.groupBy(*keys).agg(F.count_if(F.col("type") == JSON).alias("json_columns"))


def primary_key(catalog: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key columns in key order; prefix 0 means the whole column."""
    return catalog.filter(F.col("pk_ord").isNotNull()).select(
        *keys,
        F.col("pk_ord"),
        "ordinal",
        column_label(F.col("name"), F.col("ordinal")).alias("name"),
        F.coalesce("pk_prefix", F.lit(0)).alias("pk_prefix"),
    )


def key_value(value: Column, prefix: Column) -> Column:
    """The part of a value that is in the key."""
    return F.when(prefix > 0, F.substring(value, F.lit(1), prefix.cast("int"))).otherwise(value)


def join_catalog(cells: DataFrame, catalog: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Resolve ``ordinal`` of each cell; Catalyst broadcasts the catalog when it is small."""
    return cells.join(catalog, [*keys, "ordinal"])


def column_report(catalog: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One text line per column."""

    def yes_no(flag: Column) -> Column:
        return F.when(flag.isNull(), "<n/a>").when(flag, "yes").otherwise("no ")

    def shown(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit("<n/a>"))

    def label_list(labels: Column) -> Column:
        quoted = F.transform(labels, lambda x: F.concat(F.lit('"'), x, F.lit('"')))
        return F.coalesce(
            F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")), F.lit("<n/a>")
        )

    cls = F.col("class")
    line = F.concat(
        F.lit("  "),
        F.coalesce("name", F.lit("<n/a>")),
        F.lit("  type="),
        F.rpad(F.col("real_type").cast("string"), 3, " "),
        F.when(cls == "numeric", F.concat(F.lit("  unsigned="), yes_no(F.col("unsigned")))).otherwise(""),
        F.when(
            cls == "character", F.concat(F.lit("  collation="), shown(F.col("collation")), F.lit(" "))
        ).otherwise(""),
        F.when(
            cls.isin("enum", "set"),
            F.concat(
                F.lit("  "), cls, F.lit("_collation="), shown(F.col("collation")),
                F.lit("  "), cls, F.lit("="), label_list(F.col("labels")),
            ),
        ).otherwise(""),
        F.when(cls == "geometry", F.concat(F.lit("  geometry_type="), shown(F.col("geometry")))).otherwise(""),
        F.lit("  null="),
        yes_no(F.col("nullable")),
        F.when(F.col("pk_ord").isNotNull(), "  pri").otherwise(""),
    )
    return catalog.select(*keys, "ordinal", line.alias("line"))
