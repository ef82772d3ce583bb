"""Row changes: replay, merge, image pairing, minimal images, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.scan import SEGMENT, by_width, last_known, ordered_scan, previous


def _order(order_cols: Sequence[str]) -> Column:
    return F.col(order_cols[0]) if len(order_cols) == 1 else F.struct(*order_cols)


def latest_images(changes: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Last change per key. An aggregate, not a window: a hot key shrinks map-side."""
    rest = [c for c in changes.columns if c not in keys]
    return (
        changes.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), _order(order_cols)).alias("__last"))
        .select(*keys, *[F.col("__last")[c].alias(c) for c in rest])
    )


def replay(changes: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Current table state: last image per key wins, a delete removes the key."""
    return latest_images(changes, keys, order_cols).filter(F.col("op") != "D")


def merge_changes(
    base: DataFrame, changes: DataFrame, keys: Sequence[str], order_cols: Sequence[str]
) -> DataFrame:
    """Base table after the changes. ``base`` has the key and the value columns only."""
    values = [c for c in base.columns if c not in keys]
    last = latest_images(changes.select(*keys, *order_cols, "op", *values), keys, order_cols)
    last = last.select(
        *keys, F.col("op").alias("__op"), *[F.col(v).alias(f"__n_{v}") for v in values]
    )
    joined = base.withColumn("__old", F.lit(True)).join(last, list(keys), "full")
    touched = F.col("__op").isNotNull()
    return joined.filter(~touched | (F.col("__op") != "D")).select(
        *keys, *[F.when(touched, F.col(f"__n_{v}")).otherwise(F.col(v)).alias(v) for v in values]
    )


def pair_images(images: DataFrame, event_keys: Sequence[str], image: str) -> DataFrame:
    """Update images alternate before, after; inserts and deletes have one side.

    ``images`` has ``image_idx``, ``kind`` and the column named by ``image``.
    """
    kind = F.col("kind")
    is_update = kind.isin("UpdateBI", "UpdateAI")
    change_no = F.when(is_update, F.floor(F.col("image_idx") / 2)).otherwise(F.col("image_idx"))
    op = F.when(is_update, "U").when(kind == "WriteAI", "I").otherwise("D")
    before, after = kind.isin("UpdateBI", "DeleteBI"), kind.isin("UpdateAI", "WriteAI")
    return (
        images.withColumns({"change_no": change_no.cast("bigint"), "op": op})
        .groupBy(*event_keys, "change_no", "op")
        .agg(
            F.first(F.when(before, F.col(image)), True).alias("before"),
            F.first(F.when(after, F.col(image)), True).alias("after"),
        )
    )


def skipped_columns(present: Column, n_columns: Column) -> Column:
    """Ordinals missing from the present list (minimal row image)."""
    every = F.when(n_columns > 0, F.sequence(F.lit(0), (n_columns - 1).cast("int")))
    return F.array_except(F.coalesce(every, F.array().cast("array<int>")), present)


def fill_minimal(
    changes: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    skipped: str,
    width: int = SEGMENT,
) -> DataFrame:
    """A skipped column takes the last value that was written for its key.

    A value written as NULL counts as known and stays NULL.
    """
    known = F.when(~F.col(skipped), F.struct(F.col(value).alias("v")))
    filled = ordered_scan(
        changes, keys, [order], by_width(order, width), __known=last_known(known)
    )
    return filled.withColumn(f"{value}_filled", F.col("__known")["v"]).drop("__known")


def change_cube(changes: DataFrame, dims: Sequence[str]) -> DataFrame:
    return changes.cube(*dims).agg(F.count("*").alias("n"))


def change_rollup(changes: DataFrame, dims: Sequence[str]) -> DataFrame:
    return changes.rollup(*dims).agg(F.count("*").alias("n"))


def schema_drift(
    table_maps: DataFrame,
    table_keys: Sequence[str],
    order: str,
    signature: Column,
    width: int = SEGMENT,
) -> DataFrame:
    """Table maps whose columns differ from the map seen before for the same table."""
    marked = table_maps.withColumn("signature", signature)
    seen = ordered_scan(
        marked, table_keys, [order], by_width(order, width), prev_signature=previous("signature")
    )
    return seen.filter(F.col("signature") != F.col("prev_signature"))


def typed_view(
    changes: DataFrame, spec: dict[str, str], values: str = "after"
) -> DataFrame:
    """Typed columns of one table out of a MAP<STRING,STRING> of rendered values.

    ``spec`` maps column name to Spark type; a value that does not fit is NULL
    and the raw map stays available in the input.
    """
    return changes.select(
        *[c for c in changes.columns if c != values],
        *[F.col(values)[name].try_cast(tp).alias(name) for name, tp in spec.items()],
    )
