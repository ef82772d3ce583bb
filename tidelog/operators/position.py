"""Log positions: base name, numeric extension, offset - compared in that order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def file_base(name: Column) -> Column:
    return F.when(name.contains("."), F.regexp_extract(name, r"^(.*)\.[^.]*$", 1)).otherwise(name)


def file_seq(name: Column) -> Column:
    """Numeric extension; 0 without a dot; NULL when the extension is no number."""
    ext = F.regexp_extract(name, r"\.([^.]*)$", 1)
    number = F.when(ext.rlike(r"^\+?[0-9]+$"), ext.try_cast("bigint"))
    return F.when(name.contains("."), number).otherwise(F.lit(0).cast("bigint"))


def position(name: Column, pos: Column) -> Column:
    """Struct that orders as the log does (Spark compares structs field by field).

    An empty name is an empty base, so it sorts first.
    """
    return F.struct(
        file_base(name).alias("base"), file_seq(name).alias("seq"), pos.cast("bigint").alias("pos")
    )


def with_position(df: DataFrame, file_col: str, pos_col: str) -> DataFrame:
    name = F.col(file_col)
    return df.withColumns(
        {
            "file_base": file_base(name),
            "file_seq": file_seq(name),
            "position_error": F.when(file_seq(name).isNull(), "no numeric extension"),
        }
    )


def order_by_position(df: DataFrame, file_col: str, pos_col: str) -> DataFrame:
    """Total log order (a range-partitioned sort)."""
    return df.orderBy(file_base(F.col(file_col)), file_seq(F.col(file_col)), pos_col)


def position_compare(a: Column, b: Column) -> Column:
    """-1, 0 or 1 for two ``position`` structs; NULL when either file name is bad."""
    ordered = F.when(a < b, -1).when(a > b, 1).otherwise(0)
    return F.when(a["seq"].isNotNull() & b["seq"].isNotNull(), ordered)
