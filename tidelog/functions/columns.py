"""Column-type semantics: real type, classes, labels, signedness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Column type codes (fixed values of the log format).
DECIMAL, TINY, SHORT, LONG, FLOAT, DOUBLE, NULL, TIMESTAMP = 0, 1, 2, 3, 4, 5, 6, 7
LONGLONG, INT24, DATE, TIME, DATETIME, YEAR, NEWDATE, VARCHAR = 8, 9, 10, 11, 12, 13, 14, 15
BIT, TIMESTAMP2, DATETIME2, TIME2 = 16, 17, 18, 19
JSON, NEWDECIMAL, ENUM, SET = 245, 246, 247, 248
TINY_BLOB, MEDIUM_BLOB, LONG_BLOB, BLOB = 249, 250, 251, 252
VAR_STRING, STRING, GEOMETRY = 253, 254, 255

NUMERIC = (TINY, SHORT, INT24, LONG, LONGLONG, NEWDECIMAL, FLOAT, DOUBLE)
CHARACTER = (STRING, VAR_STRING, VARCHAR, BLOB)


def real_type(tp: Column, meta: Column) -> Column:
    """STRING may hide ENUM or SET in its meta; DATE is stored as NEWDATE."""
    hidden = F.floor(meta / 256).cast("int")
    return (
        F.when((tp == STRING) & hidden.isin(ENUM, SET), hidden)
        .when(tp == DATE, NEWDATE)
        .otherwise(tp)
        .cast("int")
    )


def column_class(real: Column, flavor: str = "mysql") -> Column:
    """numeric, character, enum, set, geometry, json or other.

    The MariaDB flavor counts geometry among the character columns.
    """
    character = (*CHARACTER, GEOMETRY) if flavor == "mariadb" else CHARACTER
    return (
        F.when(real.isin(*NUMERIC), "numeric")
        .when(real.isin(*character), "character")
        .when(real == ENUM, "enum")
        .when(real == SET, "set")
        .when(real == GEOMETRY, "geometry")
        .when(real == JSON, "json")
        .otherwise("other")
    )


def char_length(meta: Column) -> Column:
    """Length of a CHAR whose upper length bits hide in the type byte of the meta."""
    b0, b1 = F.floor(meta / 256).cast("int"), meta.bitwiseAND(255).cast("int")
    folded = b0.bitwiseAND(0x30) != 0x30
    high = F.shiftleft(b0.bitwiseAND(0x30).bitwiseXOR(F.lit(0x30)), 4)
    return (
        F.when(meta < 256, meta.cast("int")).when(folded, b1.bitwiseOR(high)).otherwise(b1)
    )


def char_type(meta: Column) -> Column:
    """Type code behind a STRING meta (254 unless ENUM or SET)."""
    b0 = F.floor(meta / 256).cast("int")
    return F.when(meta < 256, STRING).otherwise(b0.bitwiseOR(F.lit(0x30))).cast("int")


def enum_label(index: Column, labels: Column) -> Column:
    """1-based index to label; 0 (the invalid value) and beyond the end give NULL."""
    return F.when(index > 0, F.try_element_at(labels, index.cast("int")))


def set_labels(mask: Column, labels: Column) -> Column:
    """Labels whose bit is set, in label order."""
    return F.filter(labels, lambda x, i: F.getbit(mask.cast("bigint"), i) == 1)


def fix_unsigned(value: Column, width: Column, unsigned: Column) -> Column:
    """Reinterpret a signed integer of ``width`` bytes when its column is unsigned."""
    wide = value.cast("decimal(20,0)")
    wrap = F.element_at(
        F.array(*[F.lit(str(1 << (8 * w))).cast("decimal(20,0)") for w in range(1, 9)]),
        width.cast("int"),
    )
    return F.when(unsigned & (value < 0), wide + wrap).otherwise(wide).cast("decimal(20,0)")
