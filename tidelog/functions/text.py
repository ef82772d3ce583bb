"""Server versions, error messages, SQL escaping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def version_key(col: Column) -> Column:
    """Struct that orders server versions: numbers first, then release after
    pre-release, then the pre-release text. Missing numbers are 0."""

    def part(i: int) -> Column:
        return F.coalesce(
            F.regexp_extract(col, r"^\s*[vV]?(\d+)(?:\.(\d+))?(?:\.(\d+))?", i).try_cast("bigint"),
            F.lit(0).cast("bigint"),
        )

    pre = F.regexp_extract(col, r"^\s*[vV]?\d+(?:\.\d+){0,2}-([^+]*)", 1)
    return F.struct(
        part(1).alias("major"),
        part(2).alias("minor"),
        part(3).alias("patch"),
        (pre == "").alias("is_release"),
        pre.alias("pre"),
    )


def compare_versions(a: Column, b: Column) -> Column:
    ka, kb = version_key(a), version_key(b)
    return F.when(ka < kb, -1).when(ka > kb, 1).otherwise(0)


def error_code(message: Column) -> Column:
    """Second word of an error message as a number, else 0."""
    word = F.try_element_at(F.split(F.ltrim(message), r"\s+"), F.lit(2))
    return F.coalesce(F.when(word.rlike(r"^[+-]?\d+$"), word.try_cast("int")), F.lit(0))


# Character -> escape letter after the backslash (fixed values); the backslash
# comes first so that later replacements are not escaped again.
ESCAPES = [
    ("\\", "\\"),
    ("\x00", "0"),
    ("'", "'"),
    ('"', '"'),
    ("\b", "b"),
    ("\n", "n"),
    ("\r", "r"),
    ("\t", "t"),
    ("\x1a", "Z"),
]


def sql_escape(col: Column) -> Column:
    out = col
    for char, letter in ESCAPES:
        out = F.replace(out, F.lit(char), F.lit("\\" + letter))
    return out
