"""The same set operators for both server flavors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators import gtid, mariadb

MYSQL, MARIADB = "mysql", "mariadb"


def _known(flavor: str) -> str:
    if flavor not in (MYSQL, MARIADB):
        raise ValueError(f"unknown flavor {flavor!r}, must be {MYSQL} or {MARIADB}")
    return flavor


def parse_sets(df: DataFrame, text_col: str, flavor: str) -> DataFrame:
    if _known(flavor) == MYSQL:
        return gtid.parse_gtid_sets(df, text_col)
    return mariadb.parse_mariadb_gtids(df, text_col)


def _never(a: DataFrame, set_keys: list[str], name: str) -> DataFrame:
    return a.select(*set_keys).distinct().withColumn(name, F.lit(False))


def contains(
    a: DataFrame, b: DataFrame, set_keys: list[str], flavor_a: str, flavor_b: str | None = None
) -> DataFrame:
    """Does ``a`` cover ``b``; sets of different flavors never do."""
    if _known(flavor_a) != _known(flavor_b or flavor_a):
        return _never(a, set_keys, "contains")
    if flavor_a == MYSQL:
        return gtid.contains_sets(a, b)
    return mariadb.mariadb_contains(a, b, set_keys)


def equal(
    a: DataFrame, b: DataFrame, set_keys: list[str], flavor_a: str, flavor_b: str | None = None
) -> DataFrame:
    if _known(flavor_a) != _known(flavor_b or flavor_a):
        return _never(a, set_keys, "equal")
    if flavor_a == MYSQL:
        return gtid.equal_sets(a, b)
    return mariadb.mariadb_equal(a, b, set_keys)
