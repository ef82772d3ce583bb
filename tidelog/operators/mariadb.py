"""MariaDB GTID sets: one (domain, server, seq) per domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.scan import SEGMENT, by_width, ordered_scan, previous

# Header flag bits of a GTID event.
STANDALONE, GROUP_COMMIT, TRANSACTIONAL, ALLOW_PARALLEL, WAITED, DDL = 1, 2, 4, 8, 16, 32


def mariadb_fold(gtids: DataFrame, order: str, set_keys: list[str] | None = None) -> DataFrame:
    """Last GTID in order per domain, even when its sequence goes backwards."""
    return (
        gtids.groupBy(*(set_keys or []), "domain_id")
        .agg(F.max_by(F.struct("server_id", "seq"), order).alias("g"))
        .select(*(set_keys or []), "domain_id", "g.server_id", "g.seq")
    )


def mariadb_out_of_order(gtids: DataFrame, order: str, width: int = SEGMENT) -> DataFrame:
    """GTIDs that do not move their domain forward."""
    seen = ordered_scan(
        gtids, ["domain_id"], [order], by_width(order, width), prev_seq=previous("seq")
    )
    return seen.filter(F.col("seq") <= F.col("prev_seq"))


def mariadb_contains(a: DataFrame, b: DataFrame, set_keys: list[str]) -> DataFrame:
    """Every domain of ``b`` is in ``a`` at the same or a later sequence."""
    theirs = b.select(*set_keys, "domain_id", F.col("seq").alias("b_seq"))
    ours = a.select(*set_keys, "domain_id", F.col("seq").alias("a_seq"))
    held = F.coalesce(F.col("a_seq") >= F.col("b_seq"), F.lit(False))
    return (
        theirs.join(ours, [*set_keys, "domain_id"], "left")
        .groupBy(*set_keys)
        .agg(F.bool_and(held).alias("contains"))
    )


def mariadb_equal(a: DataFrame, b: DataFrame, set_keys: list[str]) -> DataFrame:
    left = a.select(*set_keys, "domain_id", F.struct("server_id", "seq").alias("ga"))
    right = b.select(*set_keys, "domain_id", F.struct("server_id", "seq").alias("gb"))
    return (
        left.join(right, [*set_keys, "domain_id"], "full")
        .groupBy(*set_keys)
        .agg(F.bool_and(F.coalesce(F.col("ga") == F.col("gb"), F.lit(False))).alias("equal"))
    )


def mariadb_set_text(gtids: DataFrame, set_keys: list[str]) -> DataFrame:
    """``d-s-q`` strings of a folded set, sorted as text."""
    text = F.concat_ws("-", "domain_id", "server_id", "seq")
    return gtids.groupBy(*set_keys).agg(
        F.array_join(F.array_sort(F.collect_list(text)), ",").alias("gtid_set")
    )


def parse_mariadb_gtids(df: DataFrame, text_col: str) -> DataFrame:
    """``d-s-q`` lists to ``ordinal, domain_id, server_id, seq, error``; empty is the zero GTID."""
    keep = [c for c in df.columns if c != text_col]
    pieces = df.select(*keep, F.posexplode(F.split(F.col(text_col), ",")).alias("ordinal", "__p"))
    parts = pieces.withColumn("__f", F.split("__p", "-"))
    empty = F.col("__p") == ""

    def number(i: int, top: int):
        text = F.try_element_at("__f", F.lit(i + 1))
        value = F.when(text.rlike(r"^\+?[0-9]+$"), text.try_cast("decimal(20,0)"))
        return F.when(empty, F.lit(0).cast("decimal(20,0)")).otherwise(
            F.when(value <= F.lit(str(top)).cast("decimal(20,0)"), value)
        )

    domain, server, seq = number(0, 2**32 - 1), number(1, 2**32 - 1), number(2, 2**64 - 1)
    error = F.when(~empty & (F.size("__f") != 3), "not domain-server-sequence").when(
        domain.isNull() | server.isNull() | seq.isNull(), "bad number"
    )
    return parts.select(
        *keep,
        "ordinal",
        F.when(error.isNull(), domain.cast("bigint")).alias("domain_id"),
        F.when(error.isNull(), server.cast("bigint")).alias("server_id"),
        F.when(error.isNull(), seq).alias("seq"),
        error.alias("error"),
    )
