"""GTID set algebra on interval tables.

A set table has the columns ``sid, start, stop`` (half-open) plus any number
of leading columns that tell sets apart (``set_id``, ``source``, ...). All
operators work per (those columns, sid) and none of them holds a whole server
id in one task: see ``scan``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.scan import (
    SEGMENT,
    by_width,
    following,
    inherited,
    ordered_scan,
    row_index,
    running_max,
    running_sum,
)
from tidelog.session import settle


def set_keys(intervals: DataFrame) -> list[str]:
    """Columns that name one interval list: everything but the bounds."""
    return [c for c in intervals.columns if c not in ("start", "stop")]


def owner_keys(intervals: DataFrame) -> list[str]:
    return [c for c in set_keys(intervals) if c != "sid"]


def _edges(intervals: DataFrame, a: int, b: int) -> DataFrame:
    """Where intervals begin and end: ``point`` and the change of depth there in either set.

    Rows with a null bound or nothing between their bounds are no interval.
    """
    ends = F.array(
        F.struct(F.col("start").alias("point"), F.lit(1).alias("sign")),
        F.struct(F.col("stop").alias("point"), F.lit(-1).alias("sign")),
    )
    return (
        intervals.filter(F.col("start") < F.col("stop"))
        .select(*set_keys(intervals), F.inline(ends))
        .withColumns({"da": F.col("sign") * a, "db": F.col("sign") * b})
        .drop("sign")
    )


def _depths(edges: DataFrame, width: int) -> DataFrame:
    """``depth_a``, ``depth_b``: how many intervals of either set lie behind each point.

    Equal points are combined and written once, as all that follows reads them more than once:
    so a plan grows with its operators and not with the power of their number. The points of one range of
    one key (``__at``) are together then, and what a range inherits comes from sums per range.
    """
    keys = _edge_keys(edges)
    points = settle(edges.groupBy(*keys, "point").agg(F.sum("da").alias("da"), F.sum("db").alias("db")), "points")
    points = points.withColumn("__at", F.struct(*keys, by_width("point", width).alias("__seg0")))
    sums = points.groupBy("__at").agg(F.sum("da").alias("__s_a"), F.sum("db").alias("__s_b"))
    carried = inherited(sums, "__at", keys, ["__seg0"], {"a": running_sum("da"), "b": running_sum("db")})
    inside = Window.partitionBy("__at").orderBy("point").rowsBetween(Window.unboundedPreceding, 0)
    return points.repartition("__at").join(carried, "__at").withColumns(
        {f"depth_{x}": F.coalesce(f"__c_{x}", F.lit(0)) + F.sum(f"d{x}").over(inside) for x in "ab"}
    )


def _edge_keys(edges: DataFrame) -> list[str]:
    return [c for c in edges.columns if c not in ("point", "da", "db")]


def _spans(edges: DataFrame, inside: Callable[[Column, Column], Column], width: int) -> DataFrame:
    """Longest spans in which ``inside`` (of being in a, in b) holds or not: ``start, stop, inside``.

    Bounds are the points where it changes; each ends where the next of its key stands, in the
    same range or in the first range after it that has one. The last stop of a key is NULL.
    """
    keys = _edge_keys(edges)
    swept = _depths(edges, width)
    now = inside(F.col("depth_a") > 0, F.col("depth_b") > 0)
    before = inside(F.col("depth_a") - F.col("da") > 0, F.col("depth_b") - F.col("db") > 0)
    bounds = swept.withColumn("inside", now).filter(F.col("inside") != before).select("__at", "point", "inside")
    firsts = bounds.groupBy("__at").agg(F.min(F.struct(F.col("point").alias("v"))).alias("__s_n"))
    ahead = inherited(firsts, "__at", keys, ["__seg0"], {"n": following("point")})
    stop = F.coalesce(F.lead("point").over(Window.partitionBy("__at").orderBy("point")), F.col("__c_n")["v"])
    return bounds.join(ahead, "__at").select(
        *[F.col("__at")[k].alias(k) for k in keys], F.col("point").alias("start"), stop.alias("stop"), "inside"
    )


def _islands(edges: DataFrame, inside: Callable[[Column, Column], Column], width: int) -> DataFrame:
    return _spans(edges, inside, width).filter("inside").drop("inside")


def normalize(intervals: DataFrame, width: int = SEGMENT) -> DataFrame:
    """Merge intervals that overlap or touch."""
    return _islands(_edges(intervals, 1, 0), lambda a, b: a, width)


def executed_set(transactions: DataFrame, width: int = SEGMENT) -> DataFrame:
    """Set of the transactions in a table with ``sid, gno`` (other columns name the set)."""
    keys = [c for c in transactions.columns if c != "gno"]
    # Duplicates collapse map-side; runs are first built inside a gno range,
    # so only their ends travel to the merge of neighbouring ranges.
    unique = transactions.groupBy(*keys, "gno").agg(F.lit(1).alias("one")).drop("one")
    ranged = unique.withColumn("__range", by_width("gno", width))
    rank = F.row_number().over(Window.partitionBy(*keys, "__range").orderBy("gno"))
    runs = (
        ranged.withColumn("__run", F.col("gno") - rank)
        .groupBy(*keys, "__range", "__run")
        .agg(F.min("gno").alias("start"), (F.max("gno") + 1).alias("stop"))
        .select(*keys, "start", "stop")
    )
    return normalize(runs, width)


def union_sets(a: DataFrame, b: DataFrame, width: int = SEGMENT) -> DataFrame:
    return normalize(a.unionByName(b), width)


def _both(a: DataFrame, b: DataFrame) -> DataFrame:
    return _edges(a, 1, 0).unionByName(_edges(b, 0, 1))


def subtract_sets(a: DataFrame, b: DataFrame, width: int = SEGMENT) -> DataFrame:
    """Exact difference; a sid that loses everything disappears."""
    return _islands(_both(a, b), lambda in_a, in_b: in_a & ~in_b, width)


def intersect_sets(a: DataFrame, b: DataFrame, width: int = SEGMENT) -> DataFrame:
    return _islands(_both(a, b), lambda in_a, in_b: in_a & in_b, width)


def _verdicts(a: DataFrame, b: DataFrame, width: int) -> DataFrame:
    in_a, in_b = F.col("depth_a") > 0, F.col("depth_b") > 0
    owners = [F.col("__at")[k].alias(k) for k in owner_keys(a)]
    return (
        _depths(_both(a, b), width)
        .groupBy(*owners)
        .agg(F.count_if(in_a & ~in_b).alias("only_a"), F.count_if(~in_a & in_b).alias("only_b"))
    )


def contains_sets(a: DataFrame, b: DataFrame, width: int = SEGMENT) -> DataFrame:
    """Does ``a`` cover ``b``? One row per set."""
    return _verdicts(a, b, width).select(
        *owner_keys(a), (F.col("only_b") == 0).alias("contains")
    )


def equal_sets(a: DataFrame, b: DataFrame, width: int = SEGMENT) -> DataFrame:
    return _verdicts(a, b, width).select(
        *owner_keys(a), ((F.col("only_a") == 0) & (F.col("only_b") == 0)).alias("equal")
    )


def compare_sets(a: DataFrame, b: DataFrame, width: int = SEGMENT) -> DataFrame:
    """0 when equal, 1 when ``a`` contains ``b``, otherwise -1."""
    only_a, only_b = F.col("only_a"), F.col("only_b")
    order = F.when((only_a == 0) & (only_b == 0), 0).when(only_b == 0, 1).otherwise(-1)
    return _verdicts(a, b, width).select(*owner_keys(a), order.alias("cmp"))


def _covered(transactions: DataFrame, intervals: DataFrame, width: int) -> DataFrame:
    """Transactions with ``__in``: does some interval of the set hold their gno?

    An as-of scan instead of a range join: interval starts and transactions
    are merged in gno order and the furthest stop so far decides. The work is
    linear whatever the number or the length of the intervals.
    """
    keys = set_keys(intervals)
    longest = intervals.groupBy(*keys, "start").agg(F.max("stop").alias("__stop"))
    starts = settle(longest, "starts").select(
        *keys, F.col("start").alias("gno"), "__stop", F.lit(0).alias("__probe")
    )
    probes = transactions.withColumn("__probe", F.lit(1))
    merged = ordered_scan(
        probes.unionByName(starts, allowMissingColumns=True),
        keys,
        ["gno", "__probe"],
        by_width("gno", width),
        __reach=running_max("__stop"),
    )
    inside = F.coalesce(F.col("__reach") > F.col("gno"), F.lit(False))
    return (
        merged.filter(F.col("__probe") == 1)
        .withColumn("__in", inside)
        .select(*transactions.columns, "__in")
    )


def in_set(transactions: DataFrame, intervals: DataFrame, width: int = SEGMENT) -> DataFrame:
    return _covered(transactions, intervals, width).filter("__in").drop("__in")


def not_in_set(transactions: DataFrame, intervals: DataFrame, width: int = SEGMENT) -> DataFrame:
    return _covered(transactions, intervals, width).filter("not __in").drop("__in")


def gaps(intervals: DataFrame, width: int = SEGMENT) -> DataFrame:
    """Missing gnos between the islands of a set."""
    spans = _spans(_edges(intervals, 1, 0), lambda a, b: a, width)
    return spans.filter(~F.col("inside") & F.col("stop").isNotNull()).select(
        *set_keys(intervals), F.col("start").alias("gap_start"), F.col("stop").alias("gap_stop")
    )


def set_sizes(intervals: DataFrame) -> DataFrame:
    """Number of server ids and of transactions per set (normalized input)."""
    return (
        intervals.groupBy(*set_keys(intervals))
        .agg(F.sum(F.col("stop") - F.col("start")).alias("n"), F.count("*").alias("k"))
        .groupBy(*owner_keys(intervals))
        .agg(
            F.count("*").alias("sids"),
            F.sum("k").alias("intervals"),
            F.sum("n").alias("transactions"),
        )
    )


def interval_text() -> Column:
    start, stop = F.col("start"), F.col("stop")
    return F.when(stop == start + 1, start.cast("string")).otherwise(
        F.concat_ws("-", start.cast("string"), (stop - 1).cast("string"))
    )


def gtid_set_text(intervals: DataFrame) -> DataFrame:
    """One canonical line per set: sids in order, closed intervals in order.

    The line is the value itself, so use this for sets whose text is meant to
    be read as one string; ``gtid_set_lines`` serves sets of any length.
    """
    owners = owner_keys(intervals)
    parts = intervals.groupBy(*owners, "sid").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("start", interval_text().alias("t")))),
                lambda p: p["t"],
            ),
            ":",
        ).alias("body")
    )
    line = F.concat_ws(":", "sid", "body")
    return parts.groupBy(*owners).agg(
        F.array_join(F.array_sort(F.collect_list(line)), ",").alias("gtid_set")
    )


def gtid_set_lines(intervals: DataFrame, per_line: int = 1024, width: int = SEGMENT) -> DataFrame:
    """Canonical text in bounded pieces: at most ``per_line`` intervals each.

    The lines of a set, in (sid, line_no) order and joined by commas, are a
    valid GTID set text, since a sid may be listed more than once.
    """
    keys = set_keys(intervals)
    numbered = ordered_scan(
        settle(intervals, "islands"), keys, ["start"], by_width("start", width), __n=row_index()
    )
    return (
        numbered.withColumn("line_no", F.floor((F.col("__n") - 1) / per_line).cast("bigint"))
        .groupBy(*keys, "line_no")
        .agg(F.collect_list(F.struct("start", interval_text().alias("t"))).alias("p"))
        .select(
            *keys,
            "line_no",
            F.concat_ws(
                ":",
                F.col("sid"),
                F.array_join(F.transform(F.array_sort("p"), lambda p: p["t"]), ":"),
            ).alias("line"),
        )
    )


# Text form of a set: uuid:n[-m][:n[-m]...], comma separated.
UUID_TEXT = r"^[0-9A-Fa-f]{8}-?[0-9A-Fa-f]{4}-?[0-9A-Fa-f]{4}-?[0-9A-Fa-f]{4}-?[0-9A-Fa-f]{12}$"
UNSIGNED_TEXT = r"^\+?[0-9]+$"


def _number(text: Column) -> Column:
    return F.when(text.rlike(UNSIGNED_TEXT), text.try_cast("bigint"))


def parse_gtid_sets(df: DataFrame, text_col: str) -> DataFrame:
    """Explode set texts to ``sid, start, stop, error``; bad pieces keep a reason."""
    keep = [c for c in df.columns if c != text_col]
    pieces = df.filter(F.length(F.col(text_col)) > 0).select(
        *keep, F.explode(F.split(F.col(text_col), ",")).alias("__p")
    )
    split = pieces.withColumn("__f", F.split(F.trim("__p"), ":"))
    flat = split.select(
        *keep,
        F.col("__f")[0].alias("__sid"),
        F.explode_outer(F.expr("slice(__f, 2, size(__f))")).alias("__i"),
    ).withColumn("__b", F.split("__i", "-"))
    lo = _number(F.col("__b")[0])
    hi = _number(F.try_element_at("__b", F.lit(2)))
    bare = F.lower(F.regexp_replace("__sid", "-", ""))
    sid = F.concat_ws(
        "-",
        F.substring(bare, 1, 8),
        F.substring(bare, 9, 4),
        F.substring(bare, 13, 4),
        F.substring(bare, 17, 4),
        F.substring(bare, 21, 12),
    )
    size = F.size("__b")
    error = (
        F.when(F.col("__i").isNull(), "no interval")
        .when(~F.col("__sid").rlike(UUID_TEXT), "bad uuid")
        .when((size > 2) | lo.isNull() | ((size == 2) & hi.isNull()), "bad interval")
        .when((size == 2) & (hi < lo), "end before start")
    )
    return flat.select(
        *keep,
        F.when(error.isNull(), sid).alias("sid"),
        F.when(error.isNull(), lo).alias("start"),
        F.when(error.isNull(), F.coalesce(hi, lo) + 1).alias("stop"),
        error.alias("error"),
    )


def executed_as_of(
    transactions: DataFrame, source_keys: list[str], order: str, width: int = SEGMENT
) -> DataFrame:
    """Per commit: transactions of its sid so far, highest gno, and whether the
    executed part is one unbroken run from 1. The whole set is never built per row.

    ``transactions`` needs ``sid, gno`` and a numeric ``order`` column.
    """
    return ordered_scan(
        transactions,
        [*source_keys, "sid"],
        [order],
        by_width(order, width),
        executed=row_index(),
        high_gno=running_max("gno"),
    ).withColumn("contiguous", F.col("executed") == F.col("high_gno"))


def resume_points(
    transactions: DataFrame, source_keys: list[str], order: str, width: int = SEGMENT
) -> DataFrame:
    """The state before each commit: where a safe restart would stand."""
    before = ordered_scan(
        transactions,
        [*source_keys, "sid"],
        [order],
        by_width(order, width),
        prev_executed=running_sum(F.lit(1).cast("bigint"), inclusive=False),
        prev_high_gno=running_max("gno", inclusive=False),
    )
    return before.withColumn("prev_executed", F.nullif(F.col("prev_executed"), F.lit(0)))


