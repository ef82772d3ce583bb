"""Ordered scans that survive a hot key.

A window over ``partitionBy(key).orderBy(position)`` puts a whole key into one
task. Log data has few sources, few server ids and few tables, so that task
would hold a large share of all rows. ``ordered_scan`` cuts each key into
segments of a bounded position range instead:

1. one aggregate row per (key, segment) - partial aggregation, tiny output;
2. a window over those summaries gives what each segment inherits;
3. the rows are windowed inside (key, segment) only and combined with it.

The result equals the plain window exactly, also for null keys and positions (nulls
are one key, and one segment before all others). ``segment`` must never decrease as
``order`` grows, and ``order`` must be unique within a key. The input is read once per summary and once for the rows, so chains of
scans settle what lies between them (``session.settle``) and the plan stays
linear in the number of scans. In step 2 a key with 10^12 positions and segments of 2^18 positions
leaves 4 million short rows, and those only as large as the tracked values. The rows are
shuffled once, by key and segment; summaries are combined before their shuffle.

Step 2 is split in the same way: segments of a key are grouped into blocks of ``FAN`` segment
numbers, one row per block is windowed along the key, and segments are windowed inside their block only.
So a key of 10^6 segments is a window of a thousand blocks and a thousand windows of a
thousand segments. Of segments told by several columns the first one deals the blocks; segments
whose first column is no integer are windowed as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

# Positions per segment: bounds the rows one window task sorts for one key.
SEGMENT = 1 << 18
# Segment numbers per block of summaries.
FAN = 1000

_FIRST, _LAST = Window.unboundedPreceding, Window.unboundedFollowing


@dataclass(frozen=True)
class Track:
    """One value followed along the order (build with the functions below)."""

    summary: Callable[[Column], Column]
    # Over the segments in order, or over the same segments in reverse.
    inherit: Callable[[Column, WindowSpec, WindowSpec], Column]
    local: Callable[[WindowSpec], Column]
    combine: Callable[[Column, Column], Column]
    # Summaries of summaries: one value for a block, and what a segment inherits from the
    # blocks around it and from the segments of its own.
    fold: Callable[[Column, Column], Column]
    merge: Callable[[Column, Column], Column]
    finer: tuple[str, ...] = ()

    def per(self, *extra_keys: str) -> Track:
        """Follow the value separately for each value of some more key columns."""
        return replace(self, finer=extra_keys)


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _upto(inclusive: bool) -> tuple[int, int]:
    return (_FIRST, 0 if inclusive else -1)


def running_sum(value: str | Column, inclusive: bool = True) -> Track:
    x, frame, zero = _col(value), _upto(inclusive), F.lit(0)
    return Track(
        summary=lambda order: F.sum(x),
        inherit=lambda s, w, back: F.sum(s).over(w.rowsBetween(_FIRST, -1)),
        local=lambda w: F.sum(x).over(w.rowsBetween(*frame)),
        combine=lambda c, v: F.coalesce(c, zero) + F.coalesce(v, zero),
        fold=lambda s, at: F.sum(s),
        merge=lambda c, v: F.coalesce(c, zero) + F.coalesce(v, zero),
    )


def row_index() -> Track:
    """1-based row number within the key."""
    return running_sum(F.lit(1).cast("bigint"))


def running_max(value: str | Column, inclusive: bool = True) -> Track:
    x, frame = _col(value), _upto(inclusive)
    return Track(
        summary=lambda order: F.max(x),
        inherit=lambda s, w, back: F.max(s).over(w.rowsBetween(_FIRST, -1)),
        local=lambda w: F.max(x).over(w.rowsBetween(*frame)),
        combine=F.greatest,
        fold=lambda s, at: F.max(s),
        merge=F.greatest,
    )


def last_known(value: str | Column, inclusive: bool = True) -> Track:
    """Latest non-null value so far."""
    x, frame = _col(value), _upto(inclusive)
    return Track(
        summary=lambda order: F.max_by(x, F.when(x.isNotNull(), order)),
        inherit=lambda s, w, back: F.last(s, True).over(w.rowsBetween(_FIRST, -1)),
        local=lambda w: F.last(x, True).over(w.rowsBetween(*frame)),
        combine=lambda c, v: F.coalesce(v, c),
        fold=lambda s, at: F.max_by(s, F.when(s.isNotNull(), at)),
        merge=lambda c, v: F.coalesce(v, c),
    )


def previous(value: str | Column) -> Track:
    """Value of the row just before (null values included)."""
    boxed = F.struct(_col(value).alias("v"))
    return Track(
        summary=lambda order: F.max_by(boxed, order),
        inherit=lambda s, w, back: F.last(s, True).over(w.rowsBetween(_FIRST, -1)),
        local=lambda w: F.lag(boxed).over(w),
        combine=lambda c, v: F.coalesce(v, c)["v"],
        fold=lambda s, at: F.max_by(s, at),
        merge=lambda c, v: F.coalesce(v, c),
    )


def following(value: str | Column) -> Track:
    """Value of the row just after (null values included)."""
    boxed = F.struct(_col(value).alias("v"))
    return Track(
        summary=lambda order: F.min_by(boxed, order),
        # In reverse, as a frame that ends with the key is read anew for each row.
        inherit=lambda s, w, back: F.last(s, True).over(back.rowsBetween(_FIRST, -1)),
        local=lambda w: F.lead(boxed).over(w),
        combine=lambda c, v: F.coalesce(v, c)["v"],
        fold=lambda s, at: F.min_by(s, at),
        merge=lambda c, v: F.coalesce(v, c),
    )


def key_max(value: str | Column) -> Track:
    """Maximum over the whole key, without another pass over the rows."""
    x = _col(value)
    return Track(
        summary=lambda order: F.max(x),
        inherit=lambda s, w, back: F.max(s).over(w.rowsBetween(_FIRST, _LAST)),
        local=lambda w: F.max(x).over(w.rowsBetween(_FIRST, _LAST)),
        combine=lambda c, v: c,
        fold=lambda s, at: F.max(s),
        merge=lambda c, v: c,
    )


def by_width(position: str | Column, width: int = SEGMENT) -> Column:
    """Segment of an integer position (exact for all 64 bits)."""
    return F.call_function("div", _col(position).cast("bigint"), F.lit(width).cast("bigint"))


def inherited(summary: DataFrame, name: str, own: Sequence[str], seg: Sequence[str], tracks: dict[str, Track]) -> DataFrame:
    """What each segment takes over along its key: ``name`` and one ``__c_`` column per track.

    ``summary`` has one row per segment: the struct ``name`` of key columns ``own`` and segment
    columns ``seg``, and one ``__s_`` column per track.
    """
    key = [F.col(name)[c] for c in own] or [F.lit(0)]
    at = [F.col(name)[c] for c in seg]

    def both(key: Sequence[Column], order: Sequence[Column]) -> tuple[WindowSpec, WindowSpec]:
        along = Window.partitionBy(*key)
        return along.orderBy(*order), along.orderBy(*[o.desc() for o in order])

    if not isinstance(summary.select(at[0]).schema[0].dataType, T.IntegralType):
        along = both(key, at)
        return summary.select(name, *[t.inherit(F.col(f"__s_{n}"), *along).alias(f"__c_{n}") for n, t in tracks.items()])
    block = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(key)], by_width(at[0], FAN).alias("block"))
    dealt = summary.withColumn("__block", block).repartition("__block")
    folded = dealt.groupBy("__block").agg(
        *[t.fold(F.col(f"__s_{n}"), F.struct(*at)).alias(f"__f_{n}") for n, t in tracks.items()]
    )
    along = both([F.col("__block")[f"k{i}"] for i in range(len(key))], [F.col("__block")["block"]])
    around = folded.select(
        "__block", *[t.inherit(F.col(f"__f_{n}"), *along).alias(f"__a_{n}") for n, t in tracks.items()]
    )
    inside = both([F.col("__block")], at)
    met = dealt.join(around, "__block").withColumns(
        {f"__i_{n}": t.inherit(F.col(f"__s_{n}"), *inside) for n, t in tracks.items()}
    )
    return met.select(
        name, *[t.merge(F.col(f"__a_{n}"), F.col(f"__i_{n}")).alias(f"__c_{n}") for n, t in tracks.items()]
    )


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: Column | Sequence[Column],
    **tracks: Track,
) -> DataFrame:
    """Add one column per track, each as a plain window over (keys, order) would give."""
    parts = list(segment) if isinstance(segment, (list, tuple)) else [segment]
    seg = [f"__seg{i}" for i in range(len(parts))]
    finers = list(dict.fromkeys(t.finer for t in tracks.values()))
    # Key and segment as one struct: it compares null-safe, and join and window both ask
    # for the partitioning it gives.
    at = {finer: f"__at{i}" for i, finer in enumerate(finers)}
    base = df.withColumns(dict(zip(seg, parts)))
    base = base.withColumns({name: F.struct(*keys, *finer, *seg) for finer, name in at.items()})
    order_key = F.struct(*order) if len(order) > 1 else F.col(order[0])

    located = base.repartition(at[finers[0]]) if len(finers) == 1 else base
    for finer, name in at.items():
        mine = {n: t for n, t in tracks.items() if t.finer == finer}
        summary = base.groupBy(name).agg(*[t.summary(order_key).alias(f"__s_{n}") for n, t in mine.items()])
        located = located.join(inherited(summary, name, [*keys, *finer], seg, mine), name)
    inside = {finer: Window.partitionBy(name).orderBy(*order) for finer, name in at.items()}
    located = located.withColumns({f"__l_{n}": t.local(inside[t.finer]) for n, t in tracks.items()})
    return located.select(
        *[F.col(c) for c in df.columns],
        *[t.combine(F.col(f"__c_{n}"), F.col(f"__l_{n}")).alias(n) for n, t in tracks.items()],
    )
