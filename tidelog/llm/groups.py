"""Connected groups of links, as joins and aggregates over tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidelog.session import settle, settle_alone

#: A list of more keys than ``BUSY`` is paired with ``HEADS`` of its keys, at most ``ROUNDS`` times
#: with others, before all its pairs of different groups are tried.
BUSY, HEADS, ROUNDS = 16, 8, 4


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id it can reach.

    Each round takes the smallest label among the neighbours, then the label of that
    label, so distances halve. Labels meet links by a join and are combined by
    minimum before the shuffle: an id with very many links is no single task. Every
    round is a written table. Null ends link nothing.
    """
    pairs = links.select("a", "b").filter("a <> b")
    both = settle(pairs.union(pairs.select("b", "a")).distinct(), "links")
    labels = settle(
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label")).withColumn("label", F.least("id", "label")),
        "labels",
    )
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["id"] == near["a"]).select("id", F.least("label", "near").alias("low"), "label")
        ahead = labels.select(F.col("id").alias("low"), F.col("label").alias("jump"))
        labels = settle(
            step.join(ahead, "low").select(
                "id", F.least("low", "jump").alias("label"), (F.least("low", "jump") != F.col("label")).alias("moved")
            ),
            "labels",
        )
        if labels.filter("moved").isEmpty():
            return labels.select("id", F.col("label").alias("component"))


def meetings(rows: DataFrame, may: Column) -> DataFrame:
    """Pairs x, y of rows (gram, key, ...) of one gram, smaller key first, if ``may`` holds for them.

    Two keys with the same gram before this one have met there already, so what near copies
    have in common makes one row for each run of shared grams, not one for each gram.
    """
    rows = settle(rows.withColumn("before", F.lag("gram").over(W.partitionBy("key").orderBy("gram"))), "mixed")
    same = F.expr("x.gram = y.gram and x.key < y.key and (x.before <> y.before or x.before is null or y.before is null)")
    return rows.alias("x").join(rows.alias("y"), same & may)


def star_and_rest(
    items: DataFrame,
    carry: list[str],
    may_link: Callable,
    verify: Callable[[DataFrame], DataFrame],
    more: DataFrame | None = None,
    may_meet: Callable | None = None,
) -> DataFrame:
    """Links that give the exact groups of ``items`` (gram, key, *carry): keys may link if they share a gram.

    A list is the keys of one gram. First only its smallest key is paired with the others,
    and groups are formed. In long lists a few keys, drawn by hash, are then paired with all that are
    still in other groups, and others again as long as that finds many links. Then pairs of one list
    that are still in different groups are tried, unless they were. Pairs within a group change nothing,
    so a group of near copies costs its size, not its square, also if its smallest key links with few
    of it, and no link between groups is lost.

    ``may_link`` rules a pair out by what its two rows carry (mappings of columns, in either order): if
    it is false for any gram they share, the pair must not link;
    ``verify`` takes pairs (a, b, and each carried column with _a and _b) and returns the
    (a, b) that link. ``more`` has further columns per key, which ``may_meet`` looks at,
    too, before pairs are verified, and before pairs of different groups are made.
    """
    cols = ["key", *carry]
    over = W.partitionBy("gram")
    head, last = ({c: F.col(f"{end}.{c}") for c in cols} for end in ("head", "last"))
    lists = (
        items.withColumn("head", F.min(F.struct(*cols)).over(over))
        .withColumn("last", F.max(F.struct(*cols)).over(over))
        .filter("head.key <> last.key")
        # Most lists are two keys that met by chance.
        .withColumn("more", F.max((F.col("key") != head["key"]) & (F.col("key") != last["key"])).over(over))
        .filter(F.col("more") | may_link(head, last))
        .withColumn("n", F.count(F.lit(1)).over(over))
        .dropDuplicates(["gram", "key"])
        .drop("last", "more")
    )
    lists = settle(lists, "lists")

    def paired(x: dict, y: dict) -> list:
        sides = [(x, "a"), (y, "b")]
        return [s["key"].alias(n) for s, n in sides] + [s[c].alias(f"{c}_{n}") for c in carry for s, n in sides]

    x, y = {c: F.col(f"head.{c}") for c in cols}, {c: F.col(c) for c in cols}
    star = lists.filter((x["key"] < y["key"]) & may_link(x, y)).select(*paired(x, y)).dropDuplicates(["a", "b"])
    if may_meet is not None:
        own = [c for c in more.columns if c != "key"]
        one, two = (more.withColumnsRenamed({"key": s, **{c: f"{c}_{s}" for c in own}}) for s in "ab")
        x, y = ({c: F.col(f"{c}_{s}") for c in [*carry, *own]} for s in "ab")
        star = star.join(two, "b").join(one, "a").filter(may_meet(x, y)).select(*star.columns)
    star = settle(star, "star")
    links, tried = settle_alone(lambda: verify(star), "links"), star.select("a", "b")

    def named(links: DataFrame) -> DataFrame:
        return components(links).withColumnsRenamed({"id": "key", "component": "group"})

    def several(rows: DataFrame, grouped: DataFrame) -> DataFrame:
        """Rows with their group, of lists that hold more than one."""
        marked = rows.join(grouped, "key", "left").withColumn("group", F.coalesce("group", "key"))
        marked = marked.withColumn("low", F.min("group").over(over)).withColumn("high", F.max("group").over(over))
        return marked.filter("low <> high").drop("low", "high")

    grouped, whole = named(links), cols if more is None else [*cols, *(c for c in more.columns if c != "key")]
    busy = lists.filter(F.col("n") > BUSY).drop("head", "n")
    busy = settle(busy if more is None else busy.join(more, "key"), "busy")

    def may_pair(drawn: Column) -> Column:
        x, y = {c: drawn[c] for c in whole}, {c: F.col(c) for c in whole}
        may = (drawn["group"] != F.col("group")) & may_link(x, y)
        return may if may_meet is None else may & may_meet(x, y)

    for turn in range(ROUNDS):
        own = F.struct(*whole, "group")
        draw = F.row_number().over(over.orderBy(F.xxhash64("key", F.lit(turn)), "key"))
        heads = F.collect_list(F.when(F.col("draw") <= HEADS, own)).over(over)
        met = several(busy, grouped).withColumn("draw", draw).withColumn("drawn", heads)
        # Only what may link becomes a row.
        met = met.withColumn("drawn", F.explode(F.filter("drawn", may_pair)))
        met = met.select(F.least("drawn", own).alias("x"), F.greatest("drawn", own).alias("y"))
        x, y = ({c: F.col(f"{end}.{c}") for c in whole} for end in "xy")
        met = met.select(*paired(x, y)).dropDuplicates(["a", "b"]).join(tried, ["a", "b"], "left_anti")
        met = settle(met, "star")
        found = settle_alone(lambda met=met: verify(met), "links")
        tried = tried.union(met.select("a", "b"))
        news = found.count()
        if news:
            links = links.unionByName(found)
            grouped = named(links)
        # Few links mean that few keys are left alone that could have any.
        if not news or news * 20 < busy.count():
            break

    # The smallest key was paired with all others, so lists of two keys are done.
    mixed = several(lists.filter((F.col("n") > 2) & (F.col("key") != head["key"])).drop("head", "n"), grouped)
    mixed = mixed if more is None else mixed.join(more, "key")
    x, y = ({c: F.col(f"{side}.{c}") for c in mixed.columns} for side in "xy")
    may = (x["group"] != y["group"]) & may_link(x, y)
    if may_meet is not None:
        may &= may_meet(x, y)
    rest = meetings(mixed, may).select(*paired(x, y)).dropDuplicates(["a", "b"])
    rest = settle(rest.join(tried, ["a", "b"], "left_anti"), "rest")
    return links if rest.isEmpty() else links.unionByName(settle_alone(lambda: verify(rest), "links"))
