"""Column catalog against a plain walk over the columns; wide maps, repeated maps, short and missing lists."""

import random

import numpy as np
from pyspark.sql import functions as F

from tidelog.operators import catalog
from tidelog.session import spread_table

LISTS = ", ".join(f"{n} {t}" for n, t in catalog.LISTS.items())
SCHEMA = f"id int, types array<int>, metas array<int>, null_bitmap binary, {LISTS}"
NUMERIC, CHARACTER = {1, 2, 3, 4, 5, 8, 9, 246}, {15, 252, 253, 254}


def a_map(some, n):
    palette = [1, 3, 8, 246, 15, 252, 254, 255, 245, 10]
    types = [some.choice(palette) for _ in range(n)]
    metas = [some.choice([247 * 256 + 1, 248 * 256 + 1, 40]) if t == 254 else 4 for t in types]
    size = some.choice([0, n // 2, n])
    longs = lambda k: [some.randrange(200) for _ in range(k)]
    pairs = [x for k in some.sample(range(n + 3), min(n, 4)) for x in (k, some.randrange(300))]
    default = some.choice([None, [], [8], [8, *pairs], [8, *pairs, 1]])
    return (
        types, metas, some.randbytes(some.choice([0, (n + 7) // 8])), some.choice([None, some.randbytes((n + 7) // 8)]),
        default, longs(size), [f"c{i}" for i in range(some.choice([0, n]))],
        [[f"s{i}"] for i in range(size)], [[f"e{i}", "x"] for i in range(size)], some.choice([None, longs(size)]),
        [2, 0] if n > 2 else [], [5, 0] if n > 2 else [], some.choice([[], [9, 0, 77]]), some.choice([None, longs(size)]),
    )


def bit(data, i, msb):
    if data is None or i >> 3 >= len(data):
        return None
    return bool(data[i >> 3] >> (7 - i % 8 if msb else i % 8) & 1)


def at(values, k):
    return values[k] if values is not None and k < len(values) else None


def shown(default, listed, k):
    if default:
        found = default[0]
        for r, v in zip(default[1::2], default[2::2], strict=False):
            found = v if r == k else found
        return found
    return at(listed, k)


def expected(m):
    types, metas, nulls, signs, default, charset, names, sets, enums, geo, pk, prefix, es_default, es_charset = m
    seen, out = {"num": 0, "chr": 0, "enum": 0, "set": 0, "es": 0, "geo": 0}, []

    def rank(name):
        seen[name] += 1
        return seen[name] - 1

    for i, (t, meta) in enumerate(zip(types, metas, strict=True)):
        real = meta >> 8 if t == 254 and meta >> 8 in (247, 248) else 14 if t == 10 else t
        unsigned = bit(signs, rank("num"), True) if real in NUMERIC else None
        coll = shown(default, charset, rank("chr")) if real in CHARACTER else None
        labels = None
        if real in (247, 248):
            coll = shown(es_default, es_charset, rank("es"))
            labels = at(enums, rank("enum")) if real == 247 else at(sets, rank("set"))
        geometry = at(geo, rank("geo")) if t == 255 else None
        k = pk.index(i) if i in pk else None
        out.append((i, t, real, bit(nulls, i, False), unsigned, at(names, i), coll, labels, geometry, k, at(prefix, k) if k is not None else None))
    return out


def rows_of(df):
    wanted = ["ordinal", "type", "real_type", "nullable", "unsigned", "name", "collation", "labels", "geometry", "pk_ord", "pk_prefix"]
    out = {}
    for r in df.orderBy("id", "ordinal").collect():
        out.setdefault(r["id"], []).append(tuple(r[c] for c in wanted))
    return out


def test_random_maps_and_a_thousand_columns(spark):
    some = random.Random(3)
    maps = [a_map(some, n) for n in [1, 2, 3, 9, 17, 30, 1000] for _ in range(6)]
    # Repeated maps, and one that differs in null against empty only.
    maps += maps[:5] + [(*maps[3][:4], None, *maps[3][5:]), (*maps[3][:4], [], *maps[3][5:])]
    table = spark.createDataFrame([(i, *m) for i, m in enumerate(maps)], SCHEMA)
    assert rows_of(catalog.column_catalog(table, ["id"])) == {i: expected(m) for i, m in enumerate(maps)}


def test_no_columns_and_no_maps(spark):
    table = spark.createDataFrame([(0, [], [], *a_map(random.Random(1), 1)[2:])], SCHEMA)
    assert catalog.column_catalog(table, ["id"]).count() == 0
    assert catalog.column_catalog(table.limit(0), ["id"]).count() == 0


def test_each_distinct_map_is_resolved_once(spark):
    one = a_map(random.Random(5), 20)
    table = spark.range(5000).select(F.col("id").cast("int").alias("id")).crossJoin(
        spark.createDataFrame([(0, *one)], SCHEMA).drop("id")
    )
    df = catalog.column_catalog(table, ["id"])
    assert df.count() == 5000 * 20
    plan = df._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow") :]
    assert "HashAggregate" in below[: below.index("Exchange")] or "SortAggregate" in below[: below.index("Exchange")]


def test_ranks_are_prefix_sums():
    got = catalog.ranks(np.array([1, 0, 1, 1, 1, 0], bool), np.array([0, 3, 3, 6]))
    assert got.tolist() == [0, -1, 1, 0, 1, -1]


def test_equal_maps_are_combined_without_sorting_them(spark):
    """Maps with their lists are combined as they come; only distinct ones may be sorted."""
    from tidelog.plans.catalog_queries import table_maps

    maps = table_maps(spark, "/root/testdata/sf0.001")
    found = catalog.column_catalog(maps, ["event_id"])
    text = found._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(text) if "MapInArrow" in line)
    below = text[at + 1 :]
    assert any("HashAggregate" in line for line in below)
    assert not any("SortAggregate" in line or "Sort [" in line for line in below)
    assert found.count() == found.select("event_id", "ordinal").distinct().count()


def test_lists_that_hash_alike_are_one_definition(spark):
    """xxhash64 passes over NULLs inside lists: no row may come twice for it."""
    empty = [F.array().cast(t).alias(n) if t.startswith("array") else F.lit(b"").alias(n) for n, t in catalog.LISTS.items() if n != "column_names"]
    maps = spark.createDataFrame([(1, ["a", None]), (2, [None, "a"]), (3, ["a"])], "id int, column_names array<string>")
    types, metas = F.lit([3, 3]).cast("array<int>").alias("types"), F.lit([0, 0]).cast("array<int>").alias("metas")
    maps = maps.select("id", "column_names", types, metas, F.lit(b"\0").alias("null_bitmap"), *empty)
    got = catalog.column_catalog(maps, ["id"]).groupBy("id").count().collect()
    assert sorted(tuple(r) for r in got) == [(1, 2), (2, 2), (3, 2)]


def test_spread_rows_are_dealt_by_content(spark, tmp_path):
    """Whole rows, nulls and repeats too; equal rows lie in one file, so no split was sorted to deal them in turn."""
    rows = [(k % 300 if k % 7 else None, f"v{k % 300}", k % 300 / 4) for k in range(900)]
    made = spark.createDataFrame(rows, "id long, name string, value double").coalesce(1)
    made.write.parquet(str(tmp_path / "made.parquet"))
    found = spread_table(spark, str(tmp_path), "made")
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, rows))
    files = found.withColumn("file", F.input_file_name()).groupBy("id", "name", "value")
    assert found.select(F.input_file_name()).distinct().count() > 1
    assert {r["n"] for r in files.agg(F.countDistinct("file").alias("n")).collect()} == {1}
