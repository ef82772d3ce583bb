"""Set operators against sets of single numbers; text forms; flavors."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import flavor, gtid, mariadb


def random_sets(seed, owners=3, sids=3, n=14):
    rnd = random.Random(seed)
    rows = []
    for o in range(owners):
        for s in range(sids):
            for _ in range(rnd.randint(0, n)):
                start = rnd.randint(1, 120)
                rows.append((o, f"s{s}", start, start + rnd.randint(1, 25)))
    return rows


def members(rows):
    out = {}
    for o, s, a, b in rows:
        out.setdefault((o, s), set()).update(range(a, b))
    return {k: m for k, m in out.items() if m}


def islands(points):
    out, run = [], None
    for p in sorted(points):
        if run and p == run[1]:
            run[1] = p + 1
        else:
            run = [p, p + 1]
            out.append(run)
    return [tuple(r) for r in out]


def expected(sets):
    return sorted((o, s, a, b) for (o, s), m in sets.items() for a, b in islands(m))


SCHEMA = "set_id int, sid string, start bigint, stop bigint"


@pytest.mark.parametrize("seed,width", [(1, 7), (2, 1000), (3, 1)])
def test_algebra(spark, seed, width):
    ra, rb = random_sets(seed), random_sets(seed + 100)
    a, b = spark.createDataFrame(ra, SCHEMA), spark.createDataFrame(rb, SCHEMA)
    ma, mb = members(ra), members(rb)
    keys = set(ma) | set(mb)
    got = lambda df: sorted(map(tuple, df.collect()))
    both = lambda op: {k: op(ma.get(k, set()), mb.get(k, set())) for k in keys}
    assert got(gtid.normalize(a, width)) == expected(ma)
    assert got(gtid.union_sets(a, b, width)) == expected(both(set.union))
    assert got(gtid.subtract_sets(a, b, width)) == expected(both(set.difference))
    assert got(gtid.intersect_sets(a, b, width)) == expected(both(set.intersection))
    single = spark.createDataFrame([(o, s, g) for (o, s), m in ma.items() for g in m], "set_id int, sid string, gno bigint")
    assert got(gtid.executed_set(single.unionByName(single), width)) == expected(ma)
    inside = {(o, s, g) for (o, s), m in ma.items() for g in m & mb.get((o, s), set())}
    assert set(map(tuple, gtid.in_set(single, b, width).collect())) == inside
    assert gtid.not_in_set(single, b, width).count() == single.count() - len(inside)
    verdict = {r[0]: r[1] for r in gtid.compare_sets(a, b, width).collect()}
    for o in {k[0] for k in keys}:
        pa = {(s, g) for (x, s), m in ma.items() if x == o for g in m}
        pb = {(s, g) for (x, s), m in mb.items() if x == o for g in m}
        assert verdict[o] == (0 if pa == pb else 1 if pb <= pa else -1)


def test_touching_and_nested(spark):
    rows = [("u", 23, 24), ("u", 28, 58), ("v", 23, 28), ("v", 28, 58), ("w", 1, 100), ("w", 2, 3), ("w", 99, 101)]
    sets = spark.createDataFrame(rows, "sid string, start bigint, stop bigint")
    assert sorted(map(tuple, gtid.normalize(sets, 10).collect())) == [
        ("u", 23, 24), ("u", 28, 58), ("v", 23, 58), ("w", 1, 101),
    ]


def test_subtract_from_the_middle_and_both_ends(spark):
    make = lambda rows: spark.createDataFrame(rows, "sid string, start bigint, stop bigint")
    a = make([("u", 1, 100), ("gone", 5, 6)])
    b = make([("u", 1, 10), ("u", 50, 51), ("u", 90, 200), ("gone", 1, 50)])
    assert sorted(map(tuple, gtid.subtract_sets(a, b).collect())) == [("u", 10, 50), ("u", 51, 90)]


def test_text_round_trip(spark):
    text = (
        "de278ad0-2106-11e4-9f8e-6edd0ca20947:1-2:7:9-10, "
        "3E11FA47-71CA-11E1-9E33-C80AA9429562:5"
    )
    df = spark.createDataFrame([(1, text), (2, "nonsense"), (3, "de278ad0-2106-11e4-9f8e-6edd0ca20947:5-3")], "set_id int, t string")
    parsed = gtid.parse_gtid_sets(df, "t")
    bad = {r["set_id"]: r["error"] for r in parsed.filter("error is not null").collect()}
    assert bad == {2: "no interval", 3: "end before start"}
    good = parsed.filter("error is null").drop("error")
    line = gtid.gtid_set_text(gtid.normalize(good)).collect()[0]["gtid_set"]
    assert line == "3e11fa47-71ca-11e1-9e33-c80aa9429562:5,de278ad0-2106-11e4-9f8e-6edd0ca20947:1-2:7:9-10"


def test_set_lines_are_bounded_and_complete(spark):
    sid = "3e11fa47-71ca-11e1-9e33-c80aa9429562"
    rows = [(sid, 10 * i, 10 * i + 2) for i in range(1, 50)]
    sets = spark.createDataFrame(rows, "sid string, start bigint, stop bigint")
    lines = gtid.gtid_set_lines(sets, per_line=8, width=64).orderBy("line_no").collect()
    assert [r["line"].count(":") for r in lines] == [8] * 6 + [1]
    again = gtid.parse_gtid_sets(spark.createDataFrame([(",".join(r["line"] for r in lines),)], "t string"), "t")
    assert sorted((r["start"], r["stop"]) for r in again.collect()) == [(a, b) for _, a, b in rows]


def test_mariadb(spark):
    texts = spark.createDataFrame([(1, "1-2-3,4-5-6"), (2, ""), (3, "1-2"), (4, "1-2-x"), (5, "4294967296-1-1")], "id int, t string")
    rows = {(r["id"], r["ordinal"]): r for r in mariadb.parse_mariadb_gtids(texts, "t").collect()}
    assert (rows[1, 1]["domain_id"], rows[1, 1]["server_id"], rows[1, 1]["seq"]) == (4, 5, 6)
    assert rows[2, 0]["domain_id"] == 0 and rows[2, 0]["error"] is None
    assert rows[3, 0]["error"] and rows[4, 0]["error"] and rows[5, 0]["error"]
    g = lambda *xs: spark.createDataFrame(xs, "set_id int, domain_id bigint, server_id bigint, seq bigint")
    contains = lambda a, b: mariadb.mariadb_contains(a, b, ["set_id"]).collect()[0]["contains"]
    assert contains(g((1, 1, 2, 1)), g((1, 1, 1, 1)))
    assert not contains(g((1, 2, 1, 1)), g((1, 1, 1, 1)))
    equal = mariadb.mariadb_equal(g((1, 1, 2, 1)), g((1, 1, 1, 1)), ["set_id"]).collect()[0]["equal"]
    assert not equal


def test_flavors(spark):
    m = spark.createDataFrame([(1, "u", 1, 5)], "set_id int, sid string, start bigint, stop bigint")
    d = spark.createDataFrame([(1, 1, 1, 5)], "set_id int, domain_id int, server_id int, seq int")
    assert flavor.contains(m, m, ["set_id"], "mysql").collect()[0]["contains"]
    assert not flavor.equal(m, d, ["set_id"], "mysql", "mariadb").collect()[0]["equal"]
    with pytest.raises(ValueError):
        flavor.parse_sets(m, "sid", "other")
    zero = flavor.parse_sets(spark.createDataFrame([("",)], "t string"), "t", "mariadb")
    assert zero.select(F.col("domain_id")).collect()[0][0] == 0


def test_null_transactions_are_not_members(spark):
    rows = [("s", 1), ("s", 2), (None, 3), ("s", None)]
    single = spark.createDataFrame(rows, "sid string, gno bigint")
    one = spark.createDataFrame([("s", 1, 2)], "sid string, start bigint, stop bigint")
    missing = {(r.sid, r.gno) for r in gtid.not_in_set(single, one).collect()}
    assert missing == {("s", 2), (None, 3), ("s", None)}
    assert [(r.sid, r.gno) for r in gtid.in_set(single, one).collect()] == [("s", 1)]


def test_set_algebra_writes_its_points_once(spark):
    """One written table per operator, and one sweep: points are dealt by range once for the rows and once for the next bounds."""
    import os

    from test_scan import shuffles

    from tidelog.session import shared_folder

    a = spark.createDataFrame([(1, "s", 1, 9), (1, "s", 9, 12), (1, "t", 5, 6)], "set_id int, sid string, start bigint, stop bigint")
    b = spark.createDataFrame([(1, "s", 3, 4), (1, "u", 1, 2)], a.schema)
    folder = shared_folder(spark)
    for made in (gtid.union_sets, gtid.subtract_sets, gtid.intersect_sets, gtid.contains_sets, gtid.compare_sets):
        before = set(os.listdir(folder))
        plan = made(a, b)
        assert len(set(os.listdir(folder)) - before) == 1
        assert shuffles(plan, "__at") <= 2
        assert len(set(os.listdir(folder)) - before) == 1
    assert sorted(map(tuple, gtid.subtract_sets(a, b).collect())) == [(1, "s", 1, 3), (1, "s", 4, 12), (1, "t", 5, 6)]
    assert gtid.gaps(a).count() == 0


def test_rows_without_an_interval(spark):
    schema = "sid string, start bigint, stop bigint"
    odd = spark.createDataFrame([("s", None, 5), ("s", 3, None), ("s", 4, 4), ("s", 9, 2), ("s", 6, 8), (None, 1, 2)], schema)
    assert sorted(map(str, map(tuple, gtid.normalize(odd, 2).collect()))) == ["('s', 6, 8)", "(None, 1, 2)"]
