"""Segmented scans equal plain windows, whatever the segment width."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidelog.operators import scan


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(7)
    # Key "hot" holds most rows; positions have holes.
    data = [
        ("hot" if rnd.random() < 0.7 else rnd.choice("ab"), p, rnd.choice("xyz"), rnd.choice([None, rnd.randint(-9, 9)]))
        for p in rnd.sample(range(3000), 700)
    ]
    return spark.createDataFrame(data, "k string, p bigint, s string, v int").cache()


@pytest.mark.parametrize("width", [1, 16, 500, 10**6])
def test_matches_windows(rows, width):
    w = Window.partitionBy("k").orderBy("p")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    fine = Window.partitionBy("k", "s").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.select(
        "*",
        F.coalesce(F.sum("v").over(upto), F.lit(0)).alias("total"),
        F.max("v").over(before).alias("top"),
        F.last("v", True).over(upto).alias("known"),
        F.last("v", True).over(before).alias("known_before"),
        F.lag("v").over(w).alias("prev"),
        F.lead("v").over(w).alias("next"),
        F.row_number().over(w).cast("bigint").alias("n"),
        F.max("v").over(Window.partitionBy("k")).alias("all_max"),
        F.last("v", True).over(fine).alias("known_fine"),
    )
    got = scan.ordered_scan(
        rows, ["k"], ["p"], scan.by_width("p", width),
        total=scan.running_sum("v"),
        top=scan.running_max("v", inclusive=False),
        known=scan.last_known("v"),
        known_before=scan.last_known("v", inclusive=False),
        prev=scan.previous("v"),
        next=scan.following("v"),
        n=scan.row_index(),
        all_max=scan.key_max("v"),
        known_fine=scan.last_known("v").per("s"),
    )
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_no_window_holds_a_whole_key(rows):
    plan = scan.ordered_scan(rows, ["k"], ["p"], scan.by_width("p", 16), t=scan.running_sum("v"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    over_rows = [line for line in text.splitlines() if "Window" in line and "__l_t" in line]
    # The windows over rows are per (key, segment), held in one struct.
    assert over_rows and all("__at0" in line for line in over_rows)
    assert "struct(k, " in text and "__seg0" in text


def shuffles(df, by):
    """How often rows are dealt by one column in the plan as it ran."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text[: text.index("== Initial Plan ==")]
    dealt = [line for line in final.splitlines() if "REPARTITION_BY_COL" in line and f"hashpartitioning({by}#" in line]
    return sum("ReusedExchange" not in line for line in dealt)


def test_rows_are_shuffled_once(rows):
    plan = scan.ordered_scan(rows, ["k"], ["p"], scan.by_width("p", 16), t=scan.running_sum("v"))
    assert shuffles(plan, "__at0") == 1
    # What the summaries shuffle has been combined.
    text = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [text[i + 1] for i, line in enumerate(text) if "Exchange hashpartitioning(__at0" in line and "ENSURE" in line]
    assert below and any("partial_sum" in line for line in below)


def test_summaries_of_one_key_are_windowed_in_blocks(spark):
    """One key, 10^6 segments: no task windows more than about their square root."""
    n = 1_000_000
    summary = spark.range(n).select(
        F.struct(F.lit("hot").alias("k"), F.col("id").alias("__seg0")).alias("at"),
        F.lit(1).cast("bigint").alias("__s_n"),
        F.when(F.col("id") % 1000 != 7, F.col("id")).alias("__s_k"),
        F.struct(F.col("id").alias("v")).alias("__s_f"),
    )
    tracks = {"n": scan.running_sum("v"), "k": scan.last_known("v"), "f": scan.following("v")}
    got = scan.inherited(summary, "at", ["k"], ["__seg0"], tracks)
    text = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line]
    # Over segments only inside a block; along the key only blocks, of which there are n / FAN.
    inside = [line for line in windows if "windowspecdefinition(__block#" in line]
    along = [line for line in windows if line not in inside]
    assert inside and along and all("AS __a_" in line for line in along) and scan.FAN <= 1000
    i = F.col("at")["__seg0"]
    before = i - 1
    known = F.when(i == 0, None).when(before % 1000 == 7, before - 1).otherwise(before)
    ahead = F.when(i < n - 1, i + 1)
    wrong = got.filter(
        ~(F.coalesce("__c_n", F.lit(0)).eqNullSafe(i) & F.col("__c_k").eqNullSafe(known) & F.col("__c_f")["v"].eqNullSafe(ahead))
    )
    assert got.count() == n and wrong.count() == 0


def test_blocks_match_windows(rows, monkeypatch):
    monkeypatch.setattr(scan, "FAN", 4)
    test_matches_windows(rows, 16)


def test_following_segments_are_not_read_anew(spark):
    """A frame from the next row to the end of the key costs the square of the segments."""
    located = spark.range(2000).select(
        F.lit("hot").alias("k"), (F.col("id") / 2).cast("bigint").alias("file"), (F.col("id") % 2).alias("pos"), "id"
    )
    order = ["file", "pos"]
    got = scan.ordered_scan(located, ["k"], order, [F.col("file"), F.floor(F.col("pos") / 2)], n=scan.following("id"))
    want = located.withColumn("n", F.lead("id").over(Window.partitionBy("k").orderBy(*order)))
    assert sorted(got.collect()) == sorted(want.collect())
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "unboundedfollowing$" not in text
    # Segments of two columns are windowed in blocks, too.
    along = [line for line in text.splitlines() if "Window [" in line and "windowspecdefinition(__block" not in line]
    assert any("AS __a_" in line for line in along) and not any("AS __c_" in line for line in along)


@pytest.mark.parametrize("fan", [1, 3, 1000])
def test_segments_of_two_columns_with_nulls(spark, monkeypatch, fan):
    monkeypatch.setattr(scan, "FAN", fan)
    places = [(f, p) for f in [None, -7, 0, 1, 5, 6, 40] for p in [None, 0, 1, 9, 20]]
    data = [(k, f, p, i if i % 3 else None) for i, (k, (f, p)) in enumerate((k, x) for k in ("a", None) for x in places)]
    rows = spark.createDataFrame(data, "k string, f bigint, p bigint, v int")
    w = Window.partitionBy("k").orderBy("f", "p")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = rows.select(
        "*", F.lead("v").over(w).alias("next"), F.lag("v").over(w).alias("prev"), F.last("v", True).over(upto).alias("known"),
        F.coalesce(F.sum("v").over(upto), F.lit(0)).alias("total"),
    )
    got = scan.ordered_scan(
        rows, ["k"], ["f", "p"], [F.col("f"), F.floor(F.col("p") / 8)], next=scan.following("v"), prev=scan.previous("v"),
        known=scan.last_known("v"), total=scan.running_sum("v"),
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
