"""Replay, merge, pairing, minimal images, transactions, binding, positions - on small tables."""

import pytest
from pyspark.sql import functions as F

from tidelog.operators import changes, jsondiff, position, rows, transactions
from tidelog.sources import binlog
from tidelog.streaming import feeds, state


def test_replay_and_merge(spark):
    log = spark.createDataFrame(
        [(1, 1, "I", "a"), (2, 1, "U", "b"), (3, 2, "I", "c"), (4, 2, "D", None), (5, 3, "I", None), (6, 2, "I", "again")],
        "seq bigint, pk int, op string, value string",
    )
    got = {r.pk: r.value for r in changes.replay(log, ["pk"], ["seq"]).collect()}
    assert got == {1: "b", 2: "again", 3: None}
    base = spark.createDataFrame([(1, "old"), (9, "kept"), (2, "x")], "pk int, value string")
    cut = log.filter("seq < 6")
    merged = {r.pk: r.value for r in changes.merge_changes(base, cut, ["pk"], ["seq"]).collect()}
    assert merged == {1: "b", 9: "kept", 3: None}


def test_written_null_is_not_a_skipped_value(spark):
    rows_ = [(1, "k", "v", False), (2, "k", None, True), (3, "k", None, False), (4, "k", None, True), (5, "j", None, True)]
    df = spark.createDataFrame(rows_, "seq bigint, pk string, value string, skipped boolean")
    for width in (1, 100):
        filled = changes.fill_minimal(df, ["pk"], "seq", "value", "skipped", width)
        assert {r.seq: r.value_filled for r in filled.collect()} == {1: "v", 2: "v", 3: None, 4: None, 5: None}


def test_skipped_columns(spark):
    df = spark.createDataFrame([([0, 2], 4), ([], 2), ([0], 1)], "p array<int>, n int")
    got = [r[0] for r in df.select(changes.skipped_columns(F.col("p"), F.col("n"))).collect()]
    assert got == [[1, 3], [0, 1], []]


def test_events_between_transactions_belong_to_none(spark):
    kinds = ["ROWS", "GTID", "ROWS", "XID", "ROWS", "GTID", "ROWS"]
    df = spark.createDataFrame([(0, i, k, i * 10 if k == "GTID" else None) for i, k in enumerate(kinds)], "f int, pos bigint, kind string, gno bigint")
    for width in (2, 1000):
        out = transactions.assign_transactions(
            df, ["f"], "pos", F.col("kind") == "GTID", F.col("kind") == "XID", "gno", width
        )
        assert [r.tx_id for r in out.orderBy("pos").collect()] == [None, 10, 10, 10, None, 50, 50]


def test_binding_across_segments(spark):
    # map(1) row row end | row without map | map(2) map(1) row(1) row(2)
    data = [(0, 19, 1, False), (1, 30, 1, False), (2, 30, 1, True), (3, 30, 1, False), (4, 19, 2, False), (5, 19, 1, False), (6, 30, 1, False), (7, 30, 2, True), (8, 30, 2, False)]
    df = spark.createDataFrame([("f", *d) for d in data], "f string, pos bigint, event_type int, table_id int, stmt_end boolean")
    for width in (1, 3, 100):
        bound = rows.bind_table_maps(df, ["f"], "pos", F.col("event_type") == 19, F.col("stmt_end"), "pos", width)
        got = {r.pos: r.table_map for r in bound.filter("event_type = 30").collect()}
        assert got == {1: 0, 2: 0, 3: None, 6: 5, 7: 4, 8: None}
        assert {r.pos for r in rows.orphans(bound.filter("event_type = 30")).collect()} == {3, 8}


def test_positions(spark):
    pairs = [("mysql-bin.999999", 10, "mysql-bin.1000000", 4, -1), ("", 0, "a.1", 0, -1), ("a.1", 5, "a.1", 5, 0), ("b.1", 0, "a.9", 0, 1), ("x.y.2", 1, "x.y.10", 0, -1), ("plain", 0, "plain", 1, -1), ("a.x", 0, "a.1", 0, None)]
    df = spark.createDataFrame(pairs, "a string, pa bigint, b string, pb bigint, want int")
    cmp = position.position_compare(position.position(F.col("a"), F.col("pa")), position.position(F.col("b"), F.col("pb")))
    assert [(r.a, r.got) for r in df.select("a", cmp.alias("got")).collect()] == [(p[0], p[4]) for p in pairs]
    assert binlog.position_key("mysql-bin.1000000") > binlog.position_key("mysql-bin.999999")


def test_json_paths(spark):
    assert jsondiff.path_steps('$.a."b c"[2].d') == ["a", "b c", 2, "d"]
    docs = spark.createDataFrame(
        [('{"a":{"b":[1,2]}}', [("insert", "$.a.b[1]", "9"), ("remove", "$.a.b[0]", None)]), ('{"a":1}', [("replace", "$.x.y", "1")])],
        "doc string, diffs array<struct<op:string,path:string,value:string>>",
    )
    out = jsondiff.apply_json_diffs(docs, "doc", "diffs").collect()
    assert out[0].doc == '{"a":{"b":[9,2]}}' and out[0].diff_error is None
    assert out[1].doc is None and out[1].diff_error.startswith("KeyError")


def test_interval_state():
    assert state.add_gnos([], [3, 1, 2, 2, 7]) == [(1, 4), (7, 8)]
    assert state.add_gnos([(1, 4), (7, 8)], [5, 6, 4]) == [(1, 8)]


def test_windows_agree_with_batch(spark):
    base = spark.createDataFrame([(i * 600, "x" if i % 3 else "y") for i in range(60)], "s bigint, k string")
    df = base.select(F.timestamp_seconds("s").alias("ts"), "k")
    hourly = feeds.activity(df, window="1 hour", by=("k",)).collect()
    assert sum(r.n for r in hourly) == 60
    sliding = feeds.activity(df, window="1 hour", slide="30 minutes").collect()
    assert sum(r.n for r in sliding) == 120
    assert len(feeds.activity(df, session_gap="5 minutes").collect()) == 60
    assert len(feeds.activity(df, session_gap="15 minutes").collect()) == 1


def test_next_position_spans_files(spark):
    data = [(0, "b.1", 100, None, None), (1, "b.1", 0, None, None), (2, "b.1", 150, "b.2", 4), (3, "b.2", 0, None, None), (4, "b.2", 60, None, None)]
    df = spark.createDataFrame([("s", *d) for d in data], "source string, n bigint, file string, log_pos bigint, rotate_file string, rotate_pos bigint")
    got = transactions.next_position(df, ["source"], "n", 2).orderBy("n").collect()
    assert [(r.next_file, r.next_pos) for r in got] == [("b.1", 100), ("b.1", 100), ("b.2", 4), ("b.2", 4), ("b.2", 60)]


def test_base_rows_are_older_than_any_change(spark):
    from tidelog.streaming.state import merged_state

    base = spark.createDataFrame([(1, "old"), (2, "kept"), (3, "gone")], "k int, v string")
    deltas = spark.createDataFrame([(1, -(1 << 31), "U", "new"), (3, 5, "D", None)], "k int, seq int, op string, v string")
    assert sorted(map(tuple, merged_state(base, deltas, ["k"], "seq").collect())) == [(1, "new"), (2, "kept")]


@pytest.mark.parametrize(
    "code,name,state",
    [(1042, "ER_BAD_HOST_ERROR", "08S01"), (1052, "ER_NON_UNIQ_ERROR", "23000"), (1058, "ER_WRONG_VALUE_COUNT", "21S01"),
     (1060, "ER_DUP_FIELDNAME", "42S21"), (1146, "ER_NO_SUCH_TABLE", "42S02"), (1213, "ER_LOCK_DEADLOCK", "40001")],
)
def test_error_names(code, name, state):
    from tidelog.operators.errors import error_rows

    assert (code, name, state) in error_rows()


def test_json_numbers_stay_as_written_and_replace_needs_its_key():
    doc = jsondiff.parsed('{"b": 12345678901234567890.123456789, "a": [1, 2.50, "x\\u00e9"]}')
    assert jsondiff.shown(jsondiff.apply_one(doc, "replace", "$.a[0]", "1e400")) == (
        '{"a":[1e400,2.50,"xé"],"b":12345678901234567890.123456789}'
    )
    with pytest.raises(KeyError):
        jsondiff.apply_one({}, "replace", "$.k", "1")
    assert jsondiff.apply_one({}, "insert", "$.k", "1") == {"k": 1}


@pytest.mark.parametrize(
    "code,name,state",
    [(1152, "ER_ABORTING_CONNECTION", "08S01"), (1162, "ER_TOO_LONG_STRING", "42000"), (1792, "ER_CANT_EXECUTE_IN_READ_ONLY_TRANSACTION", "25006"),
     (1859, "ER_DUP_UNKNOWN_IN_INDEX", "23000"), (1863, "ER_ROW_IN_WRONG_PARTITION", "HY000")],
)
def test_error_names_of_the_whole_range(spark, code, name, state):
    from tidelog.operators.errors import enrich_errors, error_dim, error_rows

    (got,) = enrich_errors(spark.createDataFrame([(code,)], "code int"), "code", error_dim(spark)).collect()
    assert tuple(got) == (code, name, state)
    assert len({r[0] for r in error_rows()}) == len(error_rows()) == 864 and sum(r[2] != "HY000" for r in error_rows()) == 224
