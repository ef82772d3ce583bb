"""Streams that stop and go on: limits per batch, merged runs, pruned resume."""

import json
from pathlib import Path

import pytest
from binlog_writer import Log, rows, table_map

from tidelog.sources import binlog
from tidelog.streaming import feeds, levels, state

MAP = table_map(7, [3], b"")


def statements(n: int, open_end: bool = False) -> Log:
    log = Log()
    for k in range(n):
        log.add(19, MAP)
        log.add(30, rows(7, 1, b"\0" + k.to_bytes(4, "little"), [b"\x01"]))
    if open_end:
        log.add(19, MAP)
    return log


def batches(check) -> int:
    return len([f for f in Path(check, "commits").iterdir() if f.name.isdigit()])


def test_limited_batches_stop_and_go_on(spark, tmp_path):
    logs = tmp_path / "logs"
    (logs / "a").mkdir(parents=True)
    (logs / "b").mkdir()
    for k in range(1, 4):
        statements(40, open_end=k == 2).write(logs / "a" / f"bin.{k:06d}")
    statements(10).write(logs / "b" / "bin.000001")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        log = binlog.stream_binlog(spark, str(logs), max_bytes=2500).select(
            "source", "file", "start_pos", "event_type", "table_map"
        )
        return feeds.drain(log, "limited", out, check, stepwise=True)

    def whole():
        read = binlog.read_binlog(spark, str(logs)).select("source", "file", "start_pos")
        return sorted(map(tuple, read.collect()))

    def position(r):
        return r.source, r.file, r.start_pos

    got = run().collect()
    assert sorted(map(position, got)) == whole()
    assert all(r.table_map is not None for r in got if r.event_type == 30)
    first = batches(check)
    assert first >= 5
    # Every batch but for the last statement it finishes keeps to the limit.
    ends = [json.loads(f.read_text().splitlines()[-1]) for f in sorted(Path(check, "offsets").glob("[0-9]*"), key=lambda f: int(f.name))]
    for before, after in zip(ends, ends[1:], strict=False):
        for folder, (file, pos) in after.items():
            if before.get(folder, ["", 4])[0] == file:
                assert pos - before[folder][1] <= 2500 + 200
    # Nothing new: no batch. New files: only they are read.
    assert run().count() == len(got) and batches(check) == first
    statements(40).write(logs / "a" / "bin.000004")
    statements(30).write(logs / "b" / "bin.000002")
    assert sorted(map(position, run().collect())) == whole()
    assert batches(check) >= first + 3


def test_a_limit_below_one_event_takes_a_statement_a_batch(spark, tmp_path):
    statements(3).write(tmp_path / "bin.000001")
    log = binlog.stream_binlog(spark, str(tmp_path), max_bytes=1).select("start_pos")
    check = tmp_path.parent / f"{tmp_path.name}-check"
    out = tmp_path.parent / f"{tmp_path.name}-out"
    assert feeds.drain(log, "tiny", str(out), str(check), stepwise=True).count() == 7
    assert batches(check) == 4


def test_runs_stay_few_and_a_batch_may_run_twice(spark, tmp_path):
    folder = str(tmp_path / "runs")
    schema = "k long, v long"

    def newest(df):
        return df.groupBy("k").agg({"v": "max"}).withColumnRenamed("max(v)", "v")

    for n in range(28):
        batch = spark.createDataFrame([(n % 7, n), (n % 3, n)], schema).coalesce(1)
        levels.store(batch, folder, n, newest, fan=3)
        if n % 4 == 0:
            levels.store(batch, folder, n, newest, fan=3)
        held = [f for f in Path(folder).glob("level=*/at=*")]
        assert len(held) <= 6 * len(list(Path(folder).glob("level=*")))
        if n % 10 == 9:
            got = dict(newest(levels.runs(spark, folder, schema)).collect())
            want = {}
            for m in range(n + 1):
                want |= {m % 7: m, m % 3: m}
            assert got == want
    assert len(held) < 20


@pytest.fixture
def files(spark, tmp_path):
    """A table as a stream of files, one a batch, to which more can be added."""

    def add(values, ddl, name="in"):
        for v in values:
            spark.createDataFrame(v, ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))

    return add


def test_executed_set_goes_on(spark, files, tmp_path):
    ddl, paths = "sid string, gno long", [str(tmp_path / "sink"), str(tmp_path / "check")]
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    stream = files([[("a", g) for g in range(k, 40, 10)] for k in range(5)], ddl)
    state.run_executed_set(stream, 16, *paths)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    stream = files([[("a", g) for g in range(k, 40, 10)] for k in range(5, 10)] + [[("b", 3)]], ddl)
    got = state.run_executed_set(stream, 16, *paths).collect()
    assert sorted(map(tuple, got)) == [("a", 0, 40), ("b", 3, 4)]
    assert sorted(map(tuple, state.run_executed_set(stream, 16, *paths).collect())) == sorted(map(tuple, got))


def test_resume_goes_on_and_reads_what_it_can_meet(spark, files, tmp_path):
    ddl, paths = "sid string, gno long", [str(tmp_path / "sink"), str(tmp_path / "check")]
    done = spark.createDataFrame([("a", k, k + 5) for k in range(0, 1000, 10)] + [("b", 0, 10)], "sid string, start long, stop long")
    first, second = [("a", 3), ("a", 7), ("b", 50)], [("a", 991), ("a", 997), (None, 1), ("c", 1)]
    state.run_resume(files([first], ddl), done, *paths)
    got = state.run_resume(files([second], ddl), done, *paths).collect()
    key = str
    assert sorted(map(tuple, got), key=key) == sorted([("a", 7), ("b", 50), ("a", 997), (None, 1), ("c", 1)], key=key)
    index = state.indexed_set(done, str(tmp_path / "index"))
    near = state._within_reach(index, spark.createDataFrame(first, ddl))
    assert {(r.sid, r.start) for r in near.collect()} == {("a", 0)}
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(start,7)" in plan and "GreaterThan(stop,3)" in plan
    many = spark.createDataFrame([(f"s{k}", 500 + k) for k in range(state.PRUNE_SIDS + 5)], ddl)
    assert {r.start for r in state._within_reach(index, many).collect()} == set(range(500, 570, 10))
    assert state._within_reach(index, many.limit(0)).count() == 0


def test_apply_goes_on(spark, files, tmp_path):
    ddl, paths = "k long, seq long, op string, v long", [str(tmp_path / "sink"), str(tmp_path / "check")]
    base = spark.createDataFrame([(k, 0) for k in range(5)], "k long, v long")
    changes = [[(n % 6, n, "D" if n % 5 == 0 else "U", n)] for n in range(1, 21)]
    state.run_apply(files(changes[:11], ddl), base, ["k"], "seq", *paths)
    got = state.run_apply(files(changes[11:], ddl), base, ["k"], "seq", *paths)
    want = dict(base.collect())
    for ((k, _, op, v),) in changes:
        want[k] = v
        if op == "D":
            del want[k]
    assert dict(got.collect()) == want
    assert len(list(Path(paths[0]).glob("level=*/at=*"))) < 20


def test_headers_without_bodies(spark, tmp_path):
    log = statements(200)
    log.write(tmp_path / "bin.000001")
    (tmp_path / "bin.000002").write_bytes(bytes(log.data[:-5]))
    (tmp_path / "bin.000003").write_bytes(bytes(log.data) + b"\1\2")
    bodies = {"raw", "body", "table_map"}
    whole = binlog.read_binlog(spark, str(tmp_path), mode="PERMISSIVE")
    heads = binlog.read_binlog(spark, str(tmp_path), mode="PERMISSIVE", headers_only=True)
    cols = [c for c in whole.columns if c not in bodies]
    assert sorted(map(str, heads.select(*cols).collect())) == sorted(map(str, whole.select(*cols).collect()))
    assert heads.filter("raw is not null or body is not null or table_map is not null").count() == 0
    assert heads.filter("error is not null").count() == 1
    with pytest.raises(Exception, match="cut short"):
        binlog.read_binlog(spark, str(tmp_path), headers_only=True).count()
    with pytest.raises(Exception, match="headersOnly"):
        binlog.read_binlog(spark, str(tmp_path), verify_checksum=True, headers_only=True).count()
    last = max(r.start_pos for r in whole.filter("file = 'bin.000001'").collect())
    late = binlog.read_binlog(spark, str(tmp_path / "bin.000001"), start_pos=last, headers_only=True)
    assert [r.event_type for r in late.orderBy("start_pos").collect()] == [15, 30]
