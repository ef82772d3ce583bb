"""Headline queries timed on local Spark; prints one JSON line.

Per query: one warm-up run, then the median of BENCH_RUNS runs into the noop
sink. Queries that settle intermediates or drain streams do so inside the run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidelog.operators import images
from tidelog.plans import QUERIES
from tidelog.plans.archive import archive
from tidelog.session import local_session
from tidelog.sources.binlog import list_logs, read_binlog

HEADLINE = [
    "replay_latest_state",
    "merge_apply",
    "gtid_executed_set",
    "gtid_minus",
    "gtid_missing_anti",
    "gtid_contains",
    "tx_rollup",
    "asof_table_map",
    "executed_asof_commit",
    "change_cube",
    "evt_gtid",
    "decimal_decode",
    "column_catalog",
    "scan_raw_mode",
    "archive_checksums",
    "row_changes",
    "archive_replay",
    "expand_tx_payload",
    "stream_binlog",
    "stream_gtid_state",
]


def timed(spark, key: str, sf: str) -> float:
    start = time.perf_counter()
    QUERIES[key](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def rates(spark, sf: str, times: dict[str, float]) -> dict[str, float]:
    """Archive size against the scan and the row-change query."""
    out = {}
    size = sum(s for _, s in list_logs(archive(spark, sf)))
    if "scan_raw_mode" in times:
        out["scan_mb_per_sec"] = round(size / 1e6 / times["scan_raw_mode"], 2)
    if "row_changes" in times:
        changes = images.row_changes(read_binlog(spark, archive(spark, sf))).count()
        out["row_changes_per_sec"] = round(changes / times["row_changes"])
    return out


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "tidelog-bench")
    spark.conf.set("spark.sql.streaming.metricsEnabled", "false")
    times = {}
    for key in keys:
        timed(spark, key, sf)
        times[key] = round(statistics.median(timed(spark, key, sf) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rates": rates(spark, sf, times),
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
