"""Sinks: readable text, partitioned change tables, callbacks per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions.temporal import micros_to_ts
from tidelog.operators.events import FAMILIES, type_name


Fields = dict[str, Column]


def _lines(*pairs: tuple[str, Column]) -> Column:
    # One node for all lines keeps the generated code small.
    template = "".join(f"{name}: %s\n" for name, _ in pairs)
    return F.format_string(template, *[value.cast("string") for _, value in pairs])


def _commit_time(us: Column) -> Column:
    shown = F.date_format(micros_to_ts(us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.concat(us.cast("string"), F.lit(" ("), F.coalesce(shown, F.lit("<n/a>")), F.lit(")"))


def _named(**labels: str) -> Callable[[Fields], Column]:
    """Lines ``label: value`` in the order given; keyword = field name."""
    return lambda f: _lines(*[(label, f[name]) for name, label in labels.items()])


# Body lines per family; families not listed are shown as hex.
BODIES: dict[str, Callable[[Fields], Column]] = {
    "rotate_events": _named(position="Position", next_file="Next log name"),
    "query_events": _named(
        proxy_id="Slave proxy ID", exec_time="Execution time", error_code="Error code",
        schema_name="Schema", query="Query",
    ),
    "xid_events": _named(xid="XID"),
    "gtid_events": lambda f: _lines(
        ("Commit flag", f["commit_flag"]),
        ("GTID_NEXT", F.concat_ws(":", f["sid"], f["gno"])),
        ("LAST_COMMITTED", f["last_committed"]),
        ("SEQUENCE_NUMBER", f["sequence_number"]),
        ("Immediate commit timestamp", _commit_time(f["immediate_commit_us"])),
        ("Original commit timestamp", _commit_time(f["original_commit_us"])),
        ("Transaction length", f["transaction_length"]),
        ("Immediate server version", f["immediate_version"]),
        ("Original server version", f["original_version"]),
    ),
    "mariadb_gtid_events": lambda f: _lines(
        ("GTID", F.concat_ws("-", f["domain_id"], F.col("server_id"), f["seq"])),
        ("Flags", f["gtid_flags"]),
        ("CommitID", F.coalesce(f["commit_id"], F.lit(0).cast("decimal(20,0)"))),
    ),
    "load_queries": _named(
        proxy_id="Slave proxy ID", exec_time="Execution time", schema_length="Schema length",
        error_code="Error code", status_length="Status vars length", file_id="File ID",
        start_pos_in_query="Start pos", end_pos_in_query="End pos", dup_flags="Dup handling flags",
    ),
    "annotations": _named(info="Query"),
    "intvar_events": _named(var_type="Type", value="Value"),
}


def header_text() -> Column:
    return F.concat(
        F.lit("=== "),
        type_name(F.col("event_type")),
        F.lit(" ===\n"),
        _lines(
            ("Date", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")),
            ("Log position", F.col("log_pos")),
            ("Event size", F.col("event_size")),
        ),
        F.lit("\n"),
    )


def dump_text(log: DataFrame) -> DataFrame:
    """Readable text per event; the log key stays for ordering and writing.

    A row evaluates the layout of its own type only. GTID events, whose layout
    is by far the largest, are projected apart: as one expression the layouts
    would outgrow what Spark compiles. Events without a text layout show hex.
    """
    kept = [c for c in log.columns if c not in ("body", "raw")]
    body = F.col("body")

    def out(rows: DataFrame, shown: Column) -> DataFrame:
        return rows.select(*kept, F.concat(header_text(), shown, F.lit("\n")).alias("text"))

    gtid_types, gtid_layout = FAMILIES["gtid_events"]
    is_gtid = F.col("event_type").isin(*gtid_types)
    shown = F.when(F.lit(False), "")
    for family, lines in BODIES.items():
        types, layout = FAMILIES[family]
        if types != gtid_types:
            shown = shown.when(F.col("event_type").isin(*types), lines(layout(body)))
    shown = shown.otherwise(F.concat(F.lit("Body: "), F.hex("body"), F.lit("\n")))
    gtids = out(log.filter(is_gtid), BODIES["gtid_events"](gtid_layout(body)))
    return out(log.filter(~is_gtid), shown).unionByName(gtids)


def dump_values(typed: DataFrame, names: list[str], side: str) -> DataFrame:
    """Rows of a change as ``--`` and ``ordinal:value`` lines."""
    lines = [
        F.concat(F.lit(f"{i}:"), F.coalesce(F.col(side)[n].cast("string"), F.lit("NULL")), F.lit("\n"))
        for i, n in enumerate(names)
    ]
    return typed.withColumn("text", F.concat(F.lit("--\n"), *lines))


def write_changes(changes: DataFrame, path: str, ts_col: str = "ts") -> None:
    """Parquet by table and day. The rebalance splits the partitions of a hot
    table and joins those of quiet ones, so file sizes follow the advisory size."""
    days = changes.withColumn("day", F.to_date(ts_col))
    layout = ["schema_name", "table_name", "day"]
    days.hint("rebalance", *layout).write.partitionBy(*layout).mode("append").parquet(path)


def for_each_batch(
    stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Call ``fn(batch, id)`` for everything available, then stop."""
    return (
        stream.writeStream.foreachBatch(fn)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
