"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Tables small enough for Catalyst to broadcast keep its own size check
# (spark.sql.autoBroadcastJoinThreshold); nothing here forces a broadcast of
# data that can grow.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Sessions of a busy key are merged before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings every operator assumes (UTC above all)."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app: str = "tidelog", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a folder of its own, since there all tasks share one disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


#: Lists that tables written by ``settle`` are noted in, innermost last.
_noting: list[list[str]] = []


@contextmanager
def noted() -> Iterator[list[str]]:
    """Folders of the tables that ``settle`` writes within, for whoever knows when they may go."""
    _noting.append([])
    try:
        yield _noting[-1]
    finally:
        _noting.pop()


def drop_tables(spark: SparkSession, folders: list[str]) -> None:
    """Deletes written tables, through Spark's own file systems."""
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str = "step") -> DataFrame:
    """Write an intermediate once to the shared folder and go on from the files.

    For results that the next steps read more than once: it cuts the lineage,
    survives lost executors, and gives Catalyst true sizes to plan with.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    if _noting:
        _noting[-1].append(folder)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def settle_alone(make: Callable[[], DataFrame], label: str = "step") -> DataFrame:
    """What ``make`` returns, settled; the tables that it settled on the way are dropped."""
    with noted() as own:
        df = make()
    out = settle(df, label)
    drop_tables(out.sparkSession, own)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_spread: dict[tuple[str, str, str], str] = {}


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table in at least as many files as there are cores.

    One small file is one split, which leaves all that is derived from it to one core. A table of
    fewer files is written anew once per application, all rows and columns. Rows are dealt by
    their content: dealing them in turn makes Spark sort each split in its task first.
    """
    df = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _spread:
        folder = new_folder(spark, name)
        df.repartition(cores, *df.columns).write.parquet(folder)
        _spread[key] = folder
    return spark.read.schema(df.schema).parquet(_spread[key])
