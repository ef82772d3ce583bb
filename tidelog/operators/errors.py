"""Error-code enrichment by a left join with a code table."""

from __future__ import annotations

import pkgutil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_STATE = "HY000"


def error_rows() -> list[tuple[int, str, str]]:
    """Code, symbol and SQLSTATE of all server errors from 1000 to 1863, from the package's ``errors.csv``."""
    lines = pkgutil.get_data(__package__, "errors.csv").decode().split()[1:]
    return [(int(code), name, state) for code, name, state in (r.split(",") for r in lines)]


def error_dim(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Code table ``code, name, state``: built in, or a CSV file with these columns."""
    schema = "code int, name string, state string"
    if path is not None:
        return spark.read.csv(path, header=True, schema=schema)
    return spark.createDataFrame(error_rows(), schema)


def enrich_errors(df: DataFrame, code_col: str, dim: DataFrame) -> DataFrame:
    """Add ``error_name`` and ``sql_state``; unknown codes get the general state.

    The code table is a few hundred rows, which Catalyst sees and broadcasts.
    """
    known = dim.select(
        F.col("code").alias(code_col), F.col("name").alias("error_name"), F.col("state").alias("__s")
    )
    return (
        df.join(known, code_col, "left")
        .withColumn("sql_state", F.coalesce("__s", F.lit(DEFAULT_STATE)))
        .drop("__s")
    )
