"""Rendering of instants and of dates that are no dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.binary import _c


def frac_text(micros: Column, fsp: Column) -> Column:
    """``.fff`` cut (not rounded) to fsp digits, nothing for fsp 0."""
    digits = F.substring(F.lpad(micros.cast("string"), 6, "0"), F.lit(1), fsp.cast("int"))
    return F.when(fsp > 0, F.concat(F.lit("."), digits)).otherwise("")


def zero_time(micros: Column, fsp: int | Column) -> Column:
    """``0000-00-00 00:00:00[.f]``, fraction cut to fsp digits."""
    return F.concat(F.lit("0000-00-00 00:00:00"), frac_text(micros, _c(fsp)))


def render_time(ts: Column, fsp: int | Column, tz: str = "UTC") -> Column:
    """Instant as wall clock text of a zone (converted from UTC), fraction cut to fsp digits."""
    wall = F.convert_timezone(F.lit("UTC"), F.lit(tz), ts.cast("timestamp_ntz"))
    micros = F.date_format(wall, "SSSSSS")
    return F.concat(F.date_format(wall, "yyyy-MM-dd HH:mm:ss"), frac_text(micros, _c(fsp)))


def micros_to_ts(col: Column) -> Column:
    """Microseconds since the epoch; 0 stands for not available."""
    return F.timestamp_micros(F.nullif(col, F.lit(0)))
