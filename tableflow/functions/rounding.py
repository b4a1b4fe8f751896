"""Rounding of times to the second."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_second(ts: Column) -> Column:
    """Nearest whole second, halves up; works on timestamps with and without a zone."""
    seconds = F.extract(F.lit("SECOND"), ts)
    away = F.floor(seconds + F.lit("0.5").cast("decimal(2,1)")) - seconds
    return ts + F.make_dt_interval(secs=away.cast("decimal(18,6)"))
