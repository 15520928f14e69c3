"""Timestamp helpers. The session time zone is pinned to UTC (see session.py)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_wall_clock(ts: Column, zone: str) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ wall clock in ``zone`` (DST aware)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))


def whole_seconds_between(later: Column, earlier: Column) -> Column:
    """floor((later - earlier) in seconds) as BIGINT; NULL when either side is NULL."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(micros / F.lit(1_000_000.0)).cast("bigint")
