"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def micros_between(later: Column, earlier: Column) -> Column:
    """Whole microseconds from `earlier` to `later`."""
    return F.unix_micros(later) - F.unix_micros(earlier)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Exact seconds, as a decimal with six places."""
    return (micros_between(later, earlier).cast("decimal(20,0)") / F.lit(MICROS)).cast("decimal(20,6)")


def wall_time(ts: Column, zone: str) -> Column:
    """Local wall time of an instant in `zone`; daylight saving included."""
    return F.convert_timezone(None, F.lit(zone), ts)


def wall_hour(ts: Column, zone: str) -> Column:
    """Start of the local hour, as a timestamp without zone."""
    return F.date_trunc("hour", wall_time(ts, zone)).cast("timestamp_ntz")


def bucket_start(ts: Column, minutes: int) -> Column:
    """Start of the tumbling window of `minutes` that holds the instant (UTC origin)."""
    width = minutes * 60
    seconds = F.unix_seconds(ts)
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(width)))
