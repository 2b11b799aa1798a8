"""Time expressions (all JVM-side, exact integer arithmetic where possible)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ms_to_timestamp(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP, exact (no float round trip)."""
    return F.timestamp_millis(_c(ms))


def timestamp_to_ms(ts: Column | str) -> Column:
    """TIMESTAMP -> epoch milliseconds, floored."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def epoch_seconds(ts: Column | str) -> Column:
    """TIMESTAMP -> fractional epoch seconds (``to_unixtime``)."""
    return F.unix_micros(_c(ts).cast("timestamp")) / F.lit(1_000_000.0)


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """``to_unixtime(later) - to_unixtime(earlier)`` as DOUBLE seconds."""
    return (F.unix_micros(_c(later).cast("timestamp")) - F.unix_micros(_c(earlier).cast("timestamp"))) / F.lit(
        1_000_000.0
    )


def hour_bucket(ts: Column | str) -> Column:
    return F.date_trunc("hour", _c(ts))


def add_seconds(ts: Column | str, seconds: Column | int) -> Column:
    """``ts + seconds`` for an integer number of seconds, exact to the microsecond."""
    secs = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return F.timestamp_micros(F.unix_micros(_c(ts).cast("timestamp")) + secs.cast("long") * F.lit(1_000_000))


def minus_interval(now: Column, amount: int, unit: str = "MINUTE") -> Column:
    """``now - INTERVAL amount unit`` (strict trailing windows use ``ts > this``)."""
    return now - F.expr(f"INTERVAL {int(amount)} {unit}")


def as_timestamp(value) -> Column:
    """Coerce a python datetime / ISO string / Column into a TIMESTAMP column."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, str):
        return F.to_timestamp(F.lit(value))
    return F.lit(value).cast("timestamp")
