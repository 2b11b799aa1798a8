"""Freshness, completeness and accuracy checks (SLA monitors).

Every time-dependent function takes ``now`` (a datetime, ISO string or
Column) instead of reading the wall clock, so results are reproducible and
an oracle can use the same instant.  ``current_timestamp()`` is the
default a scheduler passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import rules
from fleetlake.functions.time import as_timestamp, hour_bucket, minus_interval, seconds_between


# ------------------------------------------------------------- predicates
def temperature_out_of_range() -> Column:
    """P10: ``temperature < -40 OR temperature > 150``."""
    t = F.col("temperature")
    return (t < rules.TEMP_MIN_C) | (t > rules.TEMP_MAX_C)


def trailing_window(now, minutes: int = 5, column: str = "ingest_ts", unit: str = "MINUTE") -> Column:
    """``column > now - INTERVAL minutes`` (strict)."""
    return F.col(column) > minus_interval(as_timestamp(now), minutes, unit)


# ------------------------------------------------------------- classifiers
def classify_freshness(sec: Column, warn: int = rules.FRESHNESS_WARN_SEC, crit: int = rules.FRESHNESS_CRIT_SEC) -> Column:
    """NULL or > crit -> CRITICAL, > warn -> WARNING, else OK."""
    return (
        F.when(sec.isNull() | (sec > crit), F.lit("CRITICAL"))
        .when(sec > warn, F.lit("WARNING"))
        .otherwise(F.lit("OK"))
    )


def classify_volume(events: Column, minimum: int = rules.MIN_EVENTS_LAST_5M) -> Column:
    """>= minimum -> OK else WARNING (never CRITICAL)."""
    return F.when(events >= minimum, F.lit("OK")).otherwise(F.lit("WARNING"))


def classify_linkage(pct: Column, warn: float = rules.LINKAGE_WARN_PCT, crit: float = rules.LINKAGE_CRIT_PCT) -> Column:
    """< crit -> CRITICAL, < warn -> WARNING, else OK."""
    return F.when(pct < crit, F.lit("CRITICAL")).when(pct < warn, F.lit("WARNING")).otherwise(F.lit("OK"))


def classify_accuracy(bad: Column, max_bad: int = rules.MAX_BAD_TEMP_ROWS) -> Column:
    """P20: bad <= max -> OK else CRITICAL."""
    return F.when(bad <= max_bad, F.lit("OK")).otherwise(F.lit("CRITICAL"))


def worst_severity(*levels: Column) -> Column:
    """CRITICAL if any is CRITICAL, else WARNING if any is WARNING, else OK."""
    arr = F.array(*levels)
    return (
        F.when(F.array_contains(arr, "CRITICAL"), F.lit("CRITICAL"))
        .when(F.array_contains(arr, "WARNING"), F.lit("WARNING"))
        .otherwise(F.lit("OK"))
    )


# ------------------------------------------------------------- aggregates
def freshness_seconds(telemetry: DataFrame, now) -> DataFrame:
    """A10: ``max(0, int(now - max(ingest_ts)))``; NULL on an empty table."""
    latest = telemetry.agg(F.max("ingest_ts").alias("latest_ingest"))
    lag = seconds_between(as_timestamp(now), F.col("latest_ingest"))
    return latest.select(
        "latest_ingest",
        F.when(F.col("latest_ingest").isNull(), F.lit(None))
        .otherwise(F.greatest(F.lit(0), lag.cast("long")))
        .alias("freshness_sec"),
    )


def events_in_window(telemetry: DataFrame, now, minutes: int = 5) -> DataFrame:
    """Rows with ``ingest_ts > now - minutes``."""
    return telemetry.filter(trailing_window(now, minutes)).agg(F.count(F.lit(1)).alias("events_in_window"))


def bad_value_count(telemetry: DataFrame) -> DataFrame:
    """Count of P10 rows.  The OR of two range predicates pushes to Parquet."""
    return telemetry.filter(temperature_out_of_range()).agg(F.count(F.lit(1)).alias("bad_temp_rows"))


def per_device_freshness(telemetry: DataFrame, now, limit: int | None = 10) -> DataFrame:
    """A11 + T2: last_seen per device and staleness in whole seconds (rounded),
    stalest first; ties by device_id."""
    per = telemetry.groupBy("device_id").agg(F.max("ingest_ts").alias("last_seen"))
    per = per.withColumn(
        "stale_sec",
        F.round(seconds_between(as_timestamp(now), F.col("last_seen"))).cast("int"),
    )
    ordered = per.orderBy(F.col("stale_sec").desc(), F.col("device_id"))
    return ordered.limit(limit) if limit is not None else ordered


def hour_histogram(telemetry: DataFrame, column: str = "event_ts_corrected", limit: int | None = 10) -> DataFrame:
    """Rows per event hour, newest hours first."""
    out = (
        telemetry.groupBy(hour_bucket(column).alias("hour_bucket"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.col("hour_bucket").desc())
    )
    return out.limit(limit) if limit is not None else out


def check_aggregates(telemetry: DataFrame, now, window_minutes: int = 5) -> DataFrame:
    """All per-row quality measures of one table in a single scan (one row):
    latest ingest, rows in the trailing window, total rows, bad temperature rows."""
    return telemetry.agg(
        F.max("ingest_ts").alias("latest_ingest"),
        F.count(F.when(trailing_window(now, window_minutes), 1)).alias("events_last_5m"),
        F.count(F.lit(1)).alias("total_telemetry"),
        F.count(F.when(temperature_out_of_range(), 1)).alias("bad_temp_rows"),
    )


def stamp_kind(event_ts: str = "event_ts_corrected", ingest_ts: str = "ingest_ts") -> Column:
    """P25: LATE when the event hour is earlier than the ingest hour."""
    return F.when(
        hour_bucket(event_ts) < hour_bucket(ingest_ts), F.lit("LATE")
    ).otherwise(F.lit("ON_TIME"))
