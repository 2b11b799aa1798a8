"""Streaming forms of the hourly gold aggregates (tumbling windows).

Ingest itself never drops late rows (W6); these continuous aggregates are
an early view and use a watermark to bound their state.  A row later than
the watermark is left out of the *windowed* aggregate only: the kept models
of ``gold_state`` and the batch models include it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import rules
from fleetlake.plans import silver


def hourly_stats_stream(telemetry: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """A2 on a stream: per (device, hour, sensor) over VALID silver rows,
    emitted in append mode when the watermark passes the hour's end."""
    valid = silver.telemetry_validated(telemetry).filter(F.col("quality_flag") == "VALID")
    agg = (
        valid.withWatermark("event_ts_corrected", watermark)
        .groupBy("device_id", F.window("event_ts_corrected", "1 hour").alias("w"), "sensor_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.avg("torque").alias("avg_torque"),
            F.max("torque").alias("max_torque"),
            F.avg("temperature").alias("avg_temperature"),
            F.max("temperature").alias("max_temperature"),
            F.avg("joint_angle").alias("avg_joint_angle"),
            F.min("event_ts_corrected").alias("first_event"),
            F.max("event_ts_corrected").alias("last_event"),
        )
    )
    return agg.select("device_id", F.col("w.start").alias("hour_bucket"), "sensor_type", *agg.columns[3:])


def hourly_status_stream(telemetry: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """A3 on a stream: hourly telemetry count and per-status counts by ingest hour."""
    status = F.col("ingest_status")
    agg = (
        telemetry.withWatermark("ingest_ts", watermark)
        .groupBy(F.window("ingest_ts", "1 hour").alias("w"))
        .agg(
            F.count(F.lit(1)).alias("total_telemetry"),
            F.count(F.when(status == rules.STATUS_LINKED, 1)).alias("linked_count"),
            F.count(F.when(status == rules.STATUS_PENDING, 1)).alias("pending_count"),
            F.count(F.when(status == rules.STATUS_ORPHANED, 1)).alias("orphaned_count"),
        )
    )
    return agg.select(F.col("w.start").alias("hour_bucket"), *agg.columns[1:])
