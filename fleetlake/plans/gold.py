"""Gold models: per-device hourly statistics and the hourly linkage report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import rules
from fleetlake.functions.time import hour_bucket


def device_hourly_stats(validated: DataFrame) -> DataFrame:
    """Group VALID silver rows by (device, hour, sensor).

    Partial aggregation runs map-side, so a hot device costs one partial row
    per (map task, group) in the shuffle, never a third of the input.
    """
    return (
        validated.filter(F.col("quality_flag") == "VALID")
        .groupBy("device_id", hour_bucket("event_ts_corrected").alias("hour_bucket"), "sensor_type")
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


def telemetry_hourly_status(telemetry: DataFrame) -> DataFrame:
    """Hourly telemetry count and counts per ``ingest_status`` value (A3)."""
    status = F.col("ingest_status")
    return telemetry.groupBy(hour_bucket("ingest_ts").alias("hour_bucket")).agg(
        F.count(F.lit(1)).alias("total_telemetry"),
        F.count(F.when(status == rules.STATUS_LINKED, 1)).alias("linked_count"),
        F.count(F.when(status == rules.STATUS_PENDING, 1)).alias("pending_count"),
        F.count(F.when(status == rules.STATUS_ORPHANED, 1)).alias("orphaned_count"),
    )


def blob_hourly_volume(blobs: DataFrame) -> DataFrame:
    """Hourly blob count and bytes (A4)."""
    return blobs.groupBy(hour_bucket("ingest_ts").alias("hour_bucket")).agg(
        F.count(F.lit(1)).alias("total_blobs"),
        F.sum("object_size").cast("long").alias("total_blob_bytes"),
    )


def _pct(part: str, total: str):
    # NULLIF(total, 0): an empty hour yields NULL, never a division error.
    return F.round(F.col(part).cast("double") / F.nullif(F.col(total), F.lit(0)) * 100, 2)


def linkage_report(telemetry: DataFrame, blobs: DataFrame, ordered: bool = True) -> DataFrame:
    """Gold ``linkage_report`` (A5): hourly status counts left-joined to blob volume.

    Both sides are aggregated before the join, so the join input is one row
    per hour per side (a few thousand rows a year) regardless of volume.
    """
    return linkage_report_from(telemetry_hourly_status(telemetry), blob_hourly_volume(blobs), ordered)


def linkage_report_from(t: DataFrame, b: DataFrame, ordered: bool = True) -> DataFrame:
    """A5 from its two hourly aggregates (A3, A4)."""
    out = t.join(b, "hour_bucket", "left").select(
        "hour_bucket",
        "total_telemetry",
        "linked_count",
        "pending_count",
        "orphaned_count",
        F.coalesce(F.col("total_blobs"), F.lit(0)).cast("long").alias("total_blobs"),
        F.coalesce(F.col("total_blob_bytes"), F.lit(0)).cast("long").alias("total_blob_bytes"),
        _pct("linked_count", "total_telemetry").alias("linkage_pct"),
        _pct("orphaned_count", "total_telemetry").alias("orphan_pct"),
    )
    return out.orderBy(F.col("hour_bucket").desc()) if ordered else out
