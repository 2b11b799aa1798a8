"""Silver models: validated telemetry and linked blobs.

Each model is a function ``DataFrame(s) -> DataFrame``; composition of the
functions is the model DAG, ``fleetlake.plans.materialize`` writes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import rules
from fleetlake.functions.time import seconds_between

SILVER_TELEMETRY_COLUMNS = [
    "event_id",
    "device_id",
    "session_id",
    "event_ts_edge_ms",
    "event_ts_corrected",
    "ingest_ts",
    "sensor_type",
    "joint_angle",
    "joint_velocity",
    "force_x",
    "force_z",
    "torque",
    "accel_x",
    "gyro_z",
    "temperature",
    "ingest_status",
]


def quality_flag() -> Column:
    """First matching rule wins; NULL comparisons fall through to VALID."""
    t, q, a = F.col("temperature"), F.col("torque"), F.col("joint_angle")
    return (
        F.when((t < rules.TEMP_MIN_C) | (t > rules.TEMP_MAX_C), F.lit("TEMP_OUT_OF_RANGE"))
        .when((q < rules.TORQUE_MIN_NM) | (q > rules.TORQUE_MAX_NM), F.lit("TORQUE_OUT_OF_RANGE"))
        .when((a < rules.JOINT_ANGLE_MIN) | (a > rules.JOINT_ANGLE_MAX), F.lit("ANGLE_OUT_OF_RANGE"))
        .otherwise(F.lit("VALID"))
    )


def flag_quality(df: DataFrame) -> DataFrame:
    """Add ``quality_flag`` without filtering (all four flags reachable)."""
    return df.withColumn("quality_flag", quality_flag())


def hard_filter_condition() -> Column:
    """Inclusive bounds; a NULL temperature / torque / corrected time drops the row."""
    return (
        F.col("temperature").between(rules.TEMP_MIN_C, rules.TEMP_MAX_C)
        & F.col("torque").between(rules.TORQUE_MIN_NM, rules.TORQUE_MAX_NM)
        & F.col("event_ts_corrected").isNotNull()
    )


def hard_filter(df: DataFrame) -> DataFrame:
    return df.filter(hard_filter_condition())


def telemetry_validated(bronze: DataFrame) -> DataFrame:
    """Silver ``telemetry_validated``: explicit projection + flag + hard filter.

    The filter is a conjunction of simple comparisons on scan columns, so
    Catalyst pushes it into the Parquet reader as row-group filters.
    """
    return bronze.filter(hard_filter_condition()).select(*SILVER_TELEMETRY_COLUMNS, quality_flag().alias("quality_flag"))


def blob_linked(blobs: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Silver ``blob_linked``: inner join on event_id, 13 columns + latency.

    A plain equi-join: Catalyst adds ``isnotnull(event_id)`` on both sides
    so NULL ids (broken messages) never reach the shuffle; AQE splits hot
    ids (skew join) and turns the join into a broadcast when one side is
    small at run time.
    """
    b = blobs.select(
        "event_id",
        "device_id",
        "session_id",
        "media_type",
        "blob_uri",
        "blob_ts_corrected",
        "object_size",
        "checksum_sha256",
        "quality_state",
        F.col("ingest_ts").alias("blob_ingest_ts"),
    )
    t = telemetry.select(
        "event_id",
        F.col("event_ts_corrected").alias("telemetry_ts"),
        "sensor_type",
        F.col("ingest_ts").alias("telemetry_ingest_ts"),
    )
    return b.join(t, "event_id", "inner").select(
        "event_id",
        "device_id",
        "session_id",
        "media_type",
        "blob_uri",
        "blob_ts_corrected",
        "object_size",
        "checksum_sha256",
        "quality_state",
        "blob_ingest_ts",
        "telemetry_ts",
        "sensor_type",
        "telemetry_ingest_ts",
        seconds_between("telemetry_ingest_ts", "blob_ingest_ts").cast("double").alias("link_latency_sec"),
    )
