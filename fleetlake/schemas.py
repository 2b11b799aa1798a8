"""Declared schemas of the three message kinds and the bronze tables.

Nothing is inferred: every field is declared and nullable; required-ness is
a validation rule (see ``fleetlake.operators.validate``), not a schema
property.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from fleetlake.functions import rules


def wire_name(field: str, device_field: str = rules.WIRE_DEVICE_ID) -> str:
    """Name of a field in the JSON messages, in which the device is ``device_field``."""
    return device_field if field == "device_id" else field


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


TELEMETRY_SCHEMA = _struct(
    ("event_id", StringType()),
    ("device_id", StringType()),
    ("session_id", StringType()),
    ("event_ts_edge_ms", LongType()),
    ("sensor_type", StringType()),
    ("joint_angle", DoubleType()),
    ("joint_velocity", DoubleType()),
    ("force_x", DoubleType()),
    ("force_z", DoubleType()),
    ("torque", DoubleType()),
    ("accel_x", DoubleType()),
    ("gyro_z", DoubleType()),
    ("temperature", DoubleType()),
)

MANIFEST_SCHEMA = _struct(
    ("event_id", StringType()),
    ("device_id", StringType()),
    ("session_id", StringType()),
    ("media_type", StringType()),
    ("blob_uri", StringType()),
    ("blob_ts_edge_ms", LongType()),
    ("object_size", LongType()),
    ("checksum_sha256", StringType()),
    ("etag", StringType()),
    ("quality_state", StringType()),
)

HEARTBEAT_SCHEMA = _struct(
    ("device_id", StringType()),
    ("session_id", StringType()),
    ("server_ts_ms", LongType()),
    ("estimated_drift_ms", LongType()),
)

# Bronze = message fields (in message order) + the columns ingest adds.
TELEMETRY_BRONZE_SCHEMA = StructType(
    TELEMETRY_SCHEMA.fields
    + [
        StructField("event_ts_corrected", TimestampType(), True),
        StructField("ingest_ts", TimestampType(), True),
        StructField("ingest_status", StringType(), True),
        StructField("drift_source", StringType(), True),
    ]
)

BLOB_INDEX_SCHEMA = StructType(
    MANIFEST_SCHEMA.fields
    + [
        StructField("blob_ts_corrected", TimestampType(), True),
        StructField("ingest_ts", TimestampType(), True),
        StructField("drift_source", StringType(), True),
    ]
)

TELEMETRY_COLUMNS = [f.name for f in TELEMETRY_BRONZE_SCHEMA.fields]
BLOB_INDEX_COLUMNS = [f.name for f in BLOB_INDEX_SCHEMA.fields]


def wire_schema(schema: StructType, device_field: str = rules.WIRE_DEVICE_ID) -> StructType:
    """``schema`` with the field names of the JSON messages."""
    return StructType([StructField(wire_name(f.name, device_field), f.dataType, True) for f in schema.fields])
