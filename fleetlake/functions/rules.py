"""Domain constants shared by validation, silver filters and SLA checks.

Fixed values: these must equal the reference's for identical results.
"""

from __future__ import annotations

# --- fixed values (domain bounds, enumerations, identifiers, thresholds) ---
TEMP_MIN_C = -40.0
TEMP_MAX_C = 150.0
TORQUE_MIN_NM = 0.0
TORQUE_MAX_NM = 300.0
JOINT_ANGLE_MIN = -6.3
JOINT_ANGLE_MAX = 6.3
FORCE_MAX_N = 500.0

VALID_SENSOR_TYPES = ("joint_state", "force_torque", "imu")
VALID_MEDIA_TYPES = ("camera_rgb", "camera_depth", "lidar_pointcloud", "audio", "raw_sensor_dump")

REQUIRED_TELEMETRY_FIELDS = ("event_id", "device_id", "session_id", "event_ts_edge_ms", "sensor_type")
REQUIRED_MANIFEST_FIELDS = (
    "event_id",
    "device_id",
    "session_id",
    "media_type",
    "blob_uri",
    "blob_ts_edge_ms",
    "checksum_sha256",
)

QUALITY_FLAGS = ("VALID", "TEMP_OUT_OF_RANGE", "TORQUE_OUT_OF_RANGE", "ANGLE_OUT_OF_RANGE")

STATUS_PENDING = "PENDING_BLOB_LINK"
STATUS_LINKED = "LINKED"
STATUS_ORPHANED = "ORPHANED"
QUALITY_STATE_INGESTED = "INGESTED"

BLOB_URI_SCHEME = "s3://"
RAW_BUCKET = "raw-blobs"
CHECKSUM_HEX_LENGTH = 64
DEVICE_SHARDS = 16

# SLA defaults
FRESHNESS_WARN_SEC = 60
FRESHNESS_CRIT_SEC = 120
MIN_EVENTS_LAST_5M = 100
LINKAGE_WARN_PCT = 90.0
LINKAGE_CRIT_PCT = 80.0
MAX_BAD_TEMP_ROWS = 0
RECONCILE_HEALTHY_PCT = 95.0

# Documented-only timings
MATCH_TOLERANCE_MS = 300
ORPHAN_TIMEOUT_MINUTES = 10

# Bronze partitioning
TELEMETRY_BUCKETS = 128
BLOB_BUCKETS = 64

# File health
SMALL_FILE_AVG_BYTES = 64 * 1024
RECOMMEND_COMPACT_AVG_BYTES = 1024 * 1024
COMPACT_THRESHOLD_BYTES = 100 * 1024 * 1024
COMPACT_TARGET_BYTES = 256 * 1024 * 1024

SEVERITIES = ("OK", "WARNING", "CRITICAL")
# --- end of fixed values ---

# Defaults of names that a site chooses (parameters of the functions that use them): the device's field
# in the JSON messages, the start of its ids, the parts of a blob key that name it.
WIRE_DEVICE_ID = "device_id"
DEVICE_ID_PREFIX = "device-"
BLOB_KEY_SHARD, BLOB_KEY_DEVICE = "device_shard=", "device_id="
