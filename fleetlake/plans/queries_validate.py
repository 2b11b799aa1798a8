"""Registered decode / validation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions import rules
from fleetlake.operators import validate
from fleetlake.plans.registry import register
from fleetlake.schemas import TELEMETRY_SCHEMA
from fleetlake.sources.fixtures import Fixture, duckdb_with
from fleetlake.sources.topics import decode_payload

_MISSING_ALL = (
    f"['missing_field:event_id', 'missing_field:{rules.WIRE_DEVICE_ID}', 'missing_field:session_id', "
    "'missing_field:event_ts_edge_ms', 'missing_field:sensor_type']"
)

_D_TVAL = f"""
tval AS (
  SELECT n,
    CASE WHEN n % 211 = 0 OR n % 223 = 0 THEN NULL ELSE event_id END AS event_id,
    CASE WHEN n % 211 = 0 OR n % 199 = 0 THEN NULL ELSE event_ts_edge_ms END AS event_ts_edge_ms,
    CASE WHEN n % 211 = 0 THEN NULL ELSE temperature END AS temperature,
    CASE
      WHEN n % 211 = 0 THEN {_MISSING_ALL}
      WHEN n % 223 = 0 THEN ['missing_field:event_id']
      ELSE list_filter([
        CASE WHEN n % 199 = 0 THEN 'bad_type:event_ts_edge_ms:expected_numeric' END,
        CASE WHEN sensor_type NOT IN ('joint_state', 'force_torque', 'imu')
             THEN 'invalid_sensor_type:' || sensor_type END,
        CASE WHEN temperature < -40 OR temperature > 150 OR isnan(temperature)
             THEN 'temperature_out_of_range:' || cast(temperature AS varchar) END,
        CASE WHEN torque < 0 OR torque > 300 OR isnan(torque)
             THEN 'torque_out_of_range:' || cast(torque AS varchar) END,
        CASE WHEN joint_angle < -6.3 OR joint_angle > 6.3 OR isnan(joint_angle)
             THEN 'joint_angle_out_of_range:' || cast(joint_angle AS varchar) END,
        CASE WHEN abs(force_x) > 500 OR isnan(force_x) THEN 'force_x_out_of_range:' || cast(force_x AS varchar) END,
        CASE WHEN abs(force_z) > 500 OR isnan(force_z) THEN 'force_z_out_of_range:' || cast(force_z AS varchar) END,
        CASE WHEN length(event_id) - length(replace(event_id, ':', '')) <> 2
             THEN 'malformed_event_id:' || event_id END
      ], lambda x: x IS NOT NULL)
    END AS errs
  FROM telx
)
"""

_D_MVAL = """
mval AS (
  SELECT n, event_id,
    CASE WHEN n % 29 = 0 THEN ['missing_field:checksum_sha256']
      ELSE list_filter([
        CASE WHEN n % 13 = 0 THEN 'invalid_media_type:thermal' END,
        CASE WHEN n % 17 = 0 THEN 'bad_checksum_length:63' END,
        CASE WHEN n % 19 = 0 THEN 'bad_blob_uri_scheme:' || substring('http://' || substring(blob_uri, 6), 1, 20) END
      ], lambda x: x IS NOT NULL)
    END AS errs
  FROM blob
)
"""

_D_KIND = (
    "CASE WHEN split_part(e, ':', 1) IN ('missing_field', 'bad_type') "
    "THEN split_part(e, ':', 1) || ':' || split_part(e, ':', 2) ELSE split_part(e, ':', 1) END"
)


@register(
    "validate_telemetry",
    duckdb_with(
        "SELECT event_id, event_ts_edge_ms, temperature, len(errs) = 0 AS is_valid, "
        "array_to_string(errs, '|') AS errors FROM tval",
        _D_TVAL,
    ),
)
def q_validate_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = validate.validate_telemetry(Fixture(spark, sf_dir).telemetry_messages)
    return v.select(
        "event_id", "event_ts_edge_ms", "temperature", "is_valid", F.array_join("errors", "|").alias("errors")
    )


@register(
    "validate_manifest",
    duckdb_with(
        "SELECT event_id, len(errs) = 0 AS is_valid, "
        "array_to_string(errs, '|') AS errors FROM mval",
        _D_MVAL,
    ),
)
def q_validate_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = validate.validate_manifest(Fixture(spark, sf_dir).manifest_messages)
    return v.select("event_id", "is_valid", F.array_join("errors", "|").alias("errors"))


@register(
    "reject_counts",
    duckdb_with(
        f"""
SELECT error_kind, count(*) AS n_records FROM (
  SELECT DISTINCT n, k AS error_kind FROM (
    SELECT n, unnest(list_concat(['_sent'], CASE WHEN len(errs) > 0 THEN ['_rejected'] ELSE [] END,
                                 list_transform(errs, lambda e: {_D_KIND}))) AS k
    FROM tval))
GROUP BY error_kind
""",
        _D_TVAL,
    ),
)
def q_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.reject_counts(validate.validate_telemetry(Fixture(spark, sf_dir).telemetry_messages))


@register(
    "accepted_telemetry",
    duckdb_with(
        "SELECT t.sensor_type, count(*) AS n_rows, round(avg(t.temperature), 6) AS avg_temperature "
        "FROM tval v JOIN telx t USING (n) WHERE len(v.errs) = 0 GROUP BY t.sensor_type",
        _D_TVAL,
    ),
)
def q_accepted_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: the accepted side of the split, summarised per sensor type."""
    ok, _ = validate.split_valid(validate.validate_telemetry(Fixture(spark, sf_dir).telemetry_messages))
    return ok.groupBy("sensor_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("temperature"), 6).alias("avg_temperature")
    )


@register(
    "decode_payload",
    duckdb_with(
        """
SELECT CASE WHEN n % 211 = 0 OR n % 223 = 0 THEN NULL ELSE event_id END AS event_id,
  CASE WHEN n % 211 = 0 THEN NULL ELSE device_id END AS device_id,
  CASE WHEN n % 211 = 0 OR n % 199 = 0 THEN NULL ELSE event_ts_edge_ms END AS event_ts_edge_ms,
  CASE WHEN n % 211 = 0 THEN NULL ELSE sensor_type END AS sensor_type,
  CASE WHEN n % 211 = 0 THEN NULL ELSE torque END AS torque,
  CASE WHEN n % 211 = 0 THEN NULL ELSE temperature END AS temperature
FROM telx
"""
    ),
)
def q_decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 with the typed reference schema: wrong-typed field -> NULL, broken JSON -> all NULL."""
    msgs = Fixture(spark, sf_dir).telemetry_messages
    return decode_payload(msgs, TELEMETRY_SCHEMA).select(
        "event_id", "device_id", "event_ts_edge_ms", "sensor_type", "torque", "temperature"
    )
