"""Query builders registered for the driver (see ``registry``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions import rules
from fleetlake.plans import gold, silver
from fleetlake.plans.registry import register
from fleetlake.sources.fixtures import Fixture, duckdb_with


def fx(spark: SparkSession, sf_dir: str) -> Fixture:
    return Fixture(spark, sf_dir)


def r6(col: str):
    return F.round(F.col(col), 6).alias(col)


# ---------------------------------------------------------------- silver / gold
def _d_outside(column: str, low: float, high: float, flag: str) -> str:
    return f"if(greatest({low} - {column}, {column} - {high}) > 0, '{flag}', NULL)"


# The violated bounds of a row, in the order of the rules.
_D_FLAGS = f"""
flags AS (
  SELECT *, list_filter([
    {_d_outside("temperature", rules.TEMP_MIN_C, rules.TEMP_MAX_C, "TEMP_OUT_OF_RANGE")},
    {_d_outside("torque", rules.TORQUE_MIN_NM, rules.TORQUE_MAX_NM, "TORQUE_OUT_OF_RANGE")},
    {_d_outside("joint_angle", rules.JOINT_ANGLE_MIN, rules.JOINT_ANGLE_MAX, "ANGLE_OUT_OF_RANGE")}
  ], lambda x: x IS NOT NULL) AS broken
  FROM telx
)
"""
# Hard rules: temperature and torque present and within bounds, a corrected time.
_D_VALIDATED = (
    _D_FLAGS
    + """,
validated AS (
  SELECT * EXCLUDE (n, broken), coalesce(broken[1], 'VALID') AS quality_flag
  FROM flags
  WHERE len(list_filter(broken, lambda x: x <> 'ANGLE_OUT_OF_RANGE')) = 0
    AND len([x for x in [epoch_us(event_ts_corrected)::double, temperature, torque] if x IS NULL]) = 0
)
"""
)
_D_HOUR_US = 3_600_000_000


@register(
    "device_hourly_stats",
    duckdb_with(
        f"""
SELECT device_id, make_timestamp(h * {_D_HOUR_US}) AS hour_bucket, sensor_type, n AS event_count,
  round(s[1] / n, 6) AS avg_torque, m[1] AS max_torque, round(s[2] / n, 6) AS avg_temperature, m[2] AS max_temperature,
  round(s[3] / n, 6) AS avg_joint_angle, make_timestamp(t0) AS first_event, make_timestamp(t1) AS last_event
FROM (
  SELECT device_id, epoch_us(event_ts_corrected) // {_D_HOUR_US} AS h, sensor_type, count(*) AS n,
    [sum(torque), sum(temperature), sum(joint_angle)] AS s, [max(torque), max(temperature)] AS m,
    min(epoch_us(event_ts_corrected)) AS t0, max(epoch_us(event_ts_corrected)) AS t1
  FROM validated WHERE quality_flag = 'VALID' GROUP BY ALL
)
""",
        _D_VALIDATED,
    ),
)
def q_device_hourly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = gold.device_hourly_stats(silver.telemetry_validated(fx(spark, sf_dir).telemetry))
    return stats.select(
        "device_id",
        "hour_bucket",
        "sensor_type",
        "event_count",
        r6("avg_torque"),
        "max_torque",
        r6("avg_temperature"),
        "max_temperature",
        r6("avg_joint_angle"),
        "first_event",
        "last_event",
    )


@register("telemetry_validated", duckdb_with("SELECT * FROM validated", _D_VALIDATED))
def q_telemetry_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.telemetry_validated(fx(spark, sf_dir).telemetry)


@register(
    "flag_quality",
    duckdb_with("SELECT coalesce(broken[1], 'VALID') AS quality_flag, count(*) AS n_rows FROM flags GROUP BY ALL", _D_FLAGS),
)
def q_flag_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = silver.flag_quality(fx(spark, sf_dir).telemetry)
    return flagged.groupBy("quality_flag").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "blob_linked",
    duckdb_with(
        """
SELECT event_id, b.* EXCLUDE (event_id, blob_ts_edge_ms, etag, ingest_ts, n), b.ingest_ts AS blob_ingest_ts, t.*,
  date_diff('microsecond', b.ingest_ts, t.telemetry_ingest_ts) / 1e6 AS link_latency_sec
FROM (SELECT event_id, event_ts_corrected AS telemetry_ts, sensor_type, ingest_ts AS telemetry_ingest_ts FROM telx) t0
JOIN blob b USING (event_id), LATERAL (SELECT t0.telemetry_ts, t0.sensor_type, t0.telemetry_ingest_ts) t
"""
    ),
)
def q_blob_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx(spark, sf_dir)
    return silver.blob_linked(f.blobs, f.telemetry)


# One row per table row: its hour, what it adds to each measure; then one sum.
_D_LINKAGE_REPORT = """
SELECT hour_bucket, total_telemetry, linked_count, pending_count, orphaned_count, total_blobs, total_blob_bytes,
  round(100.0 * linked_count / total_telemetry, 2) AS linkage_pct, round(100.0 * orphaned_count / total_telemetry, 2) AS orphan_pct
FROM (
  SELECT date_trunc('hour', ingest_ts) AS hour_bucket,
    cast(sum(tel) AS bigint) AS total_telemetry,
    cast(sum(tel) FILTER (state = 'LINKED') AS bigint) AS c1, cast(sum(tel) FILTER (state = 'PENDING_BLOB_LINK') AS bigint) AS c2,
    cast(sum(tel) FILTER (state = 'ORPHANED') AS bigint) AS c3, coalesce(c1, 0) AS linked_count, coalesce(c2, 0) AS pending_count,
    coalesce(c3, 0) AS orphaned_count, cast(sum(1 - tel) AS bigint) AS total_blobs, cast(sum(size) AS bigint) AS total_blob_bytes
  FROM (
    SELECT ingest_ts, 1 AS tel, ingest_status AS state, 0 AS size FROM {telemetry}
    UNION ALL SELECT ingest_ts, 0, NULL, object_size FROM blob
  ) GROUP BY 1
) WHERE total_telemetry > 0
"""


@register("linkage_report", duckdb_with(_D_LINKAGE_REPORT.format(telemetry="telx")))
def q_linkage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx(spark, sf_dir)
    return gold.linkage_report(f.telemetry, f.blobs)
