"""Registered drift-correction queries."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake import sinks
from fleetlake.operators import drift
from fleetlake.plans.registry import register
from fleetlake.sources.fixtures import Fixture, duckdb_with

# The device of the single-device queries: that of the newest row.
_D_DEVICE = "(SELECT device_id FROM telx ORDER BY event_ts_corrected DESC, event_id LIMIT 1)"


def newest_row(f: Fixture):
    return f.telemetry.orderBy(F.col("event_ts_corrected").desc(), "event_id").select("device_id", "event_ts_corrected").first()


_OUT = ["event_id", "device_id", "event_ts_edge_ms", "drift_ms", "drift_source", "event_ts_corrected"]

_D_LATEST = """
hb_latest AS (
  SELECT device_id, estimated_drift_ms AS drift_ms FROM (
    SELECT device_id, coalesce(estimated_drift_ms, 0) AS estimated_drift_ms,
      row_number() OVER (PARTITION BY device_id
                         ORDER BY server_ts_ms DESC, session_id DESC, coalesce(estimated_drift_ms, 0) DESC) AS rn
    FROM hb WHERE device_id IS NOT NULL) WHERE rn = 1
)
"""


def _d_corrected(drift_expr: str) -> str:
    return (
        f"CASE WHEN t.event_ts_edge_ms IS NOT NULL AND t.event_ts_edge_ms <> 0 "
        f"THEN make_timestamp((t.event_ts_edge_ms - coalesce({drift_expr}, 0)) * 1000) END"
    )


@register("drift_latest", duckdb_with("SELECT device_id, drift_ms FROM hb_latest", _D_LATEST))
def q_drift_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.latest_drift(Fixture(spark, sf_dir).heartbeats)


@register(
    "correct_drift_latest",
    duckdb_with(
        f"""
SELECT t.event_id, t.device_id, t.event_ts_edge_ms, d.drift_ms,
  CASE WHEN d.drift_ms IS NOT NULL THEN 'HEARTBEAT' ELSE 'DEFAULT' END AS drift_source,
  {_d_corrected('d.drift_ms')} AS event_ts_corrected
FROM telx t LEFT JOIN hb_latest d ON t.device_id = d.device_id
""",
        _D_LATEST,
    ),
)
def q_correct_drift_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = Fixture(spark, sf_dir)
    raw = f.telemetry.drop("event_ts_corrected")
    return drift.correct_drift(raw, f.heartbeats).select(*_OUT)


@register(
    "correct_drift_asof",
    duckdb_with(
        f"""
SELECT t.event_id, t.device_id, t.event_ts_edge_ms, h.estimated_drift_ms AS drift_ms,
  CASE WHEN h.estimated_drift_ms IS NOT NULL THEN 'HEARTBEAT' ELSE 'DEFAULT' END AS drift_source,
  {_d_corrected('h.estimated_drift_ms')} AS event_ts_corrected
FROM telx t ASOF LEFT JOIN hb h ON t.device_id = h.device_id AND t.event_ts_edge_ms >= h.server_ts_ms
"""
    ),
)
def q_correct_drift_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = Fixture(spark, sf_dir)
    raw = f.telemetry.drop("event_ts_corrected")
    return drift.correct_drift_asof(raw, f.heartbeats).select(*_OUT)


@register(
    "drift_residual",
    duckdb_with(
        """
SELECT t.device_id, count(*) AS n_rows,
  max(abs(((t.event_ts_edge_ms - h.estimated_drift_ms) - (epoch_us(t.event_ts_corrected) // 1000)))) AS max_abs_error_ms
FROM telx t ASOF JOIN hb h ON t.device_id = h.device_id AND t.event_ts_edge_ms >= h.server_ts_ms
GROUP BY t.device_id
"""
    ),
)
def q_drift_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of as-of correction per device: max |corrected - true| in ms."""
    f = Fixture(spark, sf_dir)
    fixed = drift.correct_drift_asof(
        f.telemetry.withColumnRenamed("event_ts_corrected", "true_ts"), f.heartbeats
    ).filter(F.col("drift_ms").isNotNull())
    err = F.abs(F.unix_millis("event_ts_corrected") - F.unix_millis(F.col("true_ts").cast("timestamp")))
    return fixed.groupBy("device_id").agg(F.count(F.lit(1)).alias("n_rows"), F.max(err).alias("max_abs_error_ms"))


@register(
    "drift_applied",
    duckdb_with(
        f"""
SELECT device_id, event_ts_edge_ms, event_ts_corrected,
  cast(event_ts_edge_ms AS double) / 1000 - epoch_us(event_ts_corrected) / 1000000.0 AS drift_applied_sec
FROM telx WHERE device_id = {_D_DEVICE}
ORDER BY event_ts_corrected DESC, event_id LIMIT 5
"""
    ),
)
def q_drift_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = Fixture(spark, sf_dir)
    t = f.telemetry.filter(F.col("device_id") == newest_row(f)["device_id"])
    return (
        t.orderBy(F.col("event_ts_corrected").desc(), F.col("event_id"))
        .limit(5)
        .select("device_id", "event_ts_edge_ms", "event_ts_corrected", drift.drift_applied_sec().alias("drift_applied_sec"))
    )


@register(
    "device_hour_lookup",
    duckdb_with(
        f"""
SELECT event_id, event_ts_corrected, date_trunc('hour', event_ts_corrected) AS p_hour FROM telx
WHERE device_id = {_D_DEVICE} AND event_ts_corrected > (SELECT max(event_ts_corrected) FROM telx) - INTERVAL 1 HOUR
"""
    ),
)
def q_device_hour_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12 through the layout's filter: the last hour of the device with the newest row."""
    f = Fixture(spark, sf_dir)
    row = newest_row(f)
    laid_out = sinks.telemetry_layout(f.telemetry)
    since = row["event_ts_corrected"] - datetime.timedelta(hours=1)
    return laid_out.filter(sinks.device_hour_filter(row["device_id"], since)).select("event_id", "event_ts_corrected", "p_hour")
